"""Typed schemas of the stored tables."""

from pyspark.sql import types as T

S, I, L, D, TS = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampType()


def _st(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# Dimension files, positional column order as delivered in the drop folder.
LINE_FILE = _st(("line_name", S), ("line_abbr", S), ("project_name", S), ("description", S), ("energy_mgr", I))
STATION_FILE = _st(
    ("station_name", S), ("station_abbr", S), ("line_name", S), ("description", S),
    ("area", D), ("energy_mgr", I), ("transfer", I),
)
POINT_FILE = _st(
    ("line_name", S), ("station_name", S), ("point_name", S), ("type", S), ("control_id", I),
    ("equipment_id", S), ("equipment_name", S), ("data_type", S), ("statics", I), ("unit", S),
    ("quantity", I), ("lower_limit", D), ("upper_limit", D), ("description", S),
)

#: Drop-folder name of each dimension: its columns and natural key.
DIMENSIONS = {
    "center": (LINE_FILE, ["line_name"]),
    "line": (STATION_FILE, ["line_name", "station_name"]),
    "point": (POINT_FILE, ["line_name", "station_name", "type", "control_id"]),
}

# Long analog readings (YC): one row per (station, tick, control id).
READING = _st(("station_abbr", S), ("tick", TS), ("control_id", I), ("value", S))
# Status change log (YX).
STATUS = _st(("station_abbr", S), ("id", I), ("ts", TS), ("value", S))

KPI_REAL = _st(("station_abbr", S), ("tick", TS), *[(c, D) for c in ("d2", "d3", "d4", "d5", "d10", "d15", "d20", "d24")])
KPI_DAY = _st(("station_abbr", S), ("tick", TS), *[(c, D) for c in ("d1", "d2", "d3", "d4", "d5", "d10", "d15", "d20", "d24")])

# Samples of the mapped-table and typed-copy programs.
USER = _st(("rowkey", S), ("name", S), ("age", I), ("password", S))
TYPED_READING = _st(("rowkey", S), ("point_id", I), ("sdate", I), ("time", I), ("data", T.FloatType()))
RESULT_SET = _st(("point", S), ("time", I), ("value", T.FloatType()))
