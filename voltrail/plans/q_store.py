"""Registered queries: rollups, cell mapping, typed surface and Parquet storage."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltrail import schemas as SC
from voltrail.functions.codec import NULL_MARKER
from voltrail.functions.ticks import seq_to_tick, tick_text
from voltrail.operators import kpi as K
from voltrail.operators import rollup as RU
from voltrail.params import DAY_COLUMNS
from voltrail.plans import fixtures as fx
from voltrail.plans.oracle_core import R4, TICK_TEXT, D, with_ctes
from voltrail.plans.q_kpi import RS, _day, world
from voltrail.plans.registry import register
from voltrail.session import scratch_path
from voltrail.sources import mapping as M
from voltrail.sources import runs as RN
from voltrail.sources import store as ST
from voltrail.sources import textrows as TR

# ------------------------------------------------------------------ rollups

_ALL = "(" + " + ".join(DAY_COLUMNS) + f") / {D(len(DAY_COLUMNS))}"
_HOURLY = {
    "day_all": (f'SELECT *, {_ALL} AS "all" FROM kpi_dayt', ("kpi_dayt",)),
    "scores_long": ("SELECT station_abbr, CAST(floor(seq / 3) AS BIGINT) AS hour_seq, kpi, CASE WHEN score BETWEEN 0 AND 100 THEN score END AS score "
                    'FROM (SELECT station_abbr, seq, "all", ' + ", ".join(DAY_COLUMNS)
                    + ' FROM day_all) UNPIVOT INCLUDE NULLS (score FOR kpi IN ("all", ' + ", ".join(DAY_COLUMNS) + "))", ("day_all",)),
    "hourly_any": ("SELECT station_abbr, hour_seq, kpi, COUNT(score) AS n, SUM(score) AS total FROM scores_long GROUP BY 1, 2, 3", ("scores_long",)),
    "hourly_st": ("""SELECT * FROM hourly_any h WHERE EXISTS (SELECT 1 FROM hourly_any a
 WHERE a.station_abbr = h.station_abbr AND a.hour_seq = h.hour_seq AND a.kpi = 'all' AND a.n > 0)""", ("hourly_any",)),
    "hourly_tab": ("""SELECT m.line_name, h.station_abbr, h.hour_seq, h.kpi, h.total FROM hourly_st h JOIN fx_station m ON m.station_abbr = h.station_abbr
UNION ALL SELECT m.line_name, 'all', h.hour_seq, h.kpi, SUM(h.total) FROM hourly_st h JOIN fx_station m ON m.station_abbr = h.station_abbr
WHERE h.kpi = 'all' GROUP BY 1, 3, 4""", ("hourly_st", "fx_station")),
}
_HOURLY.update(RS)


def _station_hours(spark, sf_dir):
    return RU.hourly_station(_day(spark, sf_dir))


@register("hourly_station_sum", with_ctes(
    f"""SELECT station_abbr, {TICK_TEXT('hour_seq * 3')} AS hour, kpi, n, {R4('total')} AS total,
 {R4('CASE WHEN n > 0 THEN total / n END')} AS mean FROM hourly_st""", ("hourly_st",), _HOURLY), "E-8", "C-12")
def q_hourly_station_sum(spark, sf_dir):
    h = _station_hours(spark, sf_dir)
    return h.select("station_abbr", tick_text(seq_to_tick(F.col("hour_seq") * 3)).alias("hour"), "kpi", "n",
                    K.round4(F.col("total")).alias("total"), K.round4(F.col("mean")).alias("mean"))


@register("hourly_line_rollup", with_ctes(
    f"""SELECT line_name, {TICK_TEXT('hour_seq * 3')} AS hour, kpi, COUNT(*) AS n,
 {R4('SUM(total)')} AS total, {R4('SUM(total) / COUNT(*)')} AS mean
FROM hourly_tab WHERE station_abbr <> 'all' GROUP BY line_name, hour_seq, kpi""", ("hourly_tab",), _HOURLY), "E-9", "C-13")
def q_hourly_line_rollup(spark, sf_dir):
    h = RU.hourly_line(RU.hourly_table(_station_hours(spark, sf_dir), world(spark, sf_dir)["stations"]))
    return h.select("line_name", tick_text(seq_to_tick(F.col("hour_seq") * 3)).alias("hour"), "kpi", "n",
                    K.round4(F.col("total")).alias("total"), K.round4(F.col("mean")).alias("mean"))


@register("hourly_table", with_ctes(
    f"SELECT line_name, station_abbr, {TICK_TEXT('hour_seq * 3')} AS hour, kpi, {R4('total')} AS total FROM hourly_tab",
    ("hourly_tab",), _HOURLY), "E-8", "E-9")
def q_hourly_table(spark, sf_dir):
    t = RU.hourly_table(_station_hours(spark, sf_dir), world(spark, sf_dir)["stations"])
    return t.select("line_name", "station_abbr", tick_text(seq_to_tick(F.col("hour_seq") * 3)).alias("hour"), "kpi",
                    K.round4(F.col("total")).alias("total"))


# ------------------------------------------------------------------ cells and catalogs

_CUST_COLS = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
_CELLS_SQL = " UNION ALL ".join(
    f"SELECT 'c' || CAST(c_custkey AS VARCHAR) AS rowkey, 'c' AS family, '{c}' AS qualifier, "
    f"CAST({c} AS VARCHAR) AS value FROM customer" for c in _CUST_COLS)
_CATALOG = {"c_name": ("name", "string"), "c_nationkey": ("nation", "int"),
            "c_acctbal": ("balance", "double"), "c_mktsegment": ("segment", "string")}
# fixed values: the column type map of the mapped table (anything else is string)
_TYPES = (("c_nationkey", "int"), ("c_acctbal", "double"))


def _cells(spark, sf_dir):
    cust = fx.table(spark, sf_dir, "customer")
    return M.to_cells(cust, F.concat(F.lit("c"), F.col("c_custkey").cast("string")), "c", _CUST_COLS)


@register("cell_scan", _CELLS_SQL, "A-17")
def q_cell_scan(spark, sf_dir):
    return _cells(spark, sf_dir)


@register("catalog_read", f"""SELECT rowkey,
 MAX(CASE WHEN qualifier = 'c_name' THEN value END) AS name,
 TRY_CAST(MAX(CASE WHEN qualifier = 'c_nationkey' THEN value END) AS INTEGER) AS nation,
 TRY_CAST(MAX(CASE WHEN qualifier = 'c_acctbal' THEN value END) AS DOUBLE) AS balance,
 MAX(CASE WHEN qualifier = 'c_mktsegment' THEN value END) AS segment
FROM ({_CELLS_SQL}) GROUP BY rowkey""", "A-11")
def q_catalog_read(spark, sf_dir):
    return M.catalog_read(_cells(spark, sf_dir), _CATALOG, family="c")


# An order writes cells of its customer's row, at its date: a cell has as many versions as the customer has orders.
_ORDER_COLS = ["o_orderstatus", "o_totalprice", "o_orderpriority"]
_ORDER_CATALOG = {"o_orderstatus": ("status", "string"), "o_totalprice": ("price", "double"), "o_orderpriority": ("priority", "string")}
_ORDER_CELLS = " UNION ALL ".join(
    f"SELECT 'c' || CAST(o_custkey AS VARCHAR) AS rowkey, 'o' AS family, '{c}' AS qualifier, CAST(o_orderdate AS TIMESTAMP) AS ts, "
    f"CAST({c} AS VARCHAR) AS value FROM orders" for c in _ORDER_COLS)
_NEWEST = f"""SELECT rowkey, family, qualifier, ts, value, COUNT(*) OVER (PARTITION BY rowkey, family, qualifier) AS n,
 row_number() OVER (PARTITION BY rowkey, family, qualifier ORDER BY ts DESC, value DESC NULLS LAST) AS k FROM ({_ORDER_CELLS})"""
_MID = "(SELECT date_trunc('day', make_timestamp((epoch_us(min(CAST(o_orderdate AS TIMESTAMP))) + epoch_us(max(CAST(o_orderdate AS TIMESTAMP)))) // 2)) FROM orders)"


def _order_cells(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    return M.to_cells(o, F.concat(F.lit("c"), F.col("o_custkey").cast("string")), "o", _ORDER_COLS, F.col("o_orderdate").cast("timestamp"))


@register("cell_versions", f"""SELECT rowkey, family, qualifier, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, value, n AS n_versions
FROM ({_NEWEST}) WHERE k = 1""", "A-17")
def q_cell_versions(spark, sf_dir):
    cells = _order_cells(spark, sf_dir)
    counts = cells.groupBy("rowkey", "family", "qualifier").agg(F.count(F.lit(1)).alias("n_versions"))
    return M.newest_cells(cells).join(counts, ["rowkey", "family", "qualifier"]).withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


def _order_rows(where: str) -> str:
    return f"""SELECT rowkey, MAX(CASE WHEN qualifier = 'o_orderstatus' THEN value END) AS status,
 TRY_CAST(MAX(CASE WHEN qualifier = 'o_totalprice' THEN value END) AS DOUBLE) AS price,
 MAX(CASE WHEN qualifier = 'o_orderpriority' THEN value END) AS priority
FROM (SELECT rowkey, qualifier, value, row_number() OVER (PARTITION BY rowkey, qualifier ORDER BY ts DESC, value DESC NULLS LAST) AS k
 FROM ({_ORDER_CELLS}) {where}) WHERE k = 1 GROUP BY rowkey"""


@register("catalog_newest", _order_rows(""), "A-11", "A-17")
def q_catalog_newest(spark, sf_dir):
    return M.catalog_read(_order_cells(spark, sf_dir), _ORDER_CATALOG, "o")


@register("catalog_as_of", _order_rows(f"WHERE ts <= {_MID}"), "A-11", "A-17")
def q_catalog_as_of(spark, sf_dir):
    # As of the middle of the order dates.
    day = F.col("o_orderdate").cast("timestamp")
    lo, hi = fx.table(spark, sf_dir, "orders").agg(F.unix_seconds(F.min(day)), F.unix_seconds(F.max(day))).first()
    middle = F.date_trunc("day", F.timestamp_seconds(F.lit((lo + hi) // 2)))
    return M.catalog_read(_order_cells(spark, sf_dir), _ORDER_CATALOG, "o", middle)


@register("schema_discovery", f"""SELECT DISTINCT c.family, c.qualifier, COALESCE(t.type, 'string') AS type
FROM ({_CELLS_SQL}) c LEFT JOIN (VALUES {", ".join(f"('{q}', '{t}')" for q, t in _TYPES)}) AS t(qualifier, type)
 ON t.qualifier = c.qualifier""", "A-12", "E-10")
def q_schema_discovery(spark, sf_dir):
    items = ", ".join(f"named_struct('qualifier', '{q}', 'type', '{t}')" for q, t in _TYPES)
    types = spark.range(1).select(F.inline(F.expr(f"array({items})")))
    return M.discover_schema(_cells(spark, sf_dir), types)


@register("typed_view", """SELECT 'c' || CAST(c_custkey AS VARCHAR) AS rowkey, c_name AS name,
 CAST(c_nationkey + 18 AS INTEGER) AS age, c_mktsegment AS password FROM customer""", "L-3")
def q_typed_view(spark, sf_dir):
    c = fx.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("rowkey"), F.col("c_name").alias("name"),
        (F.col("c_nationkey") + 18).alias("age"), F.col("c_mktsegment").alias("password"))
    return M.typed_view(c, SC.USER)


@register("inline_rows", """SELECT 'rk' || CAST(c_custkey AS VARCHAR) AS rowkey, c_name AS name,
 CAST(c_nationkey AS INTEGER) AS age FROM customer""", "A-14", "B-4", "I-10")
def q_inline_rows(spark, sf_dir):
    # Comma-separated text rows (with padding) split back into typed columns.
    c = fx.table(spark, sf_dir, "customer")
    lines = c.select(F.concat_ws(",", F.concat(F.lit("rk"), F.col("c_custkey").cast("string")),
                                 F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")),
                                 F.col("c_nationkey").cast("string")).alias("line"))
    parts = F.split("line", ",")
    return lines.select(F.trim(parts.getItem(0)).alias("rowkey"), F.trim(parts.getItem(1)).alias("name"),
                        F.trim(parts.getItem(2)).cast("int").alias("age"))


# Lines of text, one an order: the newest order of a customer is the row of its key.  Some lines can't be taken.
_TEXT_ROW = T.StructType([T.StructField("rowkey", T.StringType()), T.StructField("status", T.StringType()), T.StructField("cents", T.IntegerType()), T.StructField("day", T.DateType()), T.StructField("orderkey", T.LongType())])
_TEXT_LINES = """SELECT o_orderkey, 'c' || CAST(o_custkey AS VARCHAR) AS rowkey, o_orderstatus AS status, CAST(ROUND(o_totalprice * 100) AS INTEGER) AS cents,
 CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderkey % 101 = 0 THEN '3 cells instead of 5' WHEN o_orderkey % 89 = 0 THEN 'rowkey is empty'
 WHEN o_orderkey % 97 = 0 THEN 'cents is no int' END AS reason FROM orders"""


def _text_write(spark, sf_dir) -> str:
    o, key = fx.table(spark, sf_dir, "orders"), F.col("o_orderkey")
    rowkey = F.when(key % 89 == 0, F.lit("")).otherwise(F.concat(F.lit("c"), F.col("o_custkey").cast("string")))
    cents = F.when(key % 97 == 0, F.lit("n/a")).otherwise(F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string"))
    cells = [rowkey, F.concat(F.lit(" "), "o_orderstatus", F.lit(" ")), cents]
    whole = F.concat_ws(",", *cells, F.date_format("o_orderdate", "yyyy-MM-dd"), key.cast("string"))
    lines = o.select(F.when(key % 101 == 0, F.concat_ws(",", *cells)).otherwise(whole).alias("line"))
    root = scratch_path(spark, "typed-write")
    for _ in range(2):  # a second delivery changes nothing
        TR.typed_write(lines, _TEXT_ROW, root, ["rowkey"], ["day", "orderkey"])
    return root


@register("typed_write", f"""SELECT rowkey, status, cents, strftime(day, '%Y-%m-%d') AS day, o_orderkey AS orderkey FROM (
SELECT *, row_number() OVER (PARTITION BY rowkey ORDER BY day DESC, o_orderkey DESC) AS k FROM ({_TEXT_LINES}) WHERE reason IS NULL) WHERE k = 1""", "B-4", "B-1", "I-10")
def q_typed_write(spark, sf_dir):
    return TR.read_typed(spark, _text_write(spark, sf_dir), _TEXT_ROW).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@register("typed_write_rejects", f"""SELECT line, reason, COUNT(*) AS n FROM (
SELECT CASE WHEN o_orderkey % 89 = 0 THEN '' ELSE rowkey END || ', ' || status || ' ,' || CASE WHEN o_orderkey % 97 = 0 THEN 'n/a' ELSE CAST(cents AS VARCHAR) END
 || CASE WHEN o_orderkey % 101 = 0 THEN '' ELSE ',' || strftime(day, '%Y-%m-%d') || ',' || CAST(o_orderkey AS VARCHAR) END AS line, reason
FROM ({_TEXT_LINES}) WHERE reason IS NOT NULL) GROUP BY line, reason""", "B-4")
def q_typed_write_rejects(spark, sf_dir):
    return TR.read_rejected(spark, _text_write(spark, sf_dir)).select("line", "reason", "n")


# ------------------------------------------------------------------ Parquet storage

@register("scan_dimension", with_ctes(
    "SELECT station_name, station_abbr, line_name, description, area, energy_mgr, transfer FROM fx_station",
    ("fx_station",)), "A-7", "A-4")
def q_scan_dimension(spark, sf_dir):
    path = scratch_path(spark, "station-dim")
    stations = world(spark, sf_dir)["stations"].select(*SC.STATION_FILE.fieldNames())
    ST.all_string(stations).write.mode("overwrite").parquet(path)        # stored as text cells
    raw = ST.scan_typed(spark, path, ST.all_string(stations).schema)
    return ST.cast_to(raw, SC.STATION_FILE)


@register("typed_copy", with_ctes(
    f"""SELECT station_abbr || {TICK_TEXT('seq')} || CAST(control_id AS VARCHAR) AS rowkey,
 control_id AS point_id, CAST(strftime(make_timestamp(seq * 1200 * 1000000), '%Y%m%d') AS INTEGER) AS sdate,
 CAST(strftime(make_timestamp(seq * 1200 * 1000000), '%H%M') AS INTEGER) AS time,
 CAST(COALESCE(TRY_CAST(value AS DOUBLE), CAST(0 AS DOUBLE)) AS FLOAT) AS data FROM fx_reading""",
    ("fx_reading",)), "A-15", "B-3")
def q_typed_copy(spark, sf_dir):
    rd = world(spark, sf_dir)["readings"]
    src = rd.select(
        F.concat("station_abbr", tick_text("tick"), F.col("control_id").cast("string")).alias("rowkey"),
        F.col("control_id").alias("point_id"), F.date_format("tick", "yyyyMMdd").alias("sdate"),
        F.date_format("tick", "HHmm").alias("time"),
        F.coalesce(F.col("value").try_cast("double"), F.lit(0.0)).alias("data"))
    path = scratch_path(spark, "typed-copy")
    for _ in range(2):  # a second run writes the same rows again
        ST.typed_copy(src, SC.TYPED_READING, path, ["rowkey"], "sdate")
    return ST.scan_typed(spark, path, SC.TYPED_READING)


@register("upsert_merge", with_ctes(
    f"""SELECT station_abbr, {TICK_TEXT('seq')} AS kpi_time, control_id,
 CASE WHEN value = '\\N' THEN '0' ELSE value END AS value FROM fx_reading""", ("fx_reading",)), "B-1", "B-2")
def q_upsert_merge(spark, sf_dir):
    rd = world(spark, sf_dir)["readings"]
    base = rd.select("station_abbr", "tick", "control_id", "value", F.lit(1).alias("batch"),
                     F.to_date("tick").alias("date"))
    # A correction batch re-sends every null-marked cell as 0.
    fix = base.filter(F.col("value") == NULL_MARKER).withColumn("value", F.lit("0")).withColumn("batch", F.lit(2))
    path = scratch_path(spark, "readings-table")
    keys = ["station_abbr", "tick", "control_id"]
    RN.upsert_into(spark, path, base, keys, "date")
    RN.upsert_into(spark, path, fix, keys, "date")
    RN.upsert_into(spark, path, fix, keys, "date")      # re-delivery of the same batch: idempotent
    out = RN.read_runs(spark, path)
    return out.select("station_abbr", tick_text("tick").alias("kpi_time"), "control_id", "value")
