"""Drop-folder files: discover, route and parse (A-1 .. A-6), plus an exporter.

File names (split on ``_`` after dropping the extension):

* 2 tokens  ``<tick>_<table>.txt``                         dimension (center / line / point)
* 4 tokens  ``<tick>_hisdataYX_<line>_<station>.txt``      status changes: id, time, value
* 5 tokens  ``<tick>_hisdata_<line>_<station>_<n>.txt``    analog chunk n: time, values
* anything else is ignored.

An analog chunk file holds one row per upload: the time, then the values of
control ids ``(n − 1) * 200 + position``.  Everything is read in one
``spark.read.text`` scan with ``_metadata.file_name``; routing and parsing are
column expressions, and a tick selects its files with ``pathGlobFilter`` at
listing time, before any data is read.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltrail.functions.codec import digits_only, strip_ext
from voltrail.plans.joins import join_dimension
from voltrail.session import file_system, scratch_path

# fixed value: analog values per chunk file
CHUNK_WIDTH = 200


# ------------------------------------------------------------------ reading

def read_drop(spark: SparkSession, folder: str, tick: str | None = None) -> DataFrame:
    """(file_name, modified, line) of every file in the folder, or only those whose name
    starts with ``tick`` (A-1)."""
    return _lines(spark.read.option("pathGlobFilter", f"{tick}*" if tick else "*").text(folder))


def read_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file_name, modified, line) of the named files."""
    return _lines(spark.read.text(paths))


def _lines(r: DataFrame) -> DataFrame:
    return r.select(F.col("_metadata.file_name").alias("file_name"),
                    F.col("_metadata.file_modification_time").alias("modified"), F.col("value").alias("line"))


def route(df: DataFrame) -> DataFrame:
    """A-2: adds drop_tick, kind, table_name, station_abbr, chunk from the file name."""
    tok = F.split(strip_ext("file_name"), "_")
    n = F.size(tok)
    return df.select(
        "*",
        tok.getItem(0).alias("drop_tick"),
        F.when(n == 2, F.lit("dimension")).when(n == 4, F.lit("status")).when(n == 5, F.lit("analog"))
        .otherwise(F.lit("ignored")).alias("kind"),
        F.when(n == 2, tok.getItem(1)).alias("table_name"),
        F.when((n == 4) | (n == 5), tok.getItem(3)).alias("station_abbr"),
        F.when(n == 5, tok.getItem(4).try_cast("int")).alias("chunk"),
    )


def fields(line: Column | str = "line") -> Column:
    """A-3: tab-split; trailing empty fields are kept (pad-to-schema below)."""
    return F.split(F.col(line) if isinstance(line, str) else line, "\t")


def _field(f: Column, i: int, t: T.DataType) -> Column:
    v = F.when(F.size(f) > i, f.getItem(i))
    v = F.when((v == "") | (v == "\\N"), F.lit(None)).otherwise(v)
    return v if isinstance(t, T.StringType) else v.try_cast(t)


def dimension_rows(routed: DataFrame, table: str, schema: T.StructType, carry: tuple[str, ...] = ()) -> DataFrame:
    """A-4: one dimension table from its files, positional columns, short rows padded with NULL.

    ``carry``: columns of ``routed`` kept beside them (what orders writes)."""
    d = routed.filter((F.col("kind") == "dimension") & (F.col("table_name") == table))
    f = fields()
    return d.select(*[_field(f, i, fld.dataType).alias(fld.name) for i, fld in enumerate(schema.fields)], *carry)


def status_rows(routed: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """A-5: (station_abbr, id, ts, value); the time keeps its digits only."""
    d = routed.filter(F.col("kind") == "status")
    f = fields()
    return d.select(
        "station_abbr",
        f.getItem(0).try_cast("int").alias("id"),
        F.try_to_timestamp(digits_only(f.getItem(1)), F.lit("yyyyMMddHHmmss")).alias("ts"),
        f.getItem(2).alias("value"),
        *carry,
    )


def analog_rows(routed: DataFrame, width: int = CHUNK_WIDTH, carry: tuple[str, ...] = ()) -> DataFrame:
    """A-6: chunk rows to the long form (station_abbr, tick, control_id, value).

    ``posexplode`` of the value fields; control id = (chunk − 1) * width + position.
    Empty fields are absent cells and produce no row.  The time is parsed before the explode, once a line."""
    d = routed.filter(F.col("kind") == "analog").withColumn("__f", fields())
    f = F.col("__f")
    x = d.select("station_abbr", "chunk", *carry,
                 F.try_to_timestamp(digits_only(f.getItem(0)), F.lit("yyyyMMddHHmmss")).alias("tick"),
                 F.slice(f, 2, F.size(f) - 1).alias("__cells"))
    x = x.select("station_abbr", "chunk", *carry, "tick", F.posexplode("__cells").alias("pos", "value"))
    return x.filter(F.col("value") != "").select(
        "station_abbr", "tick", ((F.col("chunk") - 1) * width + F.col("pos")).cast("int").alias("control_id"), "value", *carry)


def reason(kind_tables: dict[str, tuple[T.StructType, list[str]]]) -> Column:
    """Why a routed line can't be taken, null where it can: its file's name says no kind or no known table, its
    chunk number, id, time or a key field can't be read."""
    f, kind = fields(), F.col("kind")

    def unread_time(i: int) -> Column:
        return F.try_to_timestamp(digits_only(f.getItem(i)), F.lit("yyyyMMddHHmmss")).isNull()
    status = F.when(F.size(f) < 3, "fields").when(f.getItem(0).try_cast("int").isNull(), "id").when(unread_time(1), "time")
    analog = F.when(F.coalesce(F.col("chunk") < 1, F.lit(True)), "chunk").when(unread_time(0), "time")
    keyless, known = F.lit(None).cast("string"), F.lit(False)
    for name, (schema, keys) in kind_tables.items():
        mine = F.col("table_name") == name
        types = {x.name: (i, x.dataType) for i, x in enumerate(schema.fields)}
        none = F.lit(False)
        for k in keys:
            none = none | _field(f, *types[k]).isNull()
        keyless, known = F.when(mine & none, "key").otherwise(keyless), known | mine
    return (F.when(kind == "ignored", "name").when(kind == "status", status).when(kind == "analog", analog)
            .when(~known, "table").otherwise(keyless))


# ------------------------------------------------------------------ writing (exporter)

def write_files(lines: DataFrame, folder: str) -> None:
    """Write (file_name, line) rows as flat text files under ``folder``, on any file system.

    Spark's text writer makes a folder per file name, with one part each (a file's rows are one
    task's); the committed parts are then renamed, which moves no data.
    """
    spark = lines.sparkSession
    parts = scratch_path(spark, "drop-parts")
    lines = lines.select("file_name", "line").repartition("file_name").sortWithinPartitions("file_name", "line")
    lines.write.partitionBy("file_name").text(parts)
    system, to = file_system(spark, folder)
    system.mkdirs(to)
    found = system.globStatus(file_system(spark, f"{parts}/file_name=*/part-*")[1])

    def move(i: int) -> None:
        part = found[i].getPath()
        name = part.getParent().getName().removeprefix("file_name=")
        if not system.rename(part, file_system(spark, f"{folder}/{name}")[1]):
            raise OSError(f"{part} can't be renamed")
    with ThreadPoolExecutor(16) as pool:  # a rename waits for the store, not for this machine
        list(pool.map(move, range(len(found))))


def _seq_text(seq: int) -> str:
    import datetime as _dt
    return (_dt.datetime(1970, 1, 1) + _dt.timedelta(seconds=seq * 1200)).strftime("%Y%m%d%H%M%S")


def _tick_text(seq: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seq * 1200), "yyyyMMddHHmmss")


def export_lines(lines_dim: DataFrame, stations: DataFrame, points: DataFrame,
                 readings: DataFrame, status: DataFrame, per_tick: bool = False, span: int = 72) -> DataFrame:
    """(file_name, line) for a whole drop folder: dimension files at the first
    span of ticks, and one status file and one file per analog chunk per station and span.

    ``per_tick``: files of each tick instead, with the readings of the tick and the status changes before it."""
    span, until = (1, 1) if per_tick else (span, 0)

    def named(seq: Column) -> Column:
        return _tick_text(F.floor(seq / span) * span)
    abbr = stations.join(lines_dim.select("line_name", "line_abbr"), "line_name").select("station_abbr", "line_abbr")
    # The dimension files carry the first span's tick (one small aggregate).
    first = readings.agg(F.min(F.floor(F.col("seq") / span) * span)).first()[0]
    t0 = _seq_text(int(first))

    def dim(df: DataFrame, table: str, cols: list[str]) -> DataFrame:
        line = F.concat_ws("\t", *[F.col(c).cast("string") for c in cols])
        return df.select(F.lit(f"{t0}_{table}.txt").alias("file_name"), line.alias("line"))

    center = dim(lines_dim, "center", ["line_name", "line_abbr", "project_name", "description", "energy_mgr"])
    line = dim(stations, "line", ["station_name", "station_abbr", "line_name", "description", "area",
                                  "energy_mgr", "transfer"])
    point = dim(points, "point", ["line_name", "station_name", "point_name", "type", "control_id", "equipment_id",
                                  "equipment_name", "data_type", "statics", "unit", "quantity", "lower_limit",
                                  "upper_limit", "description"])
    st = join_dimension(status, abbr, "station_abbr").select(
        F.concat(named(F.floor(F.unix_seconds("ts") / 1200) + until), F.lit("_hisdataYX_"), "line_abbr",
                 F.lit("_"), "station_abbr", F.lit(".txt")).alias("file_name"),
        F.concat_ws("\t", F.col("id").cast("string"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), "value")
        .alias("line"))
    r = readings.select("station_abbr", "seq", "tick", "value",
                        (F.floor(F.col("control_id") / CHUNK_WIDTH) + 1).alias("chunk"),
                        (F.col("control_id") % CHUNK_WIDTH).alias("pos"))
    g = r.groupBy("station_abbr", "seq", "tick", "chunk").agg(
        F.map_from_entries(F.collect_list(F.struct("pos", "value"))).alias("m"), F.max("pos").alias("maxpos"))
    cells = F.transform(F.sequence(F.lit(0), F.col("maxpos")), lambda i: F.coalesce(F.col("m")[i], F.lit("")))
    yc = join_dimension(g, abbr, "station_abbr").select(
        F.concat(named(F.col("seq")), F.lit("_hisdata_"), "line_abbr", F.lit("_"), "station_abbr",
                 F.lit("_"), F.col("chunk").cast("string"), F.lit(".txt")).alias("file_name"),
        F.concat_ws("\t", F.date_format("tick", "yyyy-MM-dd HH:mm:ss"), F.array_join(cells, "\t")).alias("line"))
    return center.unionByName(line).unionByName(point).unionByName(st).unionByName(yc)
