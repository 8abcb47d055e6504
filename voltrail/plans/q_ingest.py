"""Registered queries: drop-folder ingest (A-1 .. A-6).

The fixture tables are exported once per (session, input) as a drop folder
under the shared checkpoint folder, then read back with the ingest operators;
the oracle derives the same files and rows from the fixture views directly.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from voltrail import schemas as SC
from voltrail.functions.ticks import tick_text
from voltrail.plans import fixtures as fx
from voltrail.plans.oracle_core import TICK_TEXT, with_ctes
from voltrail.plans.q_kpi import _memo, world
from voltrail.plans.registry import register
from voltrail.session import scratch_path
from voltrail.sources import dropfolder as DF
from voltrail.sources import ledger as LG
from voltrail.sources import runs as RN
from voltrail.sources import store as ST
from voltrail.streaming import jobs as J


#: Ticks of a file: a week's, so that the export is some hundred files.
FILE_TICKS = 504


def drop_folder(spark, sf_dir) -> str:
    def make():
        w = world(spark, sf_dir)
        folder = scratch_path(spark, "drop")
        lines = DF.export_lines(w["lines"], w["stations"], fx.fx_point(spark, sf_dir), w["readings"], w["status"], span=FILE_TICKS)
        DF.write_files(lines, folder)
        return folder
    return _memo(spark, (sf_dir, "drop"), make)


def routed(spark, sf_dir):
    return DF.route(DF.read_drop(spark, drop_folder(spark, sf_dir)))


_DAY = f"strftime(make_timestamp(CAST(floor({{s}} / {FILE_TICKS}) * {FILE_TICKS} AS BIGINT) * 1200 * 1000000), '%Y%m%d%H%M%S')"
_ABBR = ("abbr", ("""SELECT s.station_abbr, l.line_abbr FROM fx_station s JOIN fx_line l ON l.line_name = s.line_name""",
                  ("fx_station", "fx_line")))
_T0 = ("t0", (f"SELECT {_DAY.format(s='min(seq)')} AS t0 FROM fx_reading", ("fx_reading",)))
_FILES = ("files", (f"""
SELECT t0 || '_center.txt' AS file_name, 'dimension' AS kind, 'center' AS table_name, NULL AS station_abbr,
 NULL AS chunk, 5 AS n_fields, (SELECT COUNT(*) FROM fx_line) AS n_lines FROM t0
UNION ALL SELECT t0 || '_line.txt', 'dimension', 'line', NULL, NULL, 7, (SELECT COUNT(*) FROM fx_station) FROM t0
UNION ALL SELECT t0 || '_point.txt', 'dimension', 'point', NULL, NULL, 13,
 (SELECT COUNT(*) FROM fx_point WHERE type = 'YC') FROM t0
UNION ALL SELECT t0 || '_point.txt', 'dimension', 'point', NULL, NULL, 14,
 (SELECT COUNT(*) FROM fx_point WHERE type = 'YX') FROM t0
UNION ALL SELECT {_DAY.format(s='floor(epoch_us(st.ts) / 1200000000)')} || '_hisdataYX_' || a.line_abbr || '_'
 || st.station_abbr || '.txt', 'status', NULL, st.station_abbr, NULL, 3, COUNT(*)
 FROM fx_status st JOIN abbr a ON a.station_abbr = st.station_abbr GROUP BY 1, 4
UNION ALL SELECT {_DAY.format(s='r.seq')} || '_hisdata_' || a.line_abbr || '_' || r.station_abbr || '_'
 || CAST(CAST(floor(r.control_id / 200) + 1 AS INTEGER) AS VARCHAR) || '.txt', 'analog', NULL, r.station_abbr,
 CAST(floor(r.control_id / 200) + 1 AS INTEGER), 1 + max(r.control_id % 200) + 1, COUNT(DISTINCT r.seq)
 FROM fx_reading r JOIN abbr a ON a.station_abbr = r.station_abbr GROUP BY 1, 4, 5""",
                    ("t0", "abbr", "fx_line", "fx_station", "fx_point", "fx_status", "fx_reading")))
_EXTRA = dict([_ABBR, _T0, _FILES])


@register("ingest_discover", with_ctes(
    """SELECT substring(file_name, 1, 14) AS drop_tick, COUNT(DISTINCT file_name) AS n_files,
 SUM(n_lines) AS n_lines FROM files GROUP BY 1""", ("files",), _EXTRA), "A-1")
def q_ingest_discover(spark, sf_dir):
    r = routed(spark, sf_dir)
    return r.groupBy("drop_tick").agg(F.countDistinct("file_name").alias("n_files"),
                                      F.count(F.lit(1)).alias("n_lines"))


@register("ingest_route", with_ctes(
    "SELECT DISTINCT file_name, kind, table_name, station_abbr, chunk FROM files", ("files",), _EXTRA), "A-2", "I-6")
def q_ingest_route(spark, sf_dir):
    return routed(spark, sf_dir).select("file_name", "kind", "table_name", "station_abbr", "chunk").distinct()


@register("ingest_tsv", with_ctes(
    "SELECT kind, table_name, n_fields, SUM(n_lines) AS n_lines FROM files GROUP BY 1, 2, 3", ("files",), _EXTRA),
    "A-3", "Q-15")
def q_ingest_tsv(spark, sf_dir):
    r = routed(spark, sf_dir).withColumn("n_fields", F.size(DF.fields()))
    return r.groupBy("kind", "table_name", "n_fields").agg(F.count(F.lit(1)).alias("n_lines"))


@register("ingest_tick", with_ctes(
    """SELECT file_name, SUM(n_lines) AS n_lines FROM files
WHERE starts_with(file_name, (SELECT max(substring(file_name, 1, 14)) FROM files)) GROUP BY 1""", ("files",), _EXTRA), "A-1")
def q_ingest_tick(spark, sf_dir):
    # The files of the newest tick alone, chosen by their names before any is read.
    folder = drop_folder(spark, sf_dir)
    tick = routed(spark, sf_dir).agg(F.max("drop_tick")).first()[0]
    return DF.read_drop(spark, folder, tick).groupBy("file_name").agg(F.count(F.lit(1)).alias("n_lines"))


def merged_twice(spark, sf_dir, name):
    """A table that its files were delivered to at two ticks."""
    root = scratch_path(spark, "ingest")
    for epoch in (0, 1):
        r = routed(spark, sf_dir)
        later = F.when(F.lit(epoch == 1), F.lit("99991231000000")).otherwise(F.col("drop_tick"))
        J.merge_drop(spark, r.withColumn("drop_tick", later), root, epoch, (name,))
    return RN.read_runs(spark, f"{root}/{name}")


def _dimension_query(key, name, sql, *ids):
    @register(key, sql, *ids)
    def q(spark, sf_dir):
        return merged_twice(spark, sf_dir, name).select(*SC.DIMENSIONS[name][0].fieldNames())
    return q


_dimension_query("ingest_dimension", "point", with_ctes(
    """SELECT line_name, station_name, point_name, type, control_id, 'E' || CAST(control_id AS VARCHAR) AS equipment_id,
 regexp_extract(point_name, '^([A-Z]+)', 1) AS equipment_name,
 CASE WHEN type = 'YX' THEN 'int' ELSE 'float' END AS data_type, 0 AS statics,
 CASE WHEN type = 'YX' THEN '-' ELSE 'kWh' END AS unit, 1 AS quantity, CAST(0 AS DOUBLE) AS lower_limit,
 CAST(100 AS DOUBLE) AS upper_limit, CASE WHEN type = 'YX' THEN 'run status' END AS description FROM fx_point""",
    ("fx_point",)), "A-4")
_dimension_query("ingest_center", "center", with_ctes(
    "SELECT line_name, line_abbr, project_name, description, energy_mgr FROM fx_line", ("fx_line",)), "A-4")
_dimension_query("ingest_line", "line", with_ctes(
    "SELECT station_name, station_abbr, line_name, description, area, energy_mgr, transfer FROM fx_station", ("fx_station",)), "A-4")


@register("ingest_status", with_ctes(
    """SELECT station_abbr, id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, max(value) AS value
FROM fx_status GROUP BY 1, 2, 3""", ("fx_status",)), "A-5")
def q_ingest_status(spark, sf_dir):
    # A file's lines are in order of (id, time, value): of one key the greatest value is written last.
    s = merged_twice(spark, sf_dir, "status")
    return s.select("station_abbr", "id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "value")


@register("ingest_analog_chunk", with_ctes(
    f"SELECT station_abbr, {TICK_TEXT('seq')} AS kpi_time, control_id, value FROM fx_reading", ("fx_reading",)),
    "A-6", "I-7")
def q_ingest_analog_chunk(spark, sf_dir):
    a = DF.analog_rows(routed(spark, sf_dir))
    return a.select("station_abbr", tick_text("tick").alias("kpi_time"), "control_id", "value")


# What arrives damaged: times of id 3's changes to '0', and of uploads at a tick that ends in 40 minutes.
_JUDGED = with_ctes("""SELECT 'status' AS kind, CASE WHEN id = 3 AND value = '0' THEN 'time' ELSE 'good' END AS verdict, COUNT(*) AS n FROM fx_status GROUP BY 1, 2
UNION ALL SELECT 'analog', CASE WHEN seq % 3 = 2 THEN 'time' ELSE 'good' END, COUNT(DISTINCT (station_abbr, seq)) FROM fx_reading GROUP BY 1, 2
UNION ALL SELECT 'dimension', 'good', (SELECT COUNT(*) FROM fx_line) + (SELECT COUNT(*) FROM fx_station) + (SELECT COUNT(*) FROM fx_point)""",
                    ("fx_status", "fx_reading", "fx_line", "fx_station", "fx_point"))


@register("ingest_rejects", _JUDGED, "A-5", "A-6", "K-1")
def q_ingest_rejects(spark, sf_dir):
    # Lines in the tables and in the table of rejected lines together are all lines.
    w, root = world(spark, sf_dir), scratch_path(spark, "damaged")
    lines = DF.export_lines(w["lines"], w["stations"], fx.fx_point(spark, sf_dir), w["readings"], w["status"], span=FILE_TICKS)
    f, kind = DF.fields(), F.col("kind")
    torn = F.when((kind == "status") & (f[0] == "3") & (f[2] == "0"), F.concat_ws("\t", f[0], F.lit("?"), f[2]))
    torn = torn.when((kind == "analog") & F.substring(f[0], 15, 2).eqNullSafe("40"), F.regexp_replace("line", "^[^\t]*", "no time"))
    r = DF.route(lines).withColumn("modified", F.timestamp_seconds(F.lit(0)))
    r = ST.written(r.withColumn("line", F.coalesce(torn, "line")), "damaged-lines")
    J.merge_drop(spark, r, root, 0)
    read = lambda name: RN.read_runs(spark, f"{root}/{name}")
    uploads = read("readings").select("station_abbr", "tick").distinct().select(F.lit("analog").alias("kind"))
    points = read("center").select("part").unionByName(read("line").select("part")).unionByName(read("point").select("part")).select(F.lit("dimension").alias("kind"))
    states = r.where((kind == "status") & DF.reason(SC.DIMENSIONS).isNull()).select("kind")
    good = uploads.unionByName(points).unionByName(states).groupBy("kind").agg(F.count(F.lit(1)).alias("n")).select("kind", F.lit("good").alias("verdict"), "n")
    return good.unionByName(read("rejected").groupBy("kind", F.col("reason").alias("verdict")).agg(F.sum("n").alias("n")))


@register("ingest_ledger", with_ctes(
    "SELECT substring(file_name, 1, 14) AS drop_tick, COUNT(DISTINCT file_name) AS n_files, 0 AS n_again FROM files GROUP BY 1", ("files",), _EXTRA), "A-1", "K-1")
def q_ingest_ledger(spark, sf_dir):
    # The folder's files are taken once; a second listing finds none of them new.
    folder, root = drop_folder(spark, sf_dir), scratch_path(spark, "ledger")
    LG.take_new(spark, folder, root)
    again = LG.new_files(spark, folder, f"{root}/files").select("file_name", F.lit(1).alias("again"))
    files = RN.read_runs(spark, f"{root}/files").join(again, "file_name", "left")
    return files.groupBy(F.left("file_name", F.lit(14)).alias("drop_tick")).agg(F.count(F.lit(1)).alias("n_files"), F.count("again").cast("int").alias("n_again"))
