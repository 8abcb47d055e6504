"""Registered streaming queries: each runs its stream to completion
(availableNow) into a table under the checkpoint folder and returns that
table; the oracle is the equivalent batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltrail.functions.ticks import tick_text
from voltrail.plans import fixtures as fx
from voltrail.plans.oracle_core import R4, TICK_TEXT, with_ctes
from voltrail.plans.q_ingest import drop_folder
from voltrail.plans.registry import register
from voltrail.session import scratch_path
from voltrail.sources import runs as RN
from voltrail.streaming import jobs as J


def _events_stream(spark, sf_dir):
    # The glob takes a single file of that name and a folder of part files alike.
    schema = fx.table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{sf_dir.rstrip('/')}/events.parquet*")


@register("stream_ingest", with_ctes(
    f"SELECT station_abbr, {TICK_TEXT('seq')} AS kpi_time, control_id, value FROM fx_reading", ("fx_reading",)),
    "K-1")
def q_stream_ingest(spark, sf_dir):
    folder = drop_folder(spark, sf_dir)
    root = scratch_path(spark, "stream-tables")
    J.ingest_stream(spark, folder, root, scratch_path(spark, "ckpt-ingest"), max_files=300)
    t = RN.read_runs(spark, f"{root}/readings")
    return t.select("station_abbr", tick_text("tick").alias("kpi_time"), "control_id", "value")


@register("stream_tick_agg", f"""SELECT strftime(time_bucket(INTERVAL 20 MINUTES, ts), '%Y%m%d%H%M%S') AS kpi_time,
 event_type, COUNT(*) AS n, {R4('SUM(value)')} AS total FROM events GROUP BY 1, 2""", "K-2", "F-4")
def q_stream_tick_agg(spark, sf_dir):
    table = scratch_path(spark, "stream-ticks")
    checkpoint = scratch_path(spark, "ckpt-ticks")
    J.tick_agg_stream(_events_stream(spark, sf_dir), table, checkpoint)
    t = J.tick_agg_table(spark, table, checkpoint)
    return t.select(tick_text("tick").alias("kpi_time"), "event_type", "n",
                    (F.round("total", 4) + F.lit(0.0)).alias("total"))


@register("stream_windows", f"""SELECT strftime(time_bucket(INTERVAL 20 MINUTES, ts), '%Y%m%d%H%M%S') AS kpi_time,
 event_type, COUNT(*) AS n, {R4('SUM(value)')} AS total FROM events GROUP BY 1, 2""", "K-2", "F-4")
def q_stream_windows(spark, sf_dir):
    # The events come in three files that each span the whole time, so most of the second and third are late.
    src, table, checkpoint = (scratch_path(spark, n) for n in ("event-files", "stream-windows", "ckpt-windows"))
    ev = fx.table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    for k in range(3):
        ev.where(F.col("event_id") % 3 == k).coalesce(1).write.mode("append").parquet(src)
    J.windows_stream(spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src), table, checkpoint, "6 hours")
    t = J.windows_table(spark, table, checkpoint).groupBy("tick", "event_type").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    return t.select(tick_text("tick").alias("kpi_time"), "event_type", "n", (F.round("total", 4) + F.lit(0.0)).alias("total"))


@register("stream_latest_state", with_ctes(
    """SELECT DISTINCT s.station_abbr, s.id, strftime(s.ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, s.value
FROM fx_status s JOIN (SELECT station_abbr, id, max(ts) AS mt FROM fx_status GROUP BY station_abbr, id) m
 ON s.station_abbr = m.station_abbr AND s.id = m.id AND s.ts = m.mt""", ("fx_status",)), "K-3")
def q_stream_latest_state(spark, sf_dir):
    table = scratch_path(spark, "stream-latest")
    status = fx.status_from_events(_events_stream(spark, sf_dir))
    J.latest_state_stream(status, table, scratch_path(spark, "ckpt-latest"))
    t = J.latest_state_table(spark, table)
    return t.select("station_abbr", "id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "value")
