"""Structured Streaming jobs (K-1 .. K-3).

The original job ran as a batch every tick from an outside scheduler; these
are the incremental equivalents.  All use ``trigger(availableNow=True)``: a
run processes what has arrived, in bounded micro-batches, and stops.  Their
checkpoints lie in the cluster's shared folder, so a lost executor or a restarted
run resumes where the last committed batch ended.

Every sink gives the same table when a batch, or the whole input, is delivered again: K-1 merges by
key in an order that the data carries, K-2 keeps one partial result per batch and sums them when
read (or closes windows by event time, with late rows beside them), K-3 upserts the newest time of each key and value.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltrail import schemas as SC
from voltrail.session import file_system
from voltrail.sources import dropfolder as DF
from voltrail.sources import runs as RN

#: What tells a later write from an earlier one, before the batch number.
WRITE_ORDER = ("drop_tick", "modified", "batch")


def _run(writer, checkpoint: str) -> None:
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover - surfaced to the caller
        raise RuntimeError(str(q.exception()))


#: Tables that the files of a drop folder are merged into.
TABLES = ("readings", "status", *SC.DIMENSIONS, "rejected")


#: Columns that the table of rejected lines has; equal lines of a file are one row with their number.
REJECTED = ("file_name", "line", "kind", "reason", "n")


def with_targets(routed: DataFrame) -> DataFrame:
    """Adds the ``reason`` that a line can't be taken for (null: it can) and the one of ``TABLES`` that it ``goes_to``."""
    goes_to = (F.when(F.col("reason").isNotNull(), "rejected").when(F.col("kind") == "analog", "readings")
               .when(F.col("kind") == "status", "status").otherwise(F.col("table_name")))
    return routed.withColumn("reason", DF.reason(SC.DIMENSIONS)).withColumn("goes_to", goes_to)


def rejected_lines(routed: DataFrame) -> DataFrame:
    """(file_name, line, kind, reason, n, ..) of the lines that can't be taken."""
    bad = routed.where(F.col("goes_to") == "rejected")
    return bad.groupBy("file_name", "line", "kind", "reason", "drop_tick", "modified").agg(F.count(F.lit(1)).alias("n"))


def merge_drop(spark: SparkSession, routed: DataFrame, root: str, epoch: int, tables: tuple[str, ...] = TABLES) -> None:
    """Merge routed lines of drop files into their tables under ``root``, by key.

    A line that can't be taken goes to ``rejected`` with the reason: every line is in its table or there.  Each table is a
    pass over the lines: lines that are costly to make are stored by the caller, best with their targets (``with_targets``)."""
    if "goes_to" not in routed.columns:
        routed = with_targets(routed)
    write = [F.col("drop_tick"), F.col("modified"), F.lit(epoch).cast("bigint").alias("batch")]

    def of(name: str) -> DataFrame:
        return routed.where(F.col("goes_to") == name)
    a = DF.analog_rows(of("readings"), carry=("drop_tick", "modified"))
    a = a.select("station_abbr", "tick", "control_id", "value", *write, F.to_date("tick").alias("date"))
    s = DF.status_rows(of("status"), carry=("drop_tick", "modified"))
    s = s.select("station_abbr", "id", "ts", "value", *write, F.to_date("ts").alias("date"))
    jobs = [("readings", a, ["station_abbr", "tick", "control_id"], "date"), ("status", s, ["station_abbr", "id", "ts"], "date")]
    for name, (schema, keys) in SC.DIMENSIONS.items():
        d = DF.dimension_rows(of(name), name, schema, carry=("drop_tick", "modified"))
        jobs.append((name, d.select(*schema.fieldNames(), *write, F.lit(name).alias("part")), keys, "part"))
    day = F.left("drop_tick", F.lit(8))
    part = F.when(day.rlike("^[0-9]{8}$"), day).otherwise("other").alias("part")
    jobs.append(("rejected", rejected_lines(routed).select(*REJECTED, *write, part), ["file_name", "line"], "part"))
    present = {r[0] for r in routed.select("goes_to").distinct().collect()}  # names of TABLES
    for name, rows, keys, part in jobs:
        if name in tables and name in present:
            RN.upsert_into(spark, f"{root}/{name}", rows, keys, part, WRITE_ORDER)


def ingest_stream(spark: SparkSession, folder: str, root: str, checkpoint: str, max_files: int = 200) -> None:
    """K-1: new files of the drop folder, of every kind, into the tables under ``root``."""
    src = (spark.readStream.format("text").option("maxFilesPerTrigger", max_files).load(folder)
           .select(F.col("_metadata.file_name").alias("file_name"),
                   F.col("_metadata.file_modification_time").alias("modified"), F.col("value").alias("line")))

    def merge(batch: DataFrame, epoch: int) -> None:
        batch = with_targets(DF.route(batch)).persist()  # read once for all tables
        try:
            merge_drop(batch.sparkSession, batch, root, epoch)
        finally:
            batch.unpersist()

    _run(src.writeStream.foreachBatch(merge), checkpoint)


def _partials(table_path: str, checkpoint: str) -> str:
    """Where the partial results of a run are: a new checkpoint reads all input again, into a table of its own."""
    return f"{table_path}/run={hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}"


def tick_agg_stream(events: DataFrame, table_path: str, checkpoint: str,
                    late: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """K-2: 20-minute tumbling counts and sums per event type.

    No row is dropped, however late it comes: each batch writes its own count and sum per window,
    and ``tick_agg_table`` adds them up.  A caller who wants late rows left out passes ``late``, a
    filter of a batch's rows.
    """
    def merge(batch: DataFrame, epoch: int) -> None:
        rows = batch if late is None else late(batch)
        part = (rows.groupBy(F.window(F.col("ts").cast("timestamp"), "20 minutes").start.alias("tick"), "event_type")
                .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")))
        part.write.mode("overwrite").parquet(f"{_partials(table_path, checkpoint)}/batch={epoch}")

    _run(events.writeStream.foreachBatch(merge), checkpoint)


def tick_agg_table(spark: SparkSession, table_path: str, checkpoint: str) -> DataFrame:
    """(tick, event_type, n, total) of all batches of the run with this checkpoint."""
    parts = spark.read.parquet(_partials(table_path, checkpoint))
    return parts.groupBy("tick", "event_type").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def windows_stream(events: DataFrame, table_path: str, checkpoint: str, delay: str = "1 day") -> None:
    """K-2 by event time: 20-minute windows that close when the watermark (newest ``ts`` less ``delay``) passes their end.

    Open windows are Spark's state; a closed one leaves it and is written once, and rows that come for a closed window
    are written to the late rows whole.  A batch's late rows are those of windows that ended by the watermark of the
    batch before, as the checkpoint's offsets tell: that is what the aggregation leaves out.
    """
    spark = events.sparkSession
    rows = events.select("ts", "event_type", "value", F.struct(*events.columns).alias("row")).withWatermark("ts", delay)
    window = F.window("ts", "20 minutes")
    none = F.lit(None)
    agg = rows.groupBy(window, "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    agg = agg.select(F.col("window.start").alias("tick"), F.col("window.end").alias("ends"), "event_type", "n", "total", none.cast(rows.schema["row"].dataType).alias("row"))
    each = rows.select(window.start.alias("tick"), window.end.alias("ends"), none.cast("string").alias("event_type"), none.cast("bigint").alias("n"), none.cast("double").alias("total"), "row")

    def write(batch: DataFrame, epoch: int) -> None:
        path = _partials(table_path, checkpoint)
        known = F.timestamp_millis(F.lit(_watermark(spark, checkpoint, epoch - 1)))
        batch = batch.persist()
        try:
            closed = batch.where(F.col("row").isNull()).select("tick", "event_type", "n", "total")
            closed.write.mode("overwrite").parquet(f"{path}/closed/batch={epoch}")
            late = batch.where(F.col("row").isNotNull() & (F.col("ends") <= known)).select("tick", "row.*")
            late.write.mode("overwrite").parquet(f"{path}/late/batch={epoch}")
        finally:
            batch.unpersist()

    _run(agg.unionByName(each).writeStream.outputMode("append").foreachBatch(write), checkpoint)


def _watermark(spark: SparkSession, checkpoint: str, epoch: int) -> int:
    """The watermark of a batch in milliseconds; 0 before the first."""
    if epoch < 0:
        return 0
    lines = spark.read.text(f"{checkpoint}/offsets/{epoch}").where(F.col("value").contains("batchWatermarkMs"))
    return lines.select(F.get_json_object("value", "$.batchWatermarkMs").cast("bigint")).first()[0]


def _committed(spark: SparkSession, checkpoint: str) -> int:
    system, where = file_system(spark, f"{checkpoint}/commits")
    names = [s.getPath().getName() for s in system.listStatus(where)] if system.exists(where) else []
    return max((int(n) for n in names if n.isdigit()), default=-1)


def windows_table(spark: SparkSession, table_path: str, checkpoint: str) -> DataFrame:
    """(tick, event_type, n, total, kind) of all rows so far: windows that are closed, open (read from the state) and
    what came late for closed ones."""
    path, last = _partials(table_path, checkpoint), _committed(spark, checkpoint)
    done = F.col("batch") <= last  # the state is that of the last committed batch
    closed = spark.read.parquet(f"{path}/closed").where(done).select("tick", "event_type", "n", "total", F.lit("closed").alias("kind"))
    state = spark.read.format("statestore").load(checkpoint)
    opened = state.select(F.col("key.window.start").alias("tick"), "key.event_type", F.col("value.count").alias("n"), F.col("value.sum").alias("total"), F.lit("open").alias("kind"))
    late = late_rows(spark, table_path, checkpoint).groupBy("tick", "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return closed.unionByName(opened).unionByName(late.withColumn("kind", F.lit("late")))


def late_rows(spark: SparkSession, table_path: str, checkpoint: str) -> DataFrame:
    """The rows that came after their window had closed, with the window's ``tick``: what a rehandle starts from
    (``operators.job.rehandle_from``)."""
    late = spark.read.parquet(f"{_partials(table_path, checkpoint)}/late")
    return late.where(F.col("batch") <= _committed(spark, checkpoint)).drop("batch")


#: Partitions of the state by key.
STATE_BUCKETS = 16


def latest_state_stream(status: DataFrame, table_path: str, checkpoint: str,
                        keys: tuple[str, ...] = ("station_abbr", "id")) -> None:
    """K-3: latest status row(s) per key, different values at one time all kept.

    The state is a table of runs (``sources/runs``) with the newest time of each (key, value), in buckets of the key's hash: a batch
    that touches k keys writes k rows or so, whatever the state holds, and the same batch again changes nothing.
    """
    keys = list(keys)

    def merge(batch: DataFrame, epoch: int) -> None:
        new = batch.groupBy(*keys, "value").agg(F.max("ts").alias("ts")).select(*keys, "ts", "value")
        bucket = F.pmod(F.xxhash64(*keys), F.lit(STATE_BUCKETS)).cast("int").alias("bucket")
        RN.upsert_into(batch.sparkSession, table_path, new.select("*", bucket), [*keys, "value"], "bucket", "ts")

    _run(status.writeStream.foreachBatch(merge), checkpoint)


def latest_state_table(spark: SparkSession, table_path: str, keys: tuple[str, ...] = ("station_abbr", "id")) -> DataFrame:
    """The latest row(s) of each key."""
    state = RN.read_runs(spark, table_path)
    top = state.groupBy("bucket", *keys).agg(F.max("ts").alias("ts"))
    return state.join(top, ["bucket", *keys, "ts"], "left_semi").drop("bucket")
