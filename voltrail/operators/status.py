"""Run status from the status-change log (D-1, D-5, E-1, E-3, F-3).

``on(C)`` at tick t: 1 when some point of class C has, among its status rows
with t − 24 h < ts < t, a row at the latest such ts whose value is exactly
'1'; else 0 (no rows = off).

Many-tick plan, skew-safe:

1. pre-aggregate the log per (station, id, 20-minute bucket) with
   ``max(struct(ts, is_one))`` — partial aggregation runs map-side; the struct
   max keeps the latest ts and, among rows tied at it, "any is '1'";
2. cut ticks and buckets into blocks of a day.  The look-back is a day, so a tick
   needs its own block and the block before: a bucket row goes to both, in the one
   shuffle that the window makes;
3. union the evaluation ticks (one row per (station, id, t)) with those bucket
   rows and take ``last(…, ignoreNulls)`` over a (station, id, block) window ordered by
   (seq, kind) — a tick sorts before the bucket that starts at it, because the
   upper bound is exclusive.  A window holds three rows a tick of one day at most, so
   years of one busy point are as many windows as days;
4. keep the found bucket only if it lies in the 72-tick window; in the oldest
   bucket only a latest ts strictly after the bucket start counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltrail.functions.ticks import tick_seq
from voltrail.params import DAY_TICKS, RUN_CLASSES, TICK_SECONDS
from voltrail.plans.joins import join_dimension, maybe_broadcast


def latest_state(status: DataFrame, keys=("station_abbr", "id"), ts: str = "ts",
                 lo=None, hi=None) -> DataFrame:
    """Rows at the latest ``ts`` per key, ties kept (D-1), optionally within (lo, hi).

    ``max(ts)`` per key is partial-aggregated, then joined back on
    (keys, ts): the join hashes on the timestamp too, so a hot key does not
    land in one task, and how large the keys are is left to the join.
    """
    s = status
    if lo is not None:
        s = s.filter(F.col(ts) > lo)
    if hi is not None:
        s = s.filter(F.col(ts) < hi)
    keys = list(keys)
    mx = s.groupBy(*keys).agg(F.max(ts).alias(ts))
    return s.join(mx, keys + [ts], "left_semi")


def run_points(classified: DataFrame) -> DataFrame:
    """(station_abbr, id, cls) for the run-status classes."""
    return (classified.filter(F.col("cls").isin(*RUN_CLASSES))
            .select("station_abbr", F.col("control_id").alias("id"), "cls"))


def bucket_latest(status: DataFrame, ids: DataFrame) -> DataFrame:
    """(station_abbr, id, seq, m_ts, m_on) per 20-minute bucket of the log."""
    s = status.join(maybe_broadcast(ids), ["station_abbr", "id"], "left_semi")
    return (
        s.select("station_abbr", "id", tick_seq("ts").alias("seq"),
                 F.struct(F.col("ts").alias("ts"), (F.col("value") == "1").cast("int").alias("on")).alias("m"))
        .groupBy("station_abbr", "id", "seq").agg(F.max("m").alias("m"))
        .select("station_abbr", "id", "seq", F.col("m.ts").alias("m_ts"), F.col("m.on").alias("m_on"))
    )


def point_on_at(status: DataFrame, ids: DataFrame, grid: DataFrame) -> DataFrame:
    """(station_abbr, id, seq, on) for every grid tick and every listed id of the station."""
    block = F.floor(F.col("seq") / DAY_TICKS)
    buckets = bucket_latest(status, ids).select("*", F.explode(F.array(block, block + 1)).alias("block"), F.lit(1).alias("kind"))
    evals = join_dimension(grid.select("station_abbr", "seq", block.alias("block")), ids, "station_abbr").withColumn("kind", F.lit(0))
    u = evals.unionByName(buckets, allowMissingColumns=True)
    w = (Window.partitionBy("station_abbr", "id", "block").orderBy("seq", "kind")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    hit = F.when(F.col("kind") == 1, F.struct(F.col("seq").alias("b"), "m_ts", "m_on"))
    found = u.withColumn("f", F.last(hit, ignorenulls=True).over(w)).filter(F.col("kind") == 0)
    b, t = F.col("f.b"), F.col("seq")
    strictly_after_start = F.unix_micros(F.col("f.m_ts")) > b * F.lit(TICK_SECONDS * 1_000_000)
    in_window = (b >= t - (DAY_TICKS - 1)) | ((b == t - DAY_TICKS) & strictly_after_start)
    return found.select("station_abbr", "id", "seq",
                        F.when(F.col("f").isNotNull() & in_window, F.col("f.m_on")).otherwise(F.lit(0)).alias("on"))


def run_flags(status: DataFrame, classified: DataFrame, grid: DataFrame,
              classes: tuple[str, ...] = RUN_CLASSES) -> DataFrame:
    """(station_abbr, seq, on_<C> ...): any point of C latest-'1' in (t-24h, t) (E-3).

    Stations without any run point have no row; ``with_flags`` takes them as off."""
    rp = run_points(classified).filter(F.col("cls").isin(*classes))
    on = point_on_at(status, rp.select("station_abbr", "id").distinct(), grid)
    j = join_dimension(on, rp, ["station_abbr", "id"])
    return j.groupBy("station_abbr", "seq").agg(
        *[F.coalesce(F.max(F.when(F.col("cls") == c, F.col("on"))), F.lit(0)).cast("double").alias(f"on_{c}") for c in classes])


def with_flags(x: DataFrame, flags: DataFrame, classes: tuple[str, ...] = RUN_CLASSES) -> DataFrame:
    """``x`` with its run flags, off where there are none."""
    out = x.join(flags, ["station_abbr", "seq"], "left")
    return out.withColumns({f"on_{c}": F.coalesce(F.col(f"on_{c}"), F.lit(0.0)) for c in classes})


def status_of_class(status: DataFrame, run_pts: DataFrame) -> DataFrame:
    """D-5 / C-7: status rows of the ids of each class (an IN list as a join)."""
    return join_dimension(status, run_pts, ["station_abbr", "id"])
