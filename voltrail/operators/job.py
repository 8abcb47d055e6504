"""The job of one tick (J-14, B-2, A-10): ingest its files, score it, store the scores.

Tables under ``root`` (``sources/runs``: an upsert writes its own rows; partitioned by date, keyed by station and tick):

* ``kpi_real``: d2..d24, ``kpi_status``: the status of each, ``kpi_day``: d1 and the 24-hour scores;
* ``readings``, ``status``, ``center``, ``line``, ``point``: what the drop files brought.

The 24-hour scores read the stored rows of the last 72 ticks, the tick's own among them, so a tick
that is run again replaces its rows and counts once.  Reads name the dates and ticks that they
need, so only those partitions are listed and only those row groups scanned.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltrail.functions.ticks import seq_to_tick, tick_number, tick_seq
from voltrail.operators import kpi as K
from voltrail.params import DAY_COLUMNS, DAY_TICKS, KPI_COLUMNS, TICK_SECONDS, Params
from voltrail.plans.joins import join_dimension
from voltrail.sources import dropfolder as DF
from voltrail.sources import runs as RN
from voltrail.sources import store as ST
from voltrail.streaming import jobs as J

KEYS = ["station_abbr", "tick"]


def day_of(seq: int) -> dt.date:
    return (dt.datetime(1970, 1, 1) + dt.timedelta(seconds=seq * TICK_SECONDS)).date()


def days(lo: int, hi: int) -> Callable[[str], bool]:
    """Whether a date partition holds rows of ticks lo..hi."""
    first, last = day_of(lo).isoformat(), day_of(hi).isoformat()
    return lambda date: first <= date <= last


def between_ticks(df: DataFrame, lo: int, hi: int, time: str = "tick") -> DataFrame:
    """Rows of ticks lo..hi, as literals on the time and, where there is one, the date column."""
    out = df.filter((F.col(time) >= seq_to_tick(F.lit(lo))) & (F.col(time) <= seq_to_tick(F.lit(hi))))
    return out.filter(F.col("date").between(F.lit(day_of(lo)), F.lit(day_of(hi)))) if "date" in df.columns else out


def at_ticks(df: DataFrame, seqs: list[int]) -> DataFrame:
    """Rows of a few ticks (C-8, C-9), as literals on the time and, where there is one, the date column."""
    out = df.filter(F.col("tick").isin(*[seq_to_tick(F.lit(s)) for s in seqs]))
    return out.filter(F.col("date").isin(*sorted({day_of(s) for s in seqs}))) if "date" in df.columns else out


def status_before(status: DataFrame, lo: int, hi: int) -> DataFrame:
    """Status rows strictly between the two ticks."""
    a, b = seq_to_tick(F.lit(lo)), seq_to_tick(F.lit(hi))
    out = status.filter((F.col("ts") > a) & (F.col("ts") < b))
    return out.filter(F.col("date").between(F.lit(day_of(lo)), F.lit(day_of(hi)))) if "date" in status.columns else out


def job_at(world: dict[str, DataFrame], seq: int) -> K.Job:
    """What one tick's formulas read: three instants of readings and 24 hours of status."""
    return K.Job(world["lines"], world["stations"], world["points"], at_ticks(world["readings"], [seq - DAY_TICKS, seq - 1, seq]),
                 status_before(world["status"], seq - DAY_TICKS, seq), lo=seq - DAY_TICKS, hi=seq)


def real_status_at(world: dict[str, DataFrame], p: Params, seq: int, job: K.Job | None = None) -> DataFrame:
    """KPI_real and status rows of one tick."""
    return K.kpi_real_status((job or job_at(world, seq)).inputs().filter(F.col("seq") == seq), p)


def dated(df: DataFrame, *cols: Column | str) -> DataFrame:
    tick = seq_to_tick("seq")
    return df.select("station_abbr", tick.alias("tick"), *cols, F.to_date(tick).alias("date"), F.lit(0).alias("batch"))


def store_real(spark: SparkSession, root: str, real_status: DataFrame) -> None:
    """B-2: KPI_real and status rows into their tables, columns by name."""
    rows = ST.written(real_status, "kpi-rows")
    RN.upsert_into(spark, f"{root}/kpi_real", dated(rows, *KPI_COLUMNS), KEYS, "date")
    RN.upsert_into(spark, f"{root}/kpi_status", dated(rows, *[F.col(f"st_{n}").alias(n) for n in KPI_COLUMNS]), KEYS, "date")


def scan_kpi(spark: SparkSession, root: str, table: str, lo: int, hi: int) -> DataFrame:
    """A-10: stored rows of ticks lo..hi."""
    return between_ticks(RN.read_runs(spark, f"{root}/{table}", days(lo, hi)), lo, hi).drop("batch", "date")


def day_at(spark: SparkSession, root: str, d1: DataFrame, seq: int) -> DataFrame:
    """(station_abbr, seq, d1, d2..d24): 24-hour scores of one tick from the stored rows (J-13, E-2)."""
    lo = seq - DAY_TICKS + 1
    real = scan_kpi(spark, root, "kpi_real", lo, seq)
    status = scan_kpi(spark, root, "kpi_status", lo, seq).select(*KEYS, *[F.col(n).alias(f"st_{n}") for n in KPI_COLUMNS])
    sums = real.join(status, KEYS).groupBy("station_abbr").agg(*[F.sum(c).alias(c) for n in KPI_COLUMNS for c in (n, f"st_{n}")])
    cols = [F.when(F.col(f"st_{n}") == 0, F.lit(0.0)).otherwise(F.col(n) / F.col(f"st_{n}")).alias(n) for n in KPI_COLUMNS]
    return d1.filter(F.col("seq") == seq).select("station_abbr", "seq", "d1").join(sums, "station_abbr").select("station_abbr", "seq", "d1", *cols)


def stored_world(spark: SparkSession, root: str, lo: int, hi: int) -> dict[str, DataFrame]:
    """The tables that were ingested; of readings and status, the days of ticks lo..hi."""
    read = {name: RN.read_runs(spark, f"{root}/{table}") for name, table in (("lines", "center"), ("stations", "line"), ("points", "point"))}
    read |= {name: RN.read_runs(spark, f"{root}/{name}", days(lo, hi)) for name in ("readings", "status")}
    return {name: df.drop("drop_tick", "modified", "batch", "part") for name, df in read.items()}


def score_tick(spark: SparkSession, root: str, p: Params, tick: str, world: dict[str, DataFrame] | None = None) -> None:
    """Scores of the tick (14 digits) into the three KPI tables; a tick that was scored is replaced."""
    seq = tick_number(tick)
    world = world or stored_world(spark, root, seq - DAY_TICKS, seq)
    job = job_at(world, seq)
    try:
        rows = ST.written(real_status_at(world, p, seq, job), "kpi-tick")
    finally:
        job.release()
    store_real(spark, root, rows)
    RN.upsert_into(spark, f"{root}/kpi_day", dated(day_at(spark, root, rows, seq), *DAY_COLUMNS), KEYS, "date")


def run_tick(spark: SparkSession, folder: str, root: str, p: Params, tick: str) -> None:
    """J-14: ingest the drop files whose names start with the tick, then score it."""
    tick_number(tick)  # a malformed tick ends the job before anything is read
    J.merge_drop(spark, ST.written(J.with_targets(DF.route(DF.read_drop(spark, folder, tick))), "drop-lines"), root, 0)
    score_tick(spark, root, p, tick)


# ------------------------------------------------------------------ corrections of past ticks

def differs(new: str, old: str) -> Column:
    """Whether two scores are different, beyond the order of a sum."""
    a, b = F.col(new), F.col(old)
    return F.coalesce(F.abs(a - b) > 1e-9 * F.greatest(F.abs(a), F.abs(b), F.lit(1.0)), ~a.eqNullSafe(b))


def changed_rows(new: DataFrame, old: DataFrame, names: list[str]) -> DataFrame:
    """The rows of ``new`` (station_abbr, tick, names) that ``old`` lacks or has otherwise."""
    before = old.select(*KEYS, *[F.col(n).alias(f"__{n}") for n in names], F.lit(True).alias("__there"))
    other = F.col("__there").isNull()
    for n in names:
        other = other | differs(n, f"__{n}")
    return new.join(before, KEYS, "left").where(other).select(*new.columns)


def newest_tick(spark: SparkSession, root: str) -> int | None:
    """The newest tick that was scored, read from the last day's partition alone."""
    state = RN.state_of(spark, f"{root}/kpi_real")
    if state is None:
        return None
    last = max(e["part"] for e in state["live"]).removeprefix("date=")
    rows = RN.read_runs(spark, f"{root}/kpi_real", lambda date: date == last)
    return rows.agg(F.max(tick_seq("tick"))).first()[0]


def rehandle_from(spark: SparkSession, root: str, p: Params, tick: str, world: dict[str, DataFrame] | None = None,
                  stations: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """J-15 for all that depends on one past tick whose readings or status changes were corrected.

    KPI_real and status of tick s read uploads at s, s - 1 and s - 72 (d1) and the log after s - 72, so a correction
    at t reaches s = t..t+72; the day score of s averages s - 71..s, so it reaches t..t+143.  These rows are
    computed anew for ``stations`` (station_abbr; default: all), up to the newest tick that was scored, and those that
    come out otherwise are upserted: nothing else is written.  An upload at a tick that had none before
    makes rows for every station, so all are taken then.

    Returns the (station_abbr, tick) of the KPI_real and of the day rows that were written.
    """
    t, end = tick_number(tick), newest_tick(spark, root)
    if end is None or t > end:
        raise ValueError(f"tick {tick} has not been scored")
    real_hi, day_hi = min(t + DAY_TICKS, end), min(t + 2 * DAY_TICKS - 1, end)
    world = world or stored_world(spark, root, t - DAY_TICKS, real_hi)
    kept = scan_kpi(spark, root, "kpi_real", t, t)
    if stations is not None and not kept.isEmpty():
        mine = stations.select("station_abbr").distinct()
        ticks = scan_kpi(spark, root, "kpi_real", t - DAY_TICKS, real_hi).select(tick_seq("tick").alias("seq")).distinct()
        world = world | {n: join_dimension(world[n], mine, "station_abbr", "left_semi") for n in ("stations", "readings", "status")}
    else:
        mine = ticks = None
    job = K.Job(world["lines"], world["stations"], world["points"], between_ticks(world["readings"], t - DAY_TICKS, real_hi),
                status_before(world["status"], t - DAY_TICKS, real_hi), lo=t - DAY_TICKS, hi=real_hi, active=ticks)
    try:
        new = ST.written(K.kpi_real_status(job.inputs().where(F.col("seq") >= t), p).withColumn("tick", seq_to_tick("seq")), "rehandle-real")
    finally:
        job.release()

    def of(df: DataFrame) -> DataFrame:
        return df if mine is None else join_dimension(df, mine, "station_abbr", "left_semi")

    def stored(lo: int, hi: int) -> DataFrame:
        status = scan_kpi(spark, root, "kpi_status", lo, hi).select(*KEYS, *[F.col(n).alias(f"st_{n}") for n in KPI_COLUMNS])
        return of(scan_kpi(spark, root, "kpi_real", lo, hi)).join(status, KEYS)
    both = [c for n in KPI_COLUMNS for c in (n, f"st_{n}")]
    real = ST.written(changed_rows(new, stored(t, real_hi), both), "rehandle-changed")
    store_real(spark, root, real)
    d1 = of(scan_kpi(spark, root, "kpi_day", t, day_hi)).select(*KEYS, F.col("d1").alias("__d1")).join(new.select(*KEYS, "d1"), KEYS, "full").select(*KEYS, F.coalesce("d1", "__d1").alias("d1"))
    rows = stored(t - DAY_TICKS + 1, day_hi).join(d1, KEYS, "left").withColumn("seq", tick_seq("tick"))
    day = K.kpi_day(rows).where(F.col("seq") >= t).withColumn("tick", seq_to_tick("seq"))
    day = ST.written(changed_rows(day, of(scan_kpi(spark, root, "kpi_day", t, day_hi)), list(DAY_COLUMNS)), "rehandle-day")
    RN.upsert_into(spark, f"{root}/kpi_day", dated(day, *DAY_COLUMNS), KEYS, "date")
    return real.select(*KEYS), day.select(*KEYS)
