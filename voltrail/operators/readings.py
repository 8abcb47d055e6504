"""Analog-reading aggregates per (station, tick): class sums, means, meter deltas.

The plan for any number of ticks at once (SURVEY §7.3):

1. readings LEFT JOIN classified points on (station, control_id) — the point
   map is a dimension, broadcast behind a size check, so the reading scan is
   never shuffled for this join;
2. one ``groupBy(station, seq)`` with a conditional ``sum`` per class — partial
   aggregation runs map-side, so only one row per (station, tick, map task)
   crosses the shuffle.  Each group holds at most one station's points for
   one tick, so a hot station is spread over all its ticks;
3. the rows of the result are managed stations x active ticks (a tick is active
   when any station uploaded at it, one tick or 72 ticks before): each station's
   weeks are joined to the weeks' active ticks, so the grid is as large as the
   output, whatever gaps there are; a station without an upload has sums 0;
4. meter deltas need only the class *sums* at two instants (missing counts as
   0): a per-station range window reads the row exactly 1 or 72 ticks back.
   A station's window partition holds one row per tick, bounded by the time
   span, not by the reading volume.

The sums are the hot table of a job (the grid and the scores both read them) and
are persisted, so the readings are scanned once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltrail.functions.codec import clean_value
from voltrail.functions.ticks import tick_seq
from voltrail.params import DAY_TICKS, MEAN_CLASSES, METER_CLASSES, READING_CLASSES
from voltrail.plans.joins import join_dimension


def with_seq(readings: DataFrame) -> DataFrame:
    return readings if "seq" in readings.columns else readings.withColumn("seq", tick_seq("tick"))


def tick_sums(readings: DataFrame, classified: DataFrame,
              classes: tuple[str, ...] = READING_CLASSES) -> DataFrame:
    """(station_abbr, seq, s_<C> ...): Σ cleaned value over class C at each tick.

    A row exists exactly when the station uploaded at that tick (hasYC), even
    if none of its control ids is classified.
    """
    r = with_seq(readings).select("station_abbr", "seq", "control_id", clean_value("value").alias("v"))
    # Classes as small integers: the per-row conditional sums compare ints, not strings.
    idx = F.coalesce(*[F.when(F.col("cls") == c, F.lit(i)) for i, c in enumerate(classes)])
    cmap = (classified.filter(F.col("cls").isin(*classes))
            .select("station_abbr", "control_id", idx.cast("tinyint").alias("ci")))
    j = join_dimension(r, cmap, ["station_abbr", "control_id"], how="left")
    return j.groupBy("station_abbr", "seq").agg(
        *[F.coalesce(F.sum(F.when(F.col("ci") == i, F.col("v"))), F.lit(0.0)).alias(f"s_{c}")
          for i, c in enumerate(classes)])


def active_ticks(sums: DataFrame) -> DataFrame:
    """(seq): ticks at which a job has data, i.e. some station uploaded at t, t - 1 or t - 72."""
    return sums.select(F.explode(F.array(*[F.col("seq") + k for k in (0, 1, DAY_TICKS)])).alias("seq")).distinct()


#: Ticks of a week, which the grid is joined by.
GRID_TICKS = 7 * DAY_TICKS


def tick_grid(managed: DataFrame, sums: DataFrame, lo: int | None = None, hi: int | None = None, active: DataFrame | None = None) -> DataFrame:
    """``managed`` x active ticks (within lo..hi): every row that a job writes; ``active``: ticks known otherwise.

    A station has a row a week, which is joined to the week's active ticks."""
    active = active_ticks(sums) if active is None else active
    if lo is not None:
        active = active.filter(F.col("seq") >= lo)
    if hi is not None:
        active = active.filter(F.col("seq") <= hi)
    weeks = active.groupBy(F.floor(F.col("seq") / GRID_TICKS).alias("__week")).agg(F.collect_list("seq").alias("__seqs"))
    ends = [weeks.agg(f("__week")).scalar() for f in (F.min, F.max)]
    rows = managed.withColumn("__week", F.explode(F.sequence(*ends))).join(weeks, "__week")
    return rows.select(*managed.columns, F.explode("__seqs").alias("seq"))


def on_grid(grid: DataFrame, sums: DataFrame) -> DataFrame:
    """Grid rows with their sums, 0 where the station has no upload, and ``has`` (it has one)."""
    names = [c for c in sums.columns if c.startswith("s_")]
    x = grid.join(sums.withColumn("has", F.lit(True)), ["station_abbr", "seq"], "left")
    return x.withColumns({**{c: F.coalesce(F.col(c), F.lit(0.0)) for c in names}, "has": F.coalesce(F.col("has"), F.lit(False))})


def class_means(sums: DataFrame, sizes: DataFrame, classes: tuple[str, ...] = MEAN_CLASSES) -> DataFrame:
    """Adds m_<C> = s_<C> / |C| (0 when the station has no point of C)."""
    j = join_dimension(sums, sizes, "station_abbr", how="left")
    means = {}
    for c in classes:
        n = F.coalesce(F.col(f"n_{c}"), F.lit(0))
        means[f"m_{c}"] = F.when(n > 0, F.col(f"s_{c}") / n).otherwise(F.lit(0.0))
    return j.withColumns(means).drop(*[f"n_{c}" for c in classes if f"n_{c}" in sizes.columns])


def _station_window() -> Window:
    return Window.partitionBy("station_abbr").orderBy("seq")


def lag_delta(col: str, lag: int, strict: str | None = None) -> Column:
    """Change of a per-tick sum column over ``lag`` ticks; 0 unless the station uploaded at both.

    ``strict``: a column that says how many of the class's values a row lacks; where either end
    lacks some the change is NULL (Q-9's option)."""
    w = _station_window().rangeBetween(-lag, -lag)
    has = F.col("has")
    paired = has & F.coalesce(F.max(has).over(w), F.lit(False))
    change = F.col(col) - F.max(F.col(col)).over(w)
    if strict is not None:
        change = F.when((F.col(strict) == 0) & (F.max(F.col(strict)).over(w) == 0), change)
    return F.when(paired, change).otherwise(F.lit(0.0))


def meter_deltas(x: DataFrame, lag: int, prefix: str, classes: tuple[str, ...] = METER_CLASSES) -> DataFrame:
    """Adds <prefix>_<C> = sum_C v_t - sum_C v_(t-lag) when both uploads exist, else 0."""
    if "has" not in x.columns:
        x = x.withColumn("has", F.lit(True))
    return x.withColumns({f"{prefix}_{c}": lag_delta(f"s_{c}", lag) for c in classes})
