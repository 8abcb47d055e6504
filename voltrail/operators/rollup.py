"""Hourly station and line rollups of the day scores (E-8, E-9, C-12, C-13).

The day table has one row per station and tick, with the overall score ``all`` (the mean of the
row's scores) beside d1..d24.  Scores outside [0, 100] don't count (the validity guard).  A
station's hour is written if it has a valid overall score.  A line's hour has a row of station
``all`` with the sum of the stations' overall scores; the sums of the other scores are taken over
the station rows alone, and means are over the number of station rows, as the original counts.

Each level is one ``groupBy``; the hour is the integer ``seq // 3`` (three 20-minute ticks), so a
busy station is spread over its hours, and the line level shuffles one row per station and hour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltrail.params import DAY_COLUMNS
from voltrail.plans.joins import join_dimension

TICKS_PER_HOUR = 3
SCORES = ("all", *DAY_COLUMNS)


def with_all(day: DataFrame) -> DataFrame:
    """The day table with the overall score: the mean of the row's scores."""
    return day.withColumn("all", sum((F.col(n) for n in DAY_COLUMNS), F.lit(0.0)) / len(DAY_COLUMNS))


def hourly_station(day: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """(station_abbr, hour_seq, kpi, n, total, mean) of the valid scores of ticks start <= t < end."""
    if start is not None:
        day = day.filter(F.col("seq") >= start)
    if end is not None:
        day = day.filter(F.col("seq") < end)
    kept = with_all(day).withColumns({"hour_seq": F.floor(F.col("seq") / TICKS_PER_HOUR),
                                      **{c: F.when(F.col(c).between(0, 100), F.col(c)) for c in SCORES if c != "all"},
                                      "all": F.when(F.col("all").between(0, 100), F.col("all"))})
    wide = kept.groupBy("station_abbr", "hour_seq").agg(*[f(c).alias(f"{name}_{c}") for c in SCORES for name, f in (("n", F.count), ("t", F.sum))])
    cells = F.array(*[F.struct(F.lit(c).alias("kpi"), F.col(f"n_{c}").alias("n"), F.col(f"t_{c}").alias("total")) for c in SCORES])
    long = wide.filter(F.col("n_all") > 0).select("station_abbr", "hour_seq", F.inline(cells))
    return long.withColumn("mean", F.when(F.col("n") > 0, F.col("total") / F.col("n")))


def hourly_table(station_hours: DataFrame, stations: DataFrame) -> DataFrame:
    """(line_name, station_abbr, hour_seq, kpi, total): the station rows, and a row of station ``all`` per line and hour."""
    rows = join_dimension(station_hours, stations.select("station_abbr", "line_name"), "station_abbr")
    rows = rows.select("line_name", "station_abbr", "hour_seq", "kpi", "total")
    line = rows.filter(F.col("kpi") == "all").groupBy("line_name", "hour_seq", "kpi").agg(F.sum("total").alias("total"))
    return rows.unionByName(line.withColumn("station_abbr", F.lit("all")))


def hourly_line(table: DataFrame) -> DataFrame:
    """(line_name, hour_seq, kpi, n, total, mean) over a line's station rows; ``n`` is how many there are."""
    g = table.filter(F.col("station_abbr") != "all").groupBy("line_name", "hour_seq", "kpi").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total").alias("total"))
    return g.withColumn("mean", F.col("total") / F.col("n"))
