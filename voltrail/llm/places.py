"""Where a row stands among the rows of its key: exact ranks and running sums, without a task that holds a whole key.

Rows are dealt out by ranges of (key, order) and numbered within their range; only the counts of each
range are added up over a key.  Running sums go by digits of the rank, ``STEP`` rows, then ``STEP`` sums
of such rows and so on, so every window holds at most ``STEP`` rows however many a key has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltrail.llm.store import written

#: Rows, or sums of rows, that one window adds up.
STEP = 1024
#: monotonically_increasing_id: the partition's number, then 33 bits of the row's place in it.
PLACE_BITS = 33


def ranked(df: DataFrame, key: str, order: list[str | Column]) -> DataFrame:
    """``df`` with ``rank`` (rows of its key before it, from 0) and ``n`` (rows of its key).

    ``key`` isn't null.  Rows that are equal in ``order`` may stand in any order; a table in the shared
    folder holds the numbered rows, so a task that runs again can't number them anew.
    """
    sort = [F.col(c) if isinstance(c, str) else c for c in order]
    dealt = df.repartitionByRange(F.col(key), *sort).sortWithinPartitions(F.col(key), *sort)
    rows = written(dealt.withColumn("__id", F.monotonically_increasing_id()), "ranked")
    rows = rows.withColumns({"__part": F.shiftright("__id", PLACE_BITS), "__place": F.col("__id").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))})
    counts = rows.groupBy("__part", key).agg(F.count("*").alias("__rows"), F.min("__place").alias("__first"))
    whole = Window.partitionBy(key)  # a row a range
    earlier = F.sum("__rows").over(whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("__part", key, (F.coalesce(earlier, F.lit(0)) - F.col("__first")).alias("__shift"), F.sum("__rows").over(whole).alias("n"))
    return rows.join(starts, ["__part", key]).select(*(F.col(f"`{c}`") for c in df.columns), (F.col("__place") + F.col("__shift")).alias("rank"), "n")


def running(df: DataFrame, key: str, value: str, most: int) -> DataFrame:
    """``df``, which has ``rank`` (less than ``most``), with ``before``: the sum of ``value`` over its key's lower ranks."""
    rows = df.withColumn("__at", F.expr(f"rank div {STEP}"))
    inside = Window.partitionBy(key, "__at").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    if most > STEP:
        sums = rows.groupBy(key, "__at").agg(F.sum(value).alias("__sum")).withColumnRenamed("__at", "rank")
        up = running(sums, key, "__sum", -(-most // STEP)).select(key, F.col("rank").alias("__at"), F.col("before").alias("__lower"))
        rows = rows.join(up, [key, "__at"]).withColumn("before", F.col("before") + F.col("__lower"))
    return rows.select(*(F.col(f"`{c}`") for c in df.columns), "before")
