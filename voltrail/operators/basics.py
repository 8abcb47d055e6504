"""General relational operators used by the job and its sample programs
(C-2, C-8, C-9, C-11, C-14, E-6, E-7, G-1, 2.M)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltrail.functions.ticks import tick_seq
from voltrail.plans.joins import join_dimension


MOST_COLUMNS = 2000


def key_range(df: DataFrame, key: str, start: str, stop: str) -> DataFrame:
    """Rows with start <= key < stop, as a key-ordered store scans them (2.M); reaches the scan."""
    return df.filter((F.col(key) >= start) & (F.col(key) < stop))


def seq_text(seq: int) -> str:
    """14-digit text of a tick number, computed on the driver for a literal."""
    import datetime as _dt
    t = _dt.datetime(1970, 1, 1) + _dt.timedelta(seconds=int(seq) * 1200)
    return t.strftime("%Y%m%d%H%M%S")


def wide_view(readings: DataFrame, class_points: DataFrame, missing: str = "0") -> DataFrame:
    """C-2: one row per (station, tick) with a column per control id of the
    class (``id_<n>``); a missing cell reads as ``missing``.

    The id list comes from the point dimension; a table has a bounded number of columns, so more
    than ``MOST_COLUMNS`` ids are an error (the long form has no limit).  ``pivot`` with
    explicit values compiles to one conditional aggregation.
    """
    ids = sorted(r[0] for r in class_points.select("control_id").distinct().limit(MOST_COLUMNS + 1).collect())
    if len(ids) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} control ids: use the long form")
    r = readings if "seq" in readings.columns else readings.withColumn("seq", tick_seq("tick"))
    j = join_dimension(r.select("station_abbr", "seq", "control_id", "value"),
                       class_points.select("station_abbr", "control_id").distinct(),
                       ["station_abbr", "control_id"], how="left_semi")
    wide = j.groupBy("station_abbr", "seq").pivot("control_id", ids).agg(F.max("value"))
    return wide.select("station_abbr", "seq",
                       *[F.coalesce(F.col(str(i)), F.lit(missing)).alias(f"id_{i}") for i in ids])


def instants_expression(instants: list[str]) -> str:
    """C-14: the original row filter, keys that end in one of the given instants: ``.*(t1|t2|t3){1}``."""
    return ".*(" + "|".join(instants) + "){1}"


def key_regex_filter(df: DataFrame, key: str, instants: list[str]) -> DataFrame:
    """C-14 over a table that has the text key only; with typed columns ``keyfilter.key_filter`` prunes the scan."""
    return df.filter(F.col(key).rlike(instants_expression(instants)))


#: Hex digits of a sampling hash, and those of a prefix that counts are made by.
HASH_DIGITS, PREFIX_DIGITS = 12, 3


def sample_hash(keys: list[str], seed: int) -> Column:
    """A row's place in [0, 16^12) by its key: the same in every run, partitioning and engine (MD5 of seed and key)."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("\\N")) for k in keys])
    return F.conv(F.left(F.md5(text), F.lit(HASH_DIGITS)), 16, 10).cast("bigint")


def sample_fraction(df: DataFrame, keys: list[str], fraction: float, seed: int = 0) -> DataFrame:
    """2.M: about ``fraction`` of the keys, with all their rows, by a seeded hash: no shuffle, and samples of smaller fractions
    lie within those of larger ones."""
    return df.filter(sample_hash(keys, seed) < F.lit(int(fraction * 16 ** HASH_DIGITS)))


def sample_rows(df: DataFrame, keys: list[str], n: int, seed: int = 0) -> DataFrame:
    """Exactly ``n`` rows (all, if fewer) of the least hashes, of equal ones the least keys; keys tell the rows apart.

    Counts by the hash's first digits say in which prefix the n-th row is: rows of lower prefixes are in, and only that prefix,
    1 in 4,096 of the rows, is sorted."""
    rows = df.withColumn("__hash", sample_hash(keys, seed))
    width = 16 ** (HASH_DIGITS - PREFIX_DIGITS)
    prefix = F.expr(f"__hash div {width}")
    counts = sorted(map(tuple, rows.groupBy(prefix).agg(F.count(F.lit(1))).collect()))  # 4,096 rows at most
    before = 0
    for last, count in counts:
        if before + count >= n:
            break
        before += count
    else:
        return df
    inside = rows.filter(prefix == last)
    rank = F.row_number().over(Window.partitionBy(prefix).orderBy("__hash", *keys))
    edge = inside.withColumn("__rank", rank).filter(F.col("__rank") <= n - before).drop("__rank")
    return rows.filter(prefix < last).unionByName(edge).drop("__hash")


def predicate_mix(customer: DataFrame) -> DataFrame:
    """Comparison, BETWEEN, OR, an expression-string filter, COUNT and SUM in one pass."""
    bal, seg = F.col("c_acctbal"), F.col("c_mktsegment")

    def n(cond: Column) -> Column:
        return F.count(F.when(cond, 1))

    return customer.agg(
        F.count(F.lit(1)).alias("n_all"),
        n(bal > 2600).alias("n_gt"),
        n(bal.between(2600, 4000)).alias("n_between"),
        n((seg == "BUILDING") | (seg == "MACHINERY")).alias("n_or"),
        n(F.expr("5000 >= c_acctbal")).alias("n_expr"),
        F.round(F.sum(bal), 2).alias("sum_bal"),
        F.sum(F.when(bal > 1e12, bal)).alias("sum_empty"),
    )


def group_count(df: DataFrame, key: str, value: str) -> DataFrame:
    v = F.col(value)
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(v), 4).alias("avg_bal"),
                               F.min(v).alias("min_bal"), F.max(v).alias("max_bal"))


def take_ordered(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """G-1: deterministic take(n) — a global top-n (TakeOrderedAndProject:
    each partition keeps its own n, the driver merges n × partitions rows)."""
    return df.orderBy(*order).limit(n)
