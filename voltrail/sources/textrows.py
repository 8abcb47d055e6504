"""Typed writes of delimited text (B-4, I-10): each line is split, its cells are cast, and it becomes the row of its key.

``typed_write`` reads the lines once and puts every one of them in one of two tables under ``root`` (``sources/runs``,
in buckets of a hash of the key, so a write costs its own rows):

* ``rows``: the typed cells.  Of lines with one key the greatest ``order`` columns win, then the later write, then the
  later line.
* ``rejected``: (batch, line, reason, n): lines that have another number of cells than the schema, an empty cell in a
  key, or a cell that isn't of its type; equal lines of a batch are one row with their number.

White space around a cell doesn't count, and an empty cell is NULL.  A null line is rejected.  Writing a batch again
changes neither table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltrail.sources import runs as RN
from voltrail.sources import store as ST

REJECTED = T.StructType([T.StructField("batch", T.IntegerType()), T.StructField("line", T.StringType()), T.StructField("reason", T.StringType()), T.StructField("n", T.LongType())])


def split_rows(lines: DataFrame, schema: T.StructType, keys: Sequence[str], sep: str = ",") -> DataFrame:
    """The typed columns of each ``line``, with ``line`` and the ``reason`` it can't be taken for (null: it can)."""
    cells = lines.select("line", F.split("line", f"\\Q{sep}\\E", -1).alias("__cells"))
    texts = [F.nullif(F.trim(F.get("__cells", F.lit(i))), F.lit("")).alias(f"__{f.name}") for i, f in enumerate(schema.fields)]
    cells = cells.select("line", F.size("__cells").alias("__n"), *texts)
    width = len(schema.fields)
    reason = F.when(F.col("line").isNull(), "no line").when(F.col("__n") != width, F.concat(F.col("__n").cast("string"), F.lit(f" cells instead of {width}")))
    for f in schema.fields:
        text = F.col(f"__{f.name}")
        if f.name in keys:
            reason = reason.when(text.isNull(), f"{f.name} is empty")
        reason = reason.when(text.isNotNull() & text.try_cast(f.dataType).isNull(), f"{f.name} is no {f.dataType.simpleString()}")
    return cells.select(*[F.col(f"__{f.name}").try_cast(f.dataType).alias(f.name) for f in schema.fields], "line", reason.alias("reason"))


def typed_write(lines: DataFrame, schema: T.StructType, root: str, keys: Sequence[str], order: Sequence[str] = (),
                batch: int = 0, sep: str = ",", buckets: int = 16) -> None:
    """Write the ``line`` column's rows and the lines that can't be taken; ``batch`` is the write's number."""
    spark = lines.sparkSession
    split = ST.written(split_rows(lines, schema, keys, sep), "typed-lines")

    def bucket(*cols: str):
        return F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int").alias("bucket")
    good = split.where(F.col("reason").isNull()).select(*schema.fieldNames(), F.lit(batch).alias("batch"), bucket(*keys))
    RN.upsert_into(spark, f"{root}/rows", good, keys, "bucket", [*order, "batch"])
    bad = split.where(F.col("reason").isNotNull()).groupBy("line", "reason").agg(F.count(F.lit(1)).alias("n"))
    RN.upsert_into(spark, f"{root}/rejected", bad.select(F.lit(batch).alias("batch"), "line", "reason", "n", bucket("line")), ["batch", "line"], "bucket")


def read_typed(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The rows written so far."""
    return read(spark, f"{root}/rows", schema)


def read_rejected(spark: SparkSession, root: str) -> DataFrame:
    """The lines that were not taken."""
    return read(spark, f"{root}/rejected", REJECTED)


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if RN.state_of(spark, path) is None:  # nothing was written yet
        return spark.createDataFrame([], schema)
    return RN.read_runs(spark, path).select(*schema.fieldNames())
