"""Parquet-backed tables: typed scans, keyed upsert, typed copy (A-7, A-15, B-1..B-4).

The original job wrote every cell as a keyed put, so re-ingesting a file is
idempotent and the last write of a key wins.  Here:

* ``upsert`` is a DataFrame operator: the row of the greatest order columns per key wins; of equal
  ones an incoming row wins over a stored one, and of two incoming rows the later.  It is
  ``groupBy(key).agg(max(struct(order, ...)))``: partial aggregation runs map-side, so heavily
  re-sent keys are combined before the shuffle;
* ``merge_into`` applies it to a partitioned Parquet table: the incoming rows are computed once,
  only the partitions they touch are read and overwritten, and the merged rows are a table of
  their own in the shared folder before a partition is replaced.  Tables that grow by small upserts are kept as runs instead (``sources/runs``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltrail.session import file_system, scratch_path


def scan_typed(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A-7: scan with a fixed schema (no inference)."""
    return spark.read.schema(schema).format(fmt).load(path)


def all_string(df: DataFrame) -> DataFrame:
    """Every column as text, the layout of the original key/value store."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast text columns to a typed schema (ANSI ``try_cast``: junk is NULL)."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def order_columns(order: str | Sequence[str]) -> list[str]:
    return [order] if isinstance(order, str) else list(order)


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str], order: str | Sequence[str] = "batch") -> DataFrame:
    """B-1: of the rows of a key in both sides, the one written last.

    Written last: the greatest ``order`` columns, then incoming before existing, then the later of
    the incoming rows (their place in the input, e.g. the line of a file)."""
    order = order_columns(order)
    names = existing.columns
    rest = [c for c in names if c not in keys and c not in order]
    new = incoming.select(*names, F.lit(1).alias("__side"), F.monotonically_increasing_id().alias("__place"))
    old = existing.select(*names, F.lit(0).alias("__side"), F.lit(0).cast("bigint").alias("__place"))
    packed = F.struct(*[F.col(c) for c in [*order, "__side", "__place", *rest]]).alias("__last")
    last = old.unionByName(new).groupBy(*keys).agg(F.max(packed).alias("__last"))
    return last.select(*[F.col(c) if c in keys else F.col(f"__last.{c}").alias(c) for c in names])


def table_exists(spark: SparkSession, path: str) -> bool:
    """A-18: whether there is a folder with data files; a path that can't be looked at is an error."""
    system, where = file_system(spark, path)
    if not system.exists(where):
        return False
    return any(not s.getPath().getName().startswith(("_", ".")) for s in system.listStatus(where))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and no lost executor loses it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def merge_into(spark: SparkSession, path: str, incoming: DataFrame, keys: list[str],
               partition_col: str, order: str | Sequence[str] = "batch") -> None:
    """B-1/B-2: upsert ``incoming`` into the Parquet table at ``path``.

    A key's rows must all lie in one partition."""
    incoming = written(incoming, "incoming")
    if table_exists(spark, path):
        touched = incoming.select(partition_col).distinct()
        stored = spark.read.schema(incoming.schema).parquet(path).join(touched, partition_col, "left_semi")
    else:
        stored = incoming.limit(0)
    merged = written(upsert(stored.select(*incoming.columns), incoming, keys, order), "merged")
    (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))


def typed_copy(src: DataFrame, schema: T.StructType, path: str, keys: list[str], partition_col: str) -> None:
    """B-3: table-to-table copy through a typed schema; a second run writes the same rows again."""
    rows = cast_to(src, schema).withColumn("batch", F.lit(0))
    merge_into(src.sparkSession, path, rows, keys, partition_col)
