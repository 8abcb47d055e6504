"""Cell tables and catalog-mapped reads (A-11, A-12, A-17, E-10, L-3).

A key/value store holds cells (rowkey, family, qualifier, timestamp, value), of which
several may be versions of one.  The DataFrame equivalents:

* ``to_cells``   — ``unpivot`` a table into cells (the cell scan), with their timestamp where the table has one;
* ``newest_cells`` — the version of each cell that counts, now or as of a time: a partial ``max`` of
  (timestamp, value), so a cell with very many versions is one row a task before the shuffle;
* ``catalog_read`` — a mapping {qualifier: (column, type)} applied with one
  ``groupBy(rowkey)``, newest version per column, then casts;
* ``discover_schema`` — distinct (family, qualifier) typed by lookup, default
  ``string``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltrail.plans.joins import join_dimension


def to_cells(df: DataFrame, rowkey, family: str, columns: list[str], ts: Column | None = None) -> DataFrame:
    """(rowkey, family, qualifier[, ts], value): a cell per row and column; ``ts`` is when the row was written."""
    keys = ["rowkey"] if ts is None else ["rowkey", "ts"]
    base = df.select(rowkey.alias("rowkey"), *([] if ts is None else [ts.alias("ts")]), *[F.col(c).cast("string").alias(c) for c in columns])
    cells = base.unpivot(keys, columns, "qualifier", "value")
    return cells.select("rowkey", F.lit(family).alias("family"), "qualifier", *keys[1:], "value")


def as_of_time(cells: DataFrame, as_of: Column | None) -> DataFrame:
    """The versions written at ``as_of`` or before; the comparison reaches the scan."""
    return cells if as_of is None else cells.filter(F.col("ts") <= as_of)


def newest_cells(cells: DataFrame, as_of: Column | None = None) -> DataFrame:
    """(rowkey, family, qualifier, ts, value): the newest version of each cell.

    Of versions of one time the greatest text counts, and a value before none: the same whatever their order."""
    last = as_of_time(cells, as_of).groupBy("rowkey", "family", "qualifier").agg(F.max(F.struct("ts", "value")).alias("last"))
    return last.select("rowkey", "family", "qualifier", "last.*")


def catalog_read(cells: DataFrame, catalog: dict[str, tuple[str, str]], family: str | None = None, as_of: Column | None = None) -> DataFrame:
    """Rows of typed columns from cells; ``catalog`` = {qualifier: (column, type)}.

    Cells with a timestamp are read in their newest version (at ``as_of`` or before); cells without have one."""
    c = cells if family is None else cells.filter(F.col("family") == family)
    c = as_of_time(c, as_of)
    version = F.struct("ts", "value") if "ts" in cells.columns else F.struct("value")
    wide = c.groupBy("rowkey").agg(*[F.max(F.when(F.col("qualifier") == q, version)).alias(q) for q in catalog])
    return wide.select("rowkey", *[F.col(f"`{q}`.value").try_cast(t).alias(name) for q, (name, t) in catalog.items()])


def discover_schema(cells: DataFrame, types: DataFrame) -> DataFrame:
    """(family, qualifier, type): every column present, typed by ``types``
    (qualifier, type) with ``string`` as the default."""
    found = cells.select("family", "qualifier").distinct()
    j = join_dimension(found, types, "qualifier", how="left")
    return j.select("family", "qualifier", F.coalesce(F.col("type"), F.lit("string")).alias("type"))


def typed_view(df: DataFrame, schema) -> DataFrame:
    """L-3: the typed-Dataset view as a cast to a StructType."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
