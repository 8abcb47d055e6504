"""Where operators put files that other tasks read: the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a folder of its own only where that is unset on one machine (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage, and a lost executor loses none of it."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Setting, its default, and the size that whole texts are sent to Python workers in.
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m")


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once a session, as ``--py-files`` would.

    A batch of whole texts lies in the JVM and in the worker several times over, so where the
    session has left the size of Arrow batches at its default, they are made smaller."""
    key, default, smaller = BATCH
    if spark.conf.get(key, default) == default:
        spark.conf.set(key, smaller)
    context = spark.sparkContext
    if getattr(context, "_voltrail_shipped", False):
        return
    package = Path(__file__).parents[1]
    to = Path(tempfile.mkdtemp(prefix="voltrail-code-")) / "voltrail.zip"
    with zipfile.ZipFile(to, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(str(to))
    context._voltrail_shipped = True
