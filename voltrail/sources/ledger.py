"""The ledger of taken files (A-1, K-1): which drop files were ingested, so that a listing reads only what is new.

A file is its name, size and modification time: one that was changed is taken again.  The ledger is a table of runs by
the day of the files' tick; a listing (metadata alone, no content) is anti-joined to it.  Files are taken in the
order of their names, that is of their ticks, at most ``max_files`` at a time, and are entered when their rows are
merged: a job that ends between the two takes them once more, which changes no table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltrail.sources import dropfolder as DF
from voltrail.sources import runs as RN
from voltrail.sources import store as ST
from voltrail.streaming import jobs as J

FILE = ["file_name", "size", "modified"]


def listing(spark: SparkSession, folder: str, tick: str | None = None) -> DataFrame:
    """(path, file_name, size, modified) of the folder's files, or of those of one tick."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"{tick}*" if tick else "*").load(folder)
    name = F.substring_index("path", "/", -1).alias("file_name")
    return files.select("path", name, F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def new_files(spark: SparkSession, folder: str, ledger: str, tick: str | None = None) -> DataFrame:
    """The files that the ledger doesn't have as they are."""
    found = listing(spark, folder, tick)
    if RN.state_of(spark, ledger) is None:
        return found
    return found.join(RN.read_runs(spark, ledger).select(*FILE), FILE, "left_anti")


def take_new(spark: SparkSession, folder: str, root: str, tick: str | None = None, max_files: int = 1000) -> int:
    """Ingest the files that weren't taken yet into the tables under ``root``; how many there were."""
    ledger, taken = f"{root}/files", 0
    while True:
        found = new_files(spark, folder, ledger, tick).orderBy("file_name").limit(max_files).collect()  # max_files at most
        if not found:
            return taken
        lines = DF.read_files(spark, [r.path for r in found])
        J.merge_drop(spark, ST.written(J.with_targets(DF.route(lines)), "drop-lines"), root, 0)
        rows = spark.createDataFrame([(r.file_name, r.size, r.modified) for r in found], "file_name string, size bigint, modified timestamp")
        day = F.left("file_name", F.lit(8))
        rows = rows.select("*", F.when(day.rlike("^[0-9]{8}$"), day).otherwise("other").alias("part"))
        RN.upsert_into(spark, ledger, rows, ["file_name"], "part", "modified")
        taken += len(found)
