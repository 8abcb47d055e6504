"""Keyed tables kept as runs (B-1, B-2): an upsert writes its own rows, a reader sees one committed state.

A table is a folder of Parquet runs, ``run=<n>-<id>/<partition>=<value>/``, and of commits, ``_commits/<n>.json``.  A
commit lists the live (run, partition) folders with their bytes; the one with the greatest number is the table.
It is made by a rename that fails where another writer was first, so a write that ends early leaves a run that
no commit names and the old state readable.

* ``upsert_into`` resolves the incoming rows among themselves, writes them as a run and commits it: bytes in
  proportion to its own rows, whatever the table holds.
* Then runs are folded, partition by partition: the newest runs, as long as the one before isn't larger than those
  after it together, become one.  A row is rewritten about as often as its partition doubles, and a partition
  has about as many runs as doublings.
* ``read_runs`` scans partitions of one run as they are, and takes of the others the last write of each key: the greatest order
  columns, then the later run.  Keys and the partition column are what it groups by, so filters on
  them reach the scan as partition and row-group filters.  Spark lists every folder of a scan when it is made, so a reader
  of a few partitions names them (``parts``): the others' folders aren't looked at, however many there are.
* Folders that none of the last ``KEEP`` commits names are removed, so a reader has that many commits' time.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltrail.session import file_system

#: Commits whose folders stay.
KEEP = 8


class Conflict(RuntimeError):
    """Another writer made the commit first."""


def last_write(df: DataFrame, by: Sequence[str], order: Sequence[str], tie: str) -> DataFrame:
    """Of the rows equal in ``by``, that with the greatest ``order`` columns, then the greatest ``tie``; without ``tie``."""
    rest = [c for c in df.columns if c not in by and c not in order and c != tie]
    packed = F.struct(*[F.col(c) for c in [*order, tie, *rest]]).alias("__last")
    found = df.groupBy(*by).agg(F.max(packed).alias("__last"))
    return found.select(*[F.col(c) if c in by else F.col(f"__last.{c}").alias(c) for c in df.columns if c != tie])


def commits(spark: SparkSession, path: str) -> list[int]:
    system, where = file_system(spark, f"{path}/_commits")
    if not system.exists(where):
        return []
    names = [s.getPath().getName() for s in system.listStatus(where)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def commit_at(spark: SparkSession, path: str, number: int) -> dict:
    system, where = file_system(spark, f"{path}/_commits/{number:012d}.json")
    stream = system.open(where)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def state_of(spark: SparkSession, path: str) -> dict | None:
    """The last commit, or None where there is no table."""
    found = commits(spark, path)
    return commit_at(spark, path, found[-1]) if found else None


def commit(spark: SparkSession, path: str, state: dict) -> None:
    """Make ``state`` the table's next state."""
    number = state["number"]
    system, to = file_system(spark, f"{path}/_commits/{number:012d}.json")
    _, draft = file_system(spark, f"{path}/_commits/.{number:012d}-{uuid.uuid4().hex[:8]}")
    out = system.create(draft, False)
    out.write(json.dumps(state).encode())
    out.close()
    if system.exists(to) or not system.rename(draft, to):
        system.delete(draft, False)
        raise Conflict(f"commit {number} of {path} was made by another writer")


def write_run(df: DataFrame, path: str, number: int, partition: str) -> list[dict]:
    """Write a run of resolved rows; its (run, part, bytes) folders.

    A partition's rows come together first, a large one's in several tasks: files are as many as the data's size asks for."""
    spark = df.sparkSession
    run = f"{number:012d}-{uuid.uuid4().hex[:8]}"
    df.hint("rebalance", partition).write.partitionBy(partition).parquet(f"{path}/run={run}")
    system, where = file_system(spark, f"{path}/run={run}")
    parts = [s.getPath() for s in system.listStatus(where) if not s.getPath().getName().startswith(("_", "."))]
    with ThreadPoolExecutor(16) as pool:  # a listing waits for the store, not for this machine
        return list(pool.map(lambda p: {"run": run, "part": p.getName(), "bytes": system.getContentSummary(p).getLength()}, parts))


def scan(spark: SparkSession, path: str, state: dict, live: list[dict]) -> DataFrame:
    """The rows of some folders as they are, with their ``run``."""
    schema = T.StructType.fromJson(state["schema"])
    folders = [f"{path}/run={e['run']}/{e['part']}" for e in live]
    if not folders:
        return spark.createDataFrame([], schema.add("run", "string"))
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("run", T.StringType())])).option("basePath", path).parquet(*folders)


def by_part(live: list[dict]) -> dict[str, list[dict]]:
    found = defaultdict(list)
    for e in sorted(live, key=lambda e: e["run"]):
        found[e["part"]].append(e)
    return found


def resolved(spark: SparkSession, path: str, state: dict, live: list[dict]) -> DataFrame:
    names = T.StructType.fromJson(state["schema"]).names
    parts = by_part(live)
    one = scan(spark, path, state, [e for es in parts.values() if len(es) == 1 for e in es]).drop("run")
    several = [e for es in parts.values() if len(es) > 1 for e in es]
    if not several:
        return one.select(*names)
    by = list(dict.fromkeys([state["partition"], *state["keys"]]))
    last = last_write(scan(spark, path, state, several), by, state["order"], "run").select(*names)
    return last if len(several) == len(live) else one.select(*names).unionByName(last)


def read_runs(spark: SparkSession, path: str, parts: Callable[[str], bool] | None = None) -> DataFrame:
    """The table's committed state when this is called; ``parts``: of the partitions whose value (as text) passes alone."""
    state = state_of(spark, path)
    if state is None:
        raise FileNotFoundError(f"no table at {path}")
    return resolved(spark, path, state, [e for e in state["live"] if parts is None or parts(e["part"].partition("=")[2])])


def table_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the live folders."""
    state = state_of(spark, path)
    return sum(e["bytes"] for e in state["live"]) if state else 0


def to_fold(live: list[dict]) -> list[dict]:
    """The folders to fold: of each partition the newest runs, as long as the one before is no larger than they are together."""
    out = []
    for es in by_part(live).values():
        first, size = len(es) - 1, es[-1]["bytes"]
        while first and es[first - 1]["bytes"] <= size:
            first -= 1
            size += es[first]["bytes"]
        if first < len(es) - 1:
            out += es[first:]
    return out


def fold(spark: SparkSession, path: str) -> None:
    """Fold runs where they are due, and remove folders that no kept commit names."""
    state = state_of(spark, path)
    due = to_fold(state["live"])
    if due:
        number = state["number"] + 1
        new = write_run(resolved(spark, path, state, due), path, number, state["partition"])
        gone = {(e["run"], e["part"]) for e in due}
        commit(spark, path, state | {"number": number, "live": [e for e in state["live"] if (e["run"], e["part"]) not in gone] + new})
    remove_old(spark, path)


def remove_old(spark: SparkSession, path: str) -> None:
    """Delete runs that were replaced before the last ``KEEP`` commits, those of writes that never committed, and older commits."""
    numbers = commits(spark, path)
    old, kept = numbers[:-KEEP], numbers[-KEEP:]
    if not old:
        return
    named = {e["run"] for n in kept for e in commit_at(spark, path, n)["live"]}
    system, where = file_system(spark, path)
    for s in system.listStatus(where):
        run = s.getPath().getName().removeprefix("run=")
        if s.getPath().getName().startswith("run=") and run not in named and int(run.split("-")[0]) < kept[0]:
            system.delete(s.getPath(), True)
    for n in old:
        system.delete(file_system(spark, f"{path}/_commits/{n:012d}.json")[1], False)


def upsert_into(spark: SparkSession, path: str, incoming: DataFrame, keys: Sequence[str], partition: str, order: str | Sequence[str] = "batch") -> None:
    """Upsert ``incoming``; a key's rows must all lie in one partition.  Of rows written in one call with equal order
    columns the later (its place in the input) counts."""
    order = [order] if isinstance(order, str) else list(order)
    state = state_of(spark, path) or {"number": 0, "keys": list(keys), "order": order, "partition": partition, "schema": incoming.schema.jsonValue(), "live": []}
    own = last_write(incoming.withColumn("__place", F.monotonically_increasing_id()), list(dict.fromkeys([partition, *keys])), order, "__place")
    number = state["number"] + 1
    new = write_run(own.select(*T.StructType.fromJson(state["schema"]).names), path, number, partition)
    if new:
        commit(spark, path, state | {"number": number, "live": state["live"] + new})
        fold(spark, path)
