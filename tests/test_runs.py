"""Tables kept as runs: what an upsert writes, what readers see, how runs are folded."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from voltrail.session import scratch_path
from voltrail.sources import runs as RN
from voltrail.sources import store as ST

SCHEMA = "key int, value string, batch int, date date"
DAY = dt.date(2024, 1, 1)


def rows(spark, items, batch, day=DAY):
    return spark.createDataFrame([(k, v, batch, day) for k, v in items], SCHEMA)


def put(spark, path, items, batch, day=DAY):
    RN.upsert_into(spark, path, rows(spark, items, batch, day), ["key"], "date")


def state(spark, path):
    return {(r.key, r.value, r.date) for r in RN.read_runs(spark, path).collect()}


def files(path):
    path = path.removeprefix("file:")
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet") and not f.startswith(".")}


def test_same_table_as_the_merge_in_place(spark):
    a, b = scratch_path(spark, "runs"), scratch_path(spark, "merged")
    batches = [(1, [(i, f"v{i}") for i in range(50)]), (3, [(i, "new") for i in range(0, 50, 7)]), (2, [(i, "stale") for i in range(0, 50, 7)]),
               (3, [(7, "again"), (7, "last")]), (4, [(60, None), (61, "x")])]
    for n, items in batches:
        df = rows(spark, items, n).coalesce(1)
        RN.upsert_into(spark, a, df, ["key"], "date")
        ST.merge_into(spark, b, df, ["key"], "date")
    got = state(spark, a)
    assert got == {(r.key, r.value, r.date) for r in spark.read.parquet(b).collect()}
    assert (7, "last", DAY) in got and (14, "new", DAY) in got and len(got) == 52


def test_an_upsert_writes_its_own_rows_only(spark):
    path = scratch_path(spark, "runs")
    put(spark, path, [(i, "x" * 200 + str(i)) for i in range(20000)], 1)
    before = files(path)
    put(spark, path, [(5, "one"), (20001, "two")], 2)
    new = {f: n for f, n in files(path).items() if f not in before}
    assert before.items() <= files(path).items() and sum(new.values()) < sum(before.values()) / 50
    assert RN.read_runs(spark, path).count() == 20001


def test_folding_keeps_runs_few_and_rewrites_seldom(spark):
    path, seen = scratch_path(spark, "runs"), {}
    for n in range(20):
        put(spark, path, [(i, f"{n}-{i}" * 20) for i in range(n * 40, n * 40 + 40)], n)
        seen |= files(path)
        live = RN.state_of(spark, path)["live"]
        assert len(live) <= 2 + (n + 1).bit_length()
    assert RN.read_runs(spark, path).count() == 800
    assert sum(seen.values()) < 6 * RN.table_bytes(spark, path)  # each row was written about log2(20) times
    assert len(files(path)) < len(seen)  # replaced runs go after KEEP commits


def test_a_write_that_ends_early_leaves_the_old_state(spark, monkeypatch):
    path = scratch_path(spark, "runs")
    put(spark, path, [(1, "a"), (2, "b")], 1)

    def lost(*_):
        raise OSError("killed")
    with monkeypatch.context() as m:
        m.setattr(RN, "commit", lost)
        with pytest.raises(OSError):
            put(spark, path, [(1, "c"), (3, "d")], 2)
    assert state(spark, path) == {(1, "a", DAY), (2, "b", DAY)}
    put(spark, path, [(1, "c"), (3, "d")], 2)
    assert state(spark, path) == {(1, "c", DAY), (2, "b", DAY), (3, "d", DAY)}


def test_a_reader_keeps_its_state_and_a_second_writer_is_refused(spark):
    path = scratch_path(spark, "runs")
    put(spark, path, [(1, "a")], 1)
    old, held = RN.read_runs(spark, path), RN.state_of(spark, path)
    for n in range(2, 5):
        put(spark, path, [(1, f"a{n}")], n)
    assert [r.value for r in old.collect()] == ["a"] and state(spark, path) == {(1, "a4", DAY)}
    with pytest.raises(RN.Conflict):
        RN.commit(spark, path, held | {"number": held["number"] + 1})


def test_filters_on_keys_and_days_reach_the_scan(spark):
    path = scratch_path(spark, "runs")
    for n in range(3):
        put(spark, path, [(i, f"{n}") for i in range(400 >> n * 3)], n)
    put(spark, path, [(1, "z")], 9, dt.date(2024, 1, 2))
    df = RN.read_runs(spark, path).where((F.col("date") == F.lit(DAY)) & (F.col("key") == 3))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert all("date" in line.split("PushedFilters")[0] and "EqualTo(key,3)" in line for line in plan.splitlines() if "PartitionFilters" in line)
    assert [tuple(r)[:2] for r in df.collect()] == [(3, "2")]


def test_nothing_to_write_and_no_table(spark):
    path = scratch_path(spark, "runs")
    RN.upsert_into(spark, path, rows(spark, [], 1), ["key"], "date")
    assert RN.state_of(spark, path) is None
    with pytest.raises(FileNotFoundError):
        RN.read_runs(spark, path)
