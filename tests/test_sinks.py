"""Replays, late data, corrections and outages: sinks and streams give one table whatever is delivered again."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from voltrail import schemas as SC
from voltrail.session import scratch_path
from voltrail.sources import dropfolder as DF
from voltrail.sources import runs as RN
from voltrail.sources import store as ST
from voltrail.streaming import jobs as J

EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double"


def put(folder, name, lines, modified=None):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    if modified:
        os.utime(path, (modified, modified))


def readings(spark, root):
    return {r.control_id: r.value for r in RN.read_runs(spark, f"{root}/readings").collect()}


def test_stream_counts_every_event_in_any_order_of_arrival(spark, tmpdir_path):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(hours=i), i, "a", 1.0) for i in range(96)]
    src = os.path.join(tmpdir_path, "src")
    for k in range(4):  # newest first
        spark.createDataFrame(rows[72 - 24 * k:96 - 24 * k], EVENTS).coalesce(1).write.mode("append").parquet(src)
    events = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(src)
    table, check = scratch_path(spark, "t"), scratch_path(spark, "c")
    J.tick_agg_stream(events, table, check)
    assert J.tick_agg_table(spark, table, check).agg(F.sum("n")).first()[0] == 96
    J.tick_agg_stream(events, table, check)  # nothing new
    again = scratch_path(spark, "c")
    J.tick_agg_stream(events, table, again)  # all of it once more, from a new checkpoint
    assert J.tick_agg_table(spark, table, again).agg(F.sum("n"), F.sum("total")).first()[:] == (96, 96.0)
    late = scratch_path(spark, "c")
    J.tick_agg_stream(events, table, late, late=lambda b: b.filter(F.col("event_id") >= 90))
    assert J.tick_agg_table(spark, table, late).agg(F.sum("n")).first()[0] == 6


def test_stream_equals_batch_for_a_file_and_for_a_folder(spark, tmpdir_path):
    from voltrail.plans import q_stream
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ev.repartition(3).write.parquet(f"{tmpdir_path}/events.parquet")
    one = q_stream.q_stream_tick_agg(spark, "/root/testdata/sf0.001").agg(F.sum("n")).first()[0]
    many = q_stream.q_stream_tick_agg(spark, tmpdir_path).agg(F.sum("n")).first()[0]
    assert one == many == ev.count()


def test_latest_state_survives_replay_and_a_failed_write(spark, tmpdir_path, monkeypatch):
    t = dt.datetime(2024, 1, 1)
    rows = [("sa", 1, t, "0"), ("sa", 1, t, "1"), ("sa", 1, t - dt.timedelta(hours=1), "1"), ("sb", 1, t, "1")]
    src = os.path.join(tmpdir_path, "src")
    spark.createDataFrame(rows, SC.STATUS).write.parquet(src)
    stream = spark.readStream.schema(SC.STATUS).parquet(src)
    table = scratch_path(spark, "state")
    for _ in range(3):
        J.latest_state_stream(stream, table, scratch_path(spark, "c"))
        got = sorted((r.station_abbr, r.value) for r in J.latest_state_table(spark, table).collect())
        assert got == [("sa", "0"), ("sa", "1"), ("sb", "1")]

    def lost(*_):
        raise OSError("killed")
    with monkeypatch.context() as m:  # as if the write had failed half way
        m.setattr(RN, "commit", lost)
        with pytest.raises(Exception, match="killed"):
            J.latest_state_stream(stream, table, scratch_path(spark, "c"))
    assert J.latest_state_table(spark, table).count() == 3


def test_a_batch_of_states_writes_the_keys_it_touches(spark, tmpdir_path):
    t, src, table, check = dt.datetime(2024, 1, 1), os.path.join(tmpdir_path, "src"), scratch_path(spark, "state"), scratch_path(spark, "c")
    spark.createDataFrame([(f"s{i}", i % 7, t, "1") for i in range(3000)], SC.STATUS).coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(SC.STATUS).parquet(src)
    J.latest_state_stream(stream, table, check)
    before = RN.state_of(spark, table)["live"]
    late = [("s1", 1, t - dt.timedelta(days=1), "0"), ("s2", 2, t + dt.timedelta(hours=1), "0")]
    spark.createDataFrame(late, SC.STATUS).coalesce(1).write.mode("append").parquet(src)
    J.latest_state_stream(stream, table, check)
    new = [e for e in RN.state_of(spark, table)["live"] if e not in before]
    assert all(e in RN.state_of(spark, table)["live"] for e in before) and RN.scan(spark, table, RN.state_of(spark, table), new).count() == 2
    got = {(r.station_abbr, r.value) for r in J.latest_state_table(spark, table).where("station_abbr in ('s1', 's2')").collect()}
    assert got == {("s1", "1"), ("s2", "0")} and J.latest_state_table(spark, table).count() == 3000


def test_windows_close_by_event_time_and_late_rows_are_kept(spark, tmpdir_path):
    t0, src, table, check = dt.datetime(2024, 1, 1), os.path.join(tmpdir_path, "src"), scratch_path(spark, "w"), scratch_path(spark, "c")
    schema = "event_id bigint, ts timestamp, event_type string, value double"
    for k, hours in enumerate([(0, 1, 2), (10, 11, 1), (0, 12, 30, 11.5), (2, 29, 9, 31)]):
        rows = [(10 * k + i, t0 + dt.timedelta(hours=h), "a", h + 1.0) for i, h in enumerate(hours)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        J.windows_stream(stream, table, check, "2 hours")  # each run goes on where the last one ended
    parts = J.windows_table(spark, table, check)
    n = {r.kind: r.n for r in parts.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    late = J.late_rows(spark, table, check).collect()
    assert sum(n.values()) == 14 and n["late"] == len(late) > 0 and n["open"] == 3
    assert {r.event_id for r in late} >= {20, 30} and all(r.tick == r.ts.replace(minute=r.ts.minute // 20 * 20) for r in late)
    closed = parts.where("kind = 'closed'")
    assert closed.count() == closed.select("tick", "event_type").distinct().count()  # a window closes once
    assert {r.tick for r in parts.where("kind = 'open'").collect()} == {t0 + dt.timedelta(hours=h) for h in (29, 30, 31)}
    got = {r.tick: (r.n, r.total) for r in parts.groupBy("tick").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()}
    assert got[t0] == (2, 2.0) and got[t0 + dt.timedelta(hours=1)] == (2, 4.0) and got[t0 + dt.timedelta(hours=2)] == (2, 6.0)


def test_ingest_takes_the_newest_write_whatever_the_batch(spark, tmpdir_path):
    line = "2024-01-01 00:20:00\t{}"
    put(tmpdir_path, "20240101002000_hisdata_l_sa_1.txt", [line.format(1)], 1_700_000_000)
    root = scratch_path(spark, "tables")
    first = scratch_path(spark, "c")
    J.ingest_stream(spark, tmpdir_path, root, first)
    put(tmpdir_path, "20240101004000_hisdata_l_sa_1.txt", [line.format(2)], 1_700_000_100)
    J.ingest_stream(spark, tmpdir_path, root, first)
    assert readings(spark, root) == {0: "2"}
    # A new checkpoint counts batches from 0 and sees the files in one batch: the later tick still wins.
    J.ingest_stream(spark, tmpdir_path, root, scratch_path(spark, "c"))
    assert readings(spark, root) == {0: "2"}
    put(tmpdir_path, "20240101004000_hisdata_l2_sa_1.txt", [line.format(3)], 1_700_000_200)  # the same tick, written later
    J.ingest_stream(spark, tmpdir_path, root, scratch_path(spark, "c"), max_files=1)
    assert readings(spark, root) == {0: "3"}


def test_ingest_takes_every_kind_and_double_delivery_changes_nothing(spark, tmpdir_path):
    point = "L\tS\tZNDB_LS01_Wp_Tm\tYC\t8\tE\tmeter\tfloat\t0\tkWh\t{}\t0\t100"
    put(tmpdir_path, "20240101000000_point.txt", [point.format(1)])
    put(tmpdir_path, "20240101000000_center.txt", ["L\tl\tP\td\t1"])
    put(tmpdir_path, "20240101000000_line.txt", ["S\tsa\tL\td\t500\t1\t0"])
    put(tmpdir_path, "20240101000000_hisdataYX_l_sa.txt", ["1\t2024-01-01 00:01:00\t1", "1\t2024-01-01 00:01:00\t0"])
    root, check = scratch_path(spark, "tables"), scratch_path(spark, "c")
    J.ingest_stream(spark, tmpdir_path, root, check)
    put(tmpdir_path, "20240101002000_point.txt", [point.format(7)])
    put(tmpdir_path, "20240101002000_center.txt", ["L\tl\tP\td\t1"])
    put(tmpdir_path, "20240101002000_hisdataYX_l_sa.txt", ["1\t2024-01-01 00:01:00\t0"])
    J.ingest_stream(spark, tmpdir_path, root, check)
    J.ingest_stream(spark, tmpdir_path, root, scratch_path(spark, "c"))
    read = lambda t: RN.read_runs(spark, f"{root}/{t}").collect()
    assert [r.quantity for r in read("point")] == [7]
    assert len(read("center")) == len(read("line")) == 1
    assert [(r.id, r.value) for r in read("status")] == [(1, "0")]


def rows(spark, values, batch):
    df = spark.createDataFrame([("k", v, batch) for v in values], "key string, value string, batch int")
    return df.withColumn("date", F.lit("2024-01-01"))


def test_last_write_wins_not_the_greatest_text(spark):
    for first, second in (("9", "10"), ("10", "9")):
        path = scratch_path(spark, "t")
        ST.merge_into(spark, path, rows(spark, [first], 1), ["key"], "date")
        ST.merge_into(spark, path, rows(spark, [second], 1), ["key"], "date")
        assert [r.value for r in spark.read.parquet(path).collect()] == [second]
        path = scratch_path(spark, "t")
        ST.merge_into(spark, path, rows(spark, [first, second], 1).coalesce(1), ["key"], "date")
        assert [r.value for r in spark.read.parquet(path).collect()] == [second]


def test_a_path_that_cannot_be_looked_at_is_an_error(spark):
    assert not ST.table_exists(spark, scratch_path(spark, "nothing"))
    with pytest.raises(Exception, match="nosuchscheme"):
        ST.table_exists(spark, "nosuchscheme://host/table")


def test_typed_copy_twice_is_one_copy(spark):
    src = spark.createDataFrame([("r1", "1", "20240101", "20", "1.5"), ("r2", "x", "20240101", "40", "2")], "rowkey string, point_id string, sdate string, time string, data string")
    path = scratch_path(spark, "copy")
    for _ in range(2):
        ST.typed_copy(src, SC.TYPED_READING, path, ["rowkey"], "sdate")
    got = {(r.rowkey, r.point_id, r.data) for r in ST.scan_typed(spark, path, SC.TYPED_READING).collect()}
    assert got == {("r1", 1, 1.5), ("r2", None, 2.0)}


def test_exported_files_are_flat_and_hold_their_lines(spark):
    folder = scratch_path(spark, "drop")
    lines = spark.createDataFrame([(f"f{i % 3}_x.txt", f"{i}") for i in range(30)], "file_name string, line string")
    DF.write_files(lines.repartition(5), folder)
    got = DF.read_drop(spark, folder).groupBy("file_name").agg(F.count("*").alias("n"), F.countDistinct("line").alias("d")).collect()
    assert {(r.file_name, r.n, r.d) for r in got} == {(f"f{i}_x.txt", 10, 10) for i in range(3)}


def test_a_cluster_without_a_shared_folder_is_refused(spark, monkeypatch):
    from voltrail import session
    class Context:  # noqa: E306
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return default
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
