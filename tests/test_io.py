"""Drop-folder ingest, Parquet upsert, parameters and JDBC (A-*, B-*)."""
import os
import tempfile

from pyspark.sql import functions as F

from voltrail import schemas as SC
from voltrail.operators import basics as B
from voltrail.params import Params, params_at, params_overlay
from voltrail.sources import dropfolder as DF
from voltrail.sources import ledger as LG
from voltrail.sources import mapping as M
from voltrail.sources import runs as RN
from voltrail.sources import store as ST
from voltrail.streaming import jobs as J


def _write(folder, name, lines):
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def _folder(tmpdir_path):
    d = tmpdir_path
    _write(d, "20180810002000_point.txt", [
        "Line1\tStationA\tLSJZ01_i1Run_St\tYX\t99\tE1\tchiller\tint\t0\t-\t1\t0\t1\trun",
        "Line1\tStationA\tZNDB_LS01_Wp_Tm\tYC\t612\tE2\tmeter\tfloat\t0\tkWh\t1\t0\t100"])   # 13 fields
    _write(d, "20180810002000_hisdataYX_bj9_qlz.txt", ["99\t2018-08-10 00:13:05\t1"])
    _write(d, "20180810002000_hisdata_bj9_qlz_2.txt", ["2018-08-10 00:20:00\t7.5\t\\N\t12.25\t\t"])
    _write(d, "20180810002000_hisdata_bj9_qlz_4.txt", ["2018-08-10 00:20:00\t\t\t\t\t\t\t\t\t\t\t\t\t3.5"])
    _write(d, "20180810004000_hisdata_bj9_qlz_1.txt", ["2018-08-10 00:40:00\t1\t2"])    # another tick
    _write(d, "x.txt", ["ignored"])
    return d


def test_discover_by_tick_and_route(spark, tmpdir_path):
    d = _folder(tmpdir_path)
    files = {r.file_name for r in DF.read_drop(spark, d, "20180810002000").select("file_name").distinct().collect()}
    assert "20180810004000_hisdata_bj9_qlz_1.txt" not in files and len(files) == 4
    kinds = {r.file_name: r.kind for r in DF.route(DF.read_drop(spark, d)).select("file_name", "kind").collect()}
    assert kinds["x.txt"] == "ignored" and kinds["20180810002000_point.txt"] == "dimension"
    assert kinds["20180810002000_hisdataYX_bj9_qlz.txt"] == "status"


def test_analog_chunks_status_and_points(spark, tmpdir_path):
    d = _folder(tmpdir_path)
    routed = DF.route(DF.read_drop(spark, d, "20180810002000"))
    got = {(r.control_id, r.value) for r in DF.analog_rows(routed).collect()}
    # chunk 2 → ids 200..; trailing empty fields produce no rows; chunk 4 reaches id 612 (Q-17)
    assert got == {(200, "7.5"), (201, "\\N"), (202, "12.25"), (612, "3.5")}
    st = DF.status_rows(routed).first()
    assert (st.station_abbr, st.id, str(st.ts), st.value) == ("qlz", 99, "2018-08-10 00:13:05", "1")
    pts = {r.control_id: r.description for r in DF.dimension_rows(routed, "point", SC.POINT_FILE).collect()}
    assert pts == {99: "run", 612: None}     # 13-field row padded with NULL


def test_every_line_is_taken_or_rejected_with_its_reason(spark, tmpdir_path):
    d, root = _folder(tmpdir_path), os.path.join(tmpdir_path, "tables")
    _write(d, "20180810002000_hisdataYX_bj9_abc.txt", ["x\t2018-08-10 00:13:05\t1", "4\tyesterday\t1", "4\t2018-08-10 00:13:05", "5\t2018-08-10 00:13:05\t1", "4\tyesterday\t1"])
    _write(d, "20180810002000_hisdata_bj9_abc_two.txt", ["2018-08-10 00:20:00\t1"])
    _write(d, "20180810002000_hisdata_bj9_abc_1.txt", ["\t1", "2018-08-10 00:20:00\t1"])
    _write(d, "20180810002000_line.txt", ["\tsa\tL\td\t500\t1\t0", "S\tsa\tL\td\t500\t1\t0"])
    _write(d, "20180810002000_price.txt", ["1"])
    lines = DF.route(DF.read_drop(spark, d))
    J.merge_drop(spark, lines, root, 0)
    J.merge_drop(spark, lines, root, 1)  # delivered again
    bad = RN.read_runs(spark, f"{root}/rejected")
    assert sorted((r.kind, r.reason, r.n) for r in bad.collect()) == [
        ("analog", "chunk", 1), ("analog", "time", 1), ("dimension", "key", 1), ("dimension", "table", 1), ("ignored", "name", 1),
        ("status", "fields", 1), ("status", "id", 1), ("status", "time", 2)]
    good = lines.where(DF.reason(SC.DIMENSIONS).isNull()).count()
    assert good + bad.agg(F.sum("n")).first()[0] == lines.count() == 18
    assert RN.read_runs(spark, f"{root}/status").count() == 2 and RN.read_runs(spark, f"{root}/line").count() == 1


def test_the_ledger_takes_a_file_once_and_again_when_it_changed(spark, tmpdir_path, monkeypatch):
    d, root = _folder(tmpdir_path), os.path.join(tempfile.mkdtemp(prefix="voltrail-test-"), "tables")
    assert LG.take_new(spark, d, root, max_files=4) == 6
    read = []
    monkeypatch.setattr(LG.DF, "read_files", lambda s, paths, of=DF.read_files: read.extend(paths) or of(s, paths))
    assert LG.take_new(spark, d, root) == 0 and read == []
    _write(d, "20180810004000_hisdata_bj9_qlz_1.txt", ["2018-08-10 00:40:00\t7\t8\t9"])
    _write(d, "20180810010000_hisdata_bj9_qlz_1.txt", ["2018-08-10 01:00:00\t1"])
    assert LG.take_new(spark, d, root, "20180810010000") == 1 and LG.take_new(spark, d, root) == 1 and len(read) == 2
    got = {(r.tick.hour * 60 + r.tick.minute, r.control_id): r.value for r in RN.read_runs(spark, f"{root}/readings").collect()}
    assert got[40, 0] == "7" and got[40, 2] == "9" and got[60, 0] == "1"
    assert RN.read_runs(spark, f"{root}/files").count() == 7


def test_upsert_last_write_wins_and_idempotent(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "tbl")
    keys = ["station_abbr", "tick", "control_id"]
    base = spark.createDataFrame([("sa", "2024-01-01 00:20:00", 8, "1", 1), ("sa", "2024-01-01 00:20:00", 9, "\\N", 1)],
                                 "station_abbr string, tick string, control_id int, value string, batch int") \
        .withColumn("tick", F.to_timestamp("tick")).withColumn("date", F.to_date("tick"))
    fix = base.filter(F.col("control_id") == 9).withColumn("value", F.lit("0")).withColumn("batch", F.lit(2))
    ST.merge_into(spark, path, base, keys, "date")
    ST.merge_into(spark, path, fix, keys, "date")
    ST.merge_into(spark, path, fix, keys, "date")
    got = {(r.control_id, r.value) for r in spark.read.parquet(path).collect()}
    assert got == {(8, "1"), (9, "0")}


def test_params_layers(spark):
    p = Params.from_layers({"KT_F": "0", "run_time": "20"}, {"KT_F": "1000"})
    assert p.KT_F == 1000.0 and p.run_time == 20.0 and p.XL_standard == 0.7
    d = spark.createDataFrame([("KT_F", "0"), ("run_time", "20")], "key string, value string")
    s = spark.createDataFrame([("KT_F", "1000")], "key string, value string")
    got = {r.key: (r.value, r.source) for r in params_overlay(d, s).collect()}
    assert got == {"KT_F": ("1000", "settings"), "run_time": ("20", "defaults")}


def test_parameters_hold_from_their_tick_until_the_next(spark):
    import datetime as dt
    T = 1_420_100
    when = lambda seq, s=0: dt.datetime(1970, 1, 1) + dt.timedelta(seconds=seq * 1200 + s)
    layer = "key string, value string, valid_from timestamp"
    defaults = spark.createDataFrame([("KT_F", "5", when(T - 900)), ("XL_standard", "0.5", when(T + 2)), ("nothing", "1", when(T))], layer)
    settings = spark.createDataFrame([("KT_F", "7", when(T + 1)), ("KT_F", "8", when(T + 2, 1)), ("KT_F", "x", when(T + 4)), ("KT_F", "9", when(T + 5)), ("KT_F", "6", when(T + 4, 1200 - 1))], layer)
    ticks = spark.range(T - 1, T + 7).withColumnRenamed("id", "seq")
    got = {r.seq - T: (r.p_KT_F, r.p_XL_standard, r.p_run_time) for r in params_at(ticks, defaults, settings, Params(XL_standard=0.9)).collect()}
    assert got == {-1: (5, 0.9, 20), 0: (5, 0.9, 20), 1: (7, 0.9, 20), 2: (7, 0.5, 20), 3: (8, 0.5, 20), 4: (8, 0.5, 20), 5: (9, 0.5, 20), 6: (9, 0.5, 20)}
    assert params_at(ticks.limit(0), defaults, settings).count() == 0
    assert {r.p_KT_F for r in params_at(ticks, defaults.limit(0), settings.limit(0)).collect()} == {Params().KT_F}


def test_samples_are_the_same_rows_under_any_partitioning(spark):
    df = spark.range(5000).selectExpr("id", "id % 40 as grp")
    rows = lambda d: sorted(r.id for r in d.collect())
    part = B.sample_fraction(df, ["grp"], 0.5, 3)
    assert rows(part) == rows(B.sample_fraction(df.repartition(7), ["grp"], 0.5, 3))
    assert len({r.grp for r in part.collect()}) * 125 == part.count() and 8 < part.count() / 125 < 32  # whole keys
    assert set(rows(B.sample_fraction(df, ["id"], 0.1, 3))) < set(rows(B.sample_fraction(df, ["id"], 0.3, 3)))
    assert abs(B.sample_fraction(df, ["id"], 0.3, 3).count() - 1500) < 150
    for n in (0, 1, 999, 4999, 5000, 9000):
        got = rows(B.sample_rows(df, ["id"], n, 3))
        assert len(got) == min(n, 5000) and got == rows(B.sample_rows(df.repartition(5), ["id"], n, 3))
    assert set(rows(B.sample_rows(df, ["id"], 50, 3))) < set(rows(B.sample_rows(df, ["id"], 500, 3)))
    assert rows(B.sample_rows(df, ["id"], 500, 3)) != rows(B.sample_rows(df, ["id"], 500, 4))


def test_cells_catalog_and_discovery(spark):
    df = spark.createDataFrame([("rk1", "zhang", 19)], "rowkey string, name string, age int")
    cells = M.to_cells(df, F.col("rowkey"), "c", ["name", "age"])
    typed = M.catalog_read(cells, {"name": ("name", "string"), "age": ("age", "int")}).first()
    assert (typed.rowkey, typed.name, typed.age) == ("rk1", "zhang", 19)
    types = spark.createDataFrame([("age", "int")], "qualifier string, type string")
    got = {(r.qualifier, r.type) for r in M.discover_schema(cells, types).collect()}
    assert got == {("name", "string"), ("age", "int")}


def test_jdbc_round_trip_embedded_derby(spark):
    url = "jdbc:derby:memory:voltrail;create=true"
    rows = spark.createDataFrame([("p1", 20010, 1.5), ("p2", 20011, 2.5)], SC.RESULT_SET)
    rows.write.mode("append").jdbc(url, "result_set", properties={"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    back = (spark.read.format("jdbc").option("url", url).option("dbtable", "result_set")
            .option("driver", "org.apache.derby.jdbc.EmbeddedDriver").load())
    assert back.filter("20010 >= TIME").count() == 1


def test_the_newest_version_of_a_cell_counts_not_the_greatest_text(spark):
    df = spark.createDataFrame([("k", "9", "a", 1), ("k", "10", None, 2), ("k", "8", "z", 3), ("m", None, "q", 1), ("m", "5", "r", 1)], "key string, n string, t string, day int")
    cells = M.to_cells(df, F.col("key"), "c", ["n", "t"], F.timestamp_seconds(F.col("day") * 86400))
    assert cells.columns == ["rowkey", "family", "qualifier", "ts", "value"] and cells.count() == 10
    catalog = {"n": ("n", "int"), "t": ("t", "string")}

    def read(day=None):
        return {r.rowkey: (r.n, r.t) for r in M.catalog_read(cells, catalog, "c", None if day is None else F.timestamp_seconds(F.lit(day * 86400))).collect()}
    assert read() == {"k": (8, "z"), "m": (5, "r")}  # of one time the greatest, a value before none
    assert read(2) == {"k": (10, None), "m": (5, "r")}  # the newest at that time has no t
    assert read(1) == {"k": (9, "a"), "m": (5, "r")} and read(0) == {}
    newest = {(r.rowkey, r.qualifier): r.value for r in M.newest_cells(cells).collect()}
    assert newest == {("k", "n"): "8", ("k", "t"): "z", ("m", "n"): "5", ("m", "t"): "r"}
