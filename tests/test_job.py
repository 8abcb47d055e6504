"""The rows that the KPI job makes, one tick against many, and what its plans read."""
import pytest
from pyspark.sql import functions as F

from tests_support import at, T, world_of
from voltrail.functions.codec import clean_value
from voltrail.functions.ticks import tick_number
from voltrail.operators import basics as B
from voltrail.operators import job as JOB
from voltrail.operators import kpi as K
from voltrail.operators import readings as R
from voltrail.operators import rollup as RU
from voltrail.params import DAY_COLUMNS, FIXTURE_PARAMS, KPI_COLUMNS
from voltrail.plans import joins
from voltrail.session import scratch_path
from voltrail.sources import runs as RN
from voltrail.sources import store as ST

SF = "/root/testdata/sf0.001"


def text(seq):
    return B.seq_text(seq)


def test_a_row_for_every_managed_station_at_every_active_tick(spark):
    # sb never uploads; sa uploads at T and T + 200.
    w = world_of(spark, [("sa", at(T), 23, "28"), ("sa", at(T), 24, "28"), ("sa", at(T + 200), 23, "28"), ("un", at(T + 300), 23, "28")],
                 [("sb", 5, at(T, 60), "1")])
    x = K.inputs(**w)
    rs = {(r.station_abbr, r.seq): r for r in K.kpi_real_status(x, FIXTURE_PARAMS).collect()}
    active = {t + k for t in (T, T + 200, T + 300) for k in (0, 1, 72)}
    assert set(rs) == {(s, t) for s in ("sa", "sb") for t in active}
    outage = rs[("sa", T + 1)]
    assert outage.st_d4 == 1.0 and outage.d4 == 0.0  # no room temperature: 24 - 0 > 6
    assert rs[("sb", T + 1)].st_d2 == 1.0  # status comes from the log, upload or not
    day = {(r.station_abbr, r.seq): r for r in K.kpi_day(K.kpi_real_status(x, FIXTURE_PARAMS)).collect()}
    assert day[("sa", T)].d4 == pytest.approx(rs[("sa", T)].d4)
    assert day[("sa", T + 1)].d4 == pytest.approx((rs[("sa", T)].d4 + 0.0) / 2)  # the outage counts in the mean


def test_no_readings_give_no_rows(spark):
    assert K.inputs(**world_of(spark, [], [])).count() == 0


def test_deltas_need_both_uploads(spark):
    sums = spark.createDataFrame([("sa", T, 5.0, True), ("sa", T + 1, 0.0, False), ("sa", T + 2, 9.0, True), ("sa", T + 3, 12.0, True)], "station_abbr string, seq bigint, s_C double, has boolean")
    got = {r.seq: r.c_C for r in R.meter_deltas(sums, 1, "c", ("C",)).collect()}
    assert got == {T: 0.0, T + 1: 0.0, T + 2: 0.0, T + 3: 3.0}
    lacking = sums.withColumn("l", F.when(F.col("seq") == T + 2, 1).otherwise(0))
    strict = lacking.withColumn("d", R.lag_delta("s_C", 1, strict="l")).collect()
    assert {r.seq: r.d for r in strict}[T + 3] is None


def small_world(spark):
    rows = [("sa", at(T + k), c, str(20 + (k * 7 + c) % 13)) for k in range(0, 90, 3) for c in (8, 9, 23, 24)]
    status = [("sa", 0, at(T + k, 30), str(k % 2)) for k in range(0, 90, 5)] + [("sb", 5, at(T + k, 30), "1") for k in range(0, 90, 11)]
    return world_of(spark, rows, status)


def test_one_tick_equals_the_many_tick_plan(spark):
    w = small_world(spark)
    many = {(r.station_abbr, r.seq): r for r in K.kpi_real_status(K.inputs(**w), FIXTURE_PARAMS).collect()}
    for seq in (T + 3, T + 75):
        one = JOB.real_status_at(w, FIXTURE_PARAMS, seq).collect()
        assert len(one) == 2 and all(r == many[(r.station_abbr, r.seq)] for r in one)
    day = {(r.station_abbr, r.seq): r for r in K.kpi_day(K.kpi_real_status(K.inputs(**w), FIXTURE_PARAMS)).collect()}
    again = K.rehandle(w, FIXTURE_PARAMS, text(T + 75)).collect()
    assert len(again) == 2
    for r in again:
        assert [r[c] for c in DAY_COLUMNS] == pytest.approx([day[(r.station_abbr, r.seq)][c] for c in DAY_COLUMNS])


def persisted(spark):
    return set(spark.sparkContext._jsc.getPersistentRDDs())


def test_scoring_a_tick_again_replaces_its_rows(spark):
    w, root = small_world(spark), scratch_path(spark, "job")
    before = persisted(spark)
    for seq in (T, T + 1, T + 1, T + 3, T + 1):
        JOB.score_tick(spark, root, FIXTURE_PARAMS, text(seq), w)
        assert persisted(spark) <= before  # a tick's caches are released
    assert JOB.scan_kpi(spark, root, "kpi_real", T, T + 3).count() == 6
    day = K.kpi_day(K.kpi_real_status(K.inputs(**w), FIXTURE_PARAMS).filter(F.col("seq").isin(T, T + 1, T + 3)))
    want = {(r.station_abbr, r.seq): [r[c] for c in DAY_COLUMNS] for r in day.collect()}
    for r in JOB.scan_kpi(spark, root, "kpi_day", T + 3, T + 3).collect():
        assert [r[c] for c in DAY_COLUMNS] == pytest.approx(want[(r.station_abbr, T + 3)])


def test_the_whole_job_from_files(spark, tmpdir_path):
    def put(name, lines):
        with open(f"{tmpdir_path}/{name}", "w", encoding="utf-8") as f:
            f.write("\n".join(lines) + "\n")
    tick = text(T)
    put(f"{tick}_center.txt", ["L1\tla\tP\td\t1"])
    put(f"{tick}_line.txt", ["S1\tsa\tL1\td\t500\t1\t0", "S2\tsb\tL1\td\t500\t1\t0"])
    put(f"{tick}_point.txt", ["L1\tS1\tTH_ZTX_A01_Temp_Tm\tYC\t0\tE\te\tfloat\t0\tC\t1\t0\t100"])
    put(f"{tick}_hisdata_la_sa_1.txt", [f"{at(T)}\t56"])
    put(f"{tick}_hisdataYX_la_sa.txt", [f"5\t{at(T, -60)}\t1"])
    put(f"{text(T + 1)}_hisdata_la_sa_1.txt", [f"{at(T + 1)}\t99"])
    root = scratch_path(spark, "job")
    JOB.run_tick(spark, tmpdir_path, root, FIXTURE_PARAMS, tick)
    JOB.run_tick(spark, tmpdir_path, root, FIXTURE_PARAMS, tick)
    got = {r.station_abbr: r for r in RN.read_runs(spark, f"{root}/kpi_real").collect()}
    assert set(got) == {"sa", "sb"} and got["sa"].d4 == pytest.approx(100.0)  # (56 + 0) / 2 = 28
    assert RN.read_runs(spark, f"{root}/readings").count() == 1


def test_tick_argument():
    assert tick_number(text(T)) == T
    for bad in ("2018081000200", "20180810002000x", "20181340002000", "20180810002100", ""):
        with pytest.raises(ValueError):
            tick_number(bad)


def test_reads_name_dates_and_ticks(spark):
    path = scratch_path(spark, "readings")
    w = small_world(spark)
    w["readings"].withColumn("date", F.to_date("tick")).write.partitionBy("date").parquet(path)
    stored = spark.read.parquet(path)
    for df in (JOB.at_ticks(stored, [T, T + 1]), JOB.between_ticks(stored, T, T + 5)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        filters = plan[plan.index("PartitionFilters"):]
        assert "date" in filters[:filters.index("PushedFilters")] and "tick" in filters[filters.index("PushedFilters"):]
    x = K.rehandle({**w, "readings": stored}, FIXTURE_PARAMS, text(T + 3))
    assert "PartitionFilters: [isnotnull(date" in x._jdf.queryExecution().optimizedPlan().toString() + x._jdf.queryExecution().executedPlan().toString()


def scans(df, table):
    """Times that a plan reads a table, its persisted parts counted once each."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    seen, n = set(), 0
    for line in plan.splitlines():
        if "FileScan" in line and f"/{table}" in line:
            seen.add(line.strip(" :+-*()0123456789"))
            n += 1
    return n, len(seen)


def test_plans_read_readings_once_and_status_only_where_used(spark):
    from voltrail.plans import fixtures as fx
    from voltrail.plans import q_kpi
    path = scratch_path(spark, "hot")
    w = q_kpi.world(spark, SF)
    w["readings"].write.parquet(f"{path}/readings_t")
    w["status"].write.parquet(f"{path}/status_t")
    rd, st = spark.read.parquet(f"{path}/readings_t"), spark.read.parquet(f"{path}/status_t")
    job = K.Job(w["lines"], w["stations"], w["points"], rd, st)
    means = K.present(job.analog(), ["m_ZTX_T"])
    assert scans(means, "readings_t")[1] == 1 and scans(means, "status_t")[0] == 0
    day = K.kpi_day(K.kpi_real_status(job.inputs(), FIXTURE_PARAMS))
    assert scans(day, "readings_t")[1] == 1 and scans(day, "status_t")[0] == 1
    assert fx.N_STATIONS == 25


def test_size_check_goes_by_bytes_and_sees_growth(spark):
    path = scratch_path(spark, "dim")
    spark.range(10).selectExpr("id as station_abbr").write.parquet(path)
    small = joins.source_bytes(spark.read.parquet(path))
    spark.range(100000).selectExpr("id as station_abbr").write.mode("overwrite").parquet(path)
    grown = spark.read.parquet(path)
    assert joins.source_bytes(grown) > 10 * small and joins.is_small(grown) and not joins.is_small(grown, 1000)
    assert not joins.is_small(grown.groupBy("station_abbr").count(), 1000)


def test_values_that_are_not_finite_read_as_the_null_marker(spark):
    df = spark.createDataFrame([("NaN",), ("Infinity",), ("-inf",), ("1e400",), ("7.8e-43",), ("\\N",), (None,), ("-5",)], "v string")
    assert [r[0] for r in df.select(clean_value("v")).collect()] == [0.0, 0.0, 0.0, 0.0, 7.8e-43, 0.0, 0.0, -5.0]


def test_rollup_counts_station_hours_and_leaves_out_the_line_row(spark):
    cols = ["station_abbr", "seq", *DAY_COLUMNS]
    day = spark.createDataFrame([("sa", 0, *[50.0] * 9), ("sa", 1, *[70.0] * 8, 170.0), ("sb", 0, *[10.0] * 9), ("sb", 3, *[-900.0] * 9)], cols)
    stations = spark.createDataFrame([("sa", "L"), ("sb", "L")], "station_abbr string, line_name string")
    hours = RU.hourly_station(day)
    got = {(r.station_abbr, r.hour_seq, r.kpi): (r.n, r.total) for r in hours.collect()}
    assert got[("sa", 0, "d1")] == (2, 120.0) and got[("sa", 0, "d24")] == (1, 50.0)  # 170 isn't valid
    assert not any(k[0] == "sb" and k[1] == 1 for k in got)  # no valid overall score in that hour
    table = RU.hourly_table(hours, stations)
    assert table.filter("station_abbr = 'all'").count() == 1
    line = {r.kpi: (r.n, r.total, r.mean) for r in RU.hourly_line(table).collect()}
    assert line["d1"] == (2, 130.0, 65.0) and line["d24"] == (2, 60.0, 30.0) and line["all"][0] == 2
    part = RU.hourly_station(day, start=0, end=1)
    assert {(r.station_abbr, r.n) for r in part.filter("kpi = 'd1'").collect()} == {("sa", 1), ("sb", 1)}


def test_wide_view_refuses_more_ids_than_columns(spark, monkeypatch):
    monkeypatch.setattr(B, "MOST_COLUMNS", 2)
    points = spark.createDataFrame([("sa", i) for i in range(3)], "station_abbr string, control_id int")
    rd = spark.createDataFrame([("sa", at(T), 1, "5")], "station_abbr string, tick timestamp, control_id int, value string")
    with pytest.raises(ValueError, match="long form"):
        B.wide_view(rd, points)


def test_stored_tables_have_the_declared_columns(spark):
    from voltrail import schemas as SC
    w, root = small_world(spark), scratch_path(spark, "job")
    JOB.score_tick(spark, root, FIXTURE_PARAMS, text(T), w)
    for name, schema in (("kpi_real", SC.KPI_REAL), ("kpi_day", SC.KPI_DAY)):
        stored = JOB.scan_kpi(spark, root, name, T, T)
        assert [(f.name, f.dataType) for f in stored.schema] == [(f.name, f.dataType) for f in schema]
    assert ST.table_exists(spark, f"{root}/kpi_status")


def test_a_callers_time_zone_stays_and_changes_no_result(spark):
    import __spark_entry__ as E
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    for name in ("tick_floor", "kpi_day"):
        a = sorted(tuple(r) for r in E.queries()[name](spark, SF).collect())
        assert a == sorted(tuple(r) for r in E.queries()[name](other, SF).collect())
    assert other.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"


def test_the_job_from_files_gives_whole_24_hour_scores(spark):
    import __spark_entry__ as E
    got = {(r.station_abbr, r.kpi_time): r for r in E.queries()["kpi_tick_job_24h"](spark, SF).collect()}
    day = E.queries()["kpi_day"](spark, SF).filter(F.col("kpi_time").isin([r.kpi_time for r in got.values()])).collect()
    assert len(got) == len(day) > 0 and len({t for _, t in got}) <= 3
    for r in day:
        assert [got[(r.station_abbr, r.kpi_time)][c] for c in DAY_COLUMNS] == pytest.approx([r[c] for c in DAY_COLUMNS])
    # The job on tables that are ingested already gives the same.
    ready = {(r.station_abbr, r.kpi_time): r for r in E.queries()["kpi_tick_job"](spark, SF).collect()}
    assert set(ready) == set(got)
    assert all([ready[k][c] for c in DAY_COLUMNS] == pytest.approx([got[k][c] for c in DAY_COLUMNS]) for k in got)


def test_the_lines_that_came_before_are_made_once_for_all_tables(spark, monkeypatch):
    import __spark_entry__ as E
    from voltrail.streaming import jobs as J

    class Seen(Exception):
        pass

    def merge(spark, routed, *_):
        raise Seen(routed._jdf.queryExecution().optimizedPlan().toString())
    monkeypatch.setattr(J, "merge_drop", merge)
    with pytest.raises(Seen) as seen:
        E.queries()["kpi_tick_job_24h"](spark, SF)
    assert "Aggregate" not in str(seen.value) and "Join" not in str(seen.value) and "goes_to" in str(seen.value)


def test_a_tick_looks_at_the_folders_of_its_days_alone(spark):
    root, lo, hi = scratch_path(spark, "job"), T + 360, T + 431
    both = [c for n in KPI_COLUMNS for c in (n, f"st_{n}")]
    rows = spark.range(T, T + 20 * 72, 36).select(F.lit("sa").alias("station_abbr"), F.col("id").alias("seq"), *[F.lit(1.0).alias(c) for c in both])
    JOB.store_real(spark, root, rows)
    for name in ("center", "line", "point"):
        RN.upsert_into(spark, f"{root}/{name}", spark.createDataFrame([(1, 0, name)], "k int, batch int, part string"), ["k"], "part")
    for name in ("readings", "status"):
        RN.upsert_into(spark, f"{root}/{name}", JOB.dated(rows), JOB.KEYS, "date")
    w = JOB.stored_world(spark, root, lo, hi)
    for df in (JOB.scan_kpi(spark, root, "kpi_real", lo, hi), JOB.scan_kpi(spark, root, "kpi_status", lo, hi), w["readings"], w["status"]):
        assert {f.split("/")[-2] for f in df.inputFiles()} == {f"date={JOB.day_of(s)}" for s in (lo, hi)}
    assert JOB.scan_kpi(spark, root, "kpi_real", lo, hi).count() == 2 and JOB.newest_tick(spark, root) == T + 20 * 72 - 36


def test_tables_replaced_under_a_path_are_read_anew(spark, tmpdir_path):
    import __spark_entry__ as E
    for name in ("nation", "region"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmpdir_path}/{name}.parquet")
    ev = spark.read.parquet(f"{SF}/events.parquet")
    n = []
    for limit in (40, 20):
        ev.where(F.col("event_id") < limit).write.mode("overwrite").parquet(f"{tmpdir_path}/events.parquet")
        n.append(E.queries()["kpi_real"](spark, tmpdir_path).count())
    assert n[0] > n[1] > 0


def stored_scores(spark, w):
    root = scratch_path(spark, "job")
    rs = ST.written(K.kpi_real_status(K.inputs(**w), FIXTURE_PARAMS), "rs")
    JOB.store_real(spark, root, rs)
    RN.upsert_into(spark, f"{root}/kpi_day", JOB.dated(K.kpi_day(rs), *DAY_COLUMNS), JOB.KEYS, "date")
    return root


def day_table(spark, root):
    return {(r.station_abbr, r.tick): [r[c] for c in DAY_COLUMNS] for r in RN.read_runs(spark, f"{root}/kpi_day").collect()}


def wanted_day(w):
    rows = K.kpi_day(K.kpi_real_status(K.inputs(**w), FIXTURE_PARAMS)).collect()
    return {(r.station_abbr, at(r.seq)): [r[c] for c in DAY_COLUMNS] for r in rows}


def test_a_correction_reaches_what_depends_on_it_and_nothing_else(spark):
    readings = [(s, at(T + k), c, str(20 + (k * 7 + c) % 13 if c > 8 else k * k * 37 % 9000)) for s in ("sa", "sb") for k in range(0, 240, 2) for c in (8, 23, 24)]
    readings += [("sa", at(T + k), 8, str(k)) for k in (79, 81, 151, 153)]
    w = world_of(spark, readings, [("sa", 5, at(T + k, 30), "1") for k in range(0, 240, 50)])
    root, t = stored_scores(spark, w), T + 80
    before, runs = day_table(spark, root), {e["run"] for e in RN.state_of(spark, f"{root}/kpi_day")["live"]}
    fixed = F.when((F.col("tick") == F.lit(at(t))) & (F.col("station_abbr") == "sa"), "33").otherwise(F.col("value"))
    new = w | {"readings": w["readings"].withColumn("value", fixed)}
    held = persisted(spark)
    only = spark.createDataFrame([("sa",)], "station_abbr string")
    real, day = JOB.rehandle_from(spark, root, FIXTURE_PARAMS, text(t), new, only)
    assert persisted(spark) <= held
    assert {("sa", at(t))} <= {(r.station_abbr, r.tick) for r in real.collect()} <= {("sa", at(s)) for s in (t, t + 1)}
    after, want = day_table(spark, root), wanted_day(new)
    assert set(after) == set(want) and all(after[k] == pytest.approx(want[k]) for k in want)
    moved = {k for k in after if after[k] != pytest.approx(before[k], rel=1e-9)}
    wrote = [(r.station_abbr, r.tick) for r in day.collect()]
    assert set(wrote) == moved and len(wrote) == len(moved) > 30
    assert all(s == "sa" and at(t) <= k <= at(t + 143) for s, k in moved)
    assert after.keys() == before.keys() and runs & {e["run"] for e in RN.state_of(spark, f"{root}/kpi_day")["live"]}


def test_a_status_change_that_came_late_reaches_a_day_of_ticks(spark):
    readings = [("sa", at(T + k), c, "25") for k in range(160) for c in (8, 23, 24)]
    w = world_of(spark, readings, [("sa", 5, at(T + 40, 30), "0")])
    root = stored_scores(spark, w)
    new = w | {"status": w["status"].unionByName(spark.createDataFrame([("sa", 5, at(T + 29, 30), "1")], w["status"].schema))}
    real, day = JOB.rehandle_from(spark, root, FIXTURE_PARAMS, text(T + 29), new)
    assert {r.tick for r in real.collect()} == {at(s) for s in range(T + 30, T + 41)}  # on from the change until the next
    after, want = day_table(spark, root), wanted_day(new)
    assert all(after[k] == pytest.approx(want[k]) for k in want) and day.count() > 11


def test_an_upload_at_a_tick_that_had_none_makes_rows_for_every_station(spark):
    readings = [("sa", at(T + k), 23, "25") for k in range(0, 100, 10)]
    w = world_of(spark, readings, [])
    root = stored_scores(spark, w)
    new = w | {"readings": w["readings"].unionByName(spark.createDataFrame([("sa", at(T + 15), 23, "29")], w["readings"].schema))}
    JOB.rehandle_from(spark, root, FIXTURE_PARAMS, text(T + 15), new, spark.createDataFrame([("sa",)], "station_abbr string"))
    after, want = day_table(spark, root), wanted_day(new)
    assert set(after) == set(want) and all(after[k] == pytest.approx(want[k]) for k in want)
    assert ("sb", at(T + 15)) in after
    with pytest.raises(ValueError, match="not been scored"):
        JOB.rehandle_from(spark, root, FIXTURE_PARAMS, text(T + 9999), new)
