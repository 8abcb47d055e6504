"""Hand-computed KPI semantics on tiny frames."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from voltrail import schemas as SC
from voltrail.operators import kpi as K
from voltrail.operators import points as P
from voltrail.operators import readings as R
from voltrail.operators import status as S
from voltrail.params import FIXTURE_PARAMS, Params

T = 1_420_100                      # a tick number
EPOCH = dt.datetime(1970, 1, 1)


def at(seq, seconds=0):
    return EPOCH + dt.timedelta(seconds=seq * 1200 + seconds)


@pytest.fixture()
def dims(spark):
    lines = spark.createDataFrame([("L1", "la", "P", "d", 1), ("L2", "lb", "P", "d", 0)], SC.LINE_FILE)
    stations = spark.createDataFrame(
        [("S1", "sa", "L1", "d", 500.0, 1, 0), ("S2", "sb", "L1", "d", 500.0, 0, 0),
         ("S3", "sc", "L2", "d", 500.0, 1, 0)], SC.STATION_FILE)
    pts = [(0, "LSJZ01_i1Run_St", "YX"), (1, "LSJZ02_i1Run_St", "YX"), (5, "KT_01_iRun_St", "YX"),
           (6, "KT_02_iRun_St", "YX"), (8, "ZNDB_LS01_Wp_Tm", "YC"), (9, "ZNDB_LS02_Wp_Tm", "YC"),
           (23, "TH_ZTX_A01_Temp_Tm", "YC"), (24, "TH_ZTS_A01_Temp_Tm", "YC"), (25, "TH_ZTS_A02_Temp_Tm", "YC")]
    points = spark.createDataFrame(
        [("L1", st, name, typ, cid) for st in ("S1", "S2", "S3") for cid, name, typ in pts],
        "line_name string, station_name string, point_name string, type string, control_id int")
    return lines, stations, points


@pytest.fixture()
def readings(spark):
    rows = [("sa", at(T - 1), 8, "100"), ("sa", at(T - 1), 9, "50"),
            ("sa", at(T), 8, "110"), ("sa", at(T), 9, "\\N"),
            ("sa", at(T), 23, "32"), ("sa", at(T), 24, "30")]          # id 25 missing at T
    return spark.createDataFrame(rows, SC.READING)


def test_managed_gate(dims):
    lines, stations, _ = dims
    got = {r.station_abbr for r in P.managed_stations(lines, stations).collect()}
    assert got == {"sa"}        # sb not managed; sc on an unmanaged line


def test_classify_like(dims):
    lines, stations, points = dims
    cl = P.classify_points(points, stations).filter("station_abbr = 'sa'")
    got = {(r.control_id, r.cls) for r in cl.collect()}
    assert (8, "LSJZ_ZNDB") in got and (8, "ALL_ZNDB") in got and (9, "ALL_ZNDB") in got
    assert (5, "KT_Run") in got and (23, "ZTX_T") in got and (25, "ZTS_T") in got


def test_means_count_missing_and_deltas(spark, dims, readings):
    lines, stations, points = dims
    cl = P.classify_points(points, stations)
    sums = R.tick_sums(readings, cl)
    x = R.meter_deltas(R.class_means(sums, P.class_sizes(cl, ("ZTX_T", "ZTS_T")), ("ZTX_T", "ZTS_T")), 1, "c")
    rows = {r.seq: r for r in x.collect()}
    now, prev = rows[T], rows[T - 1]
    assert now.m_ZTX_T == 32.0
    assert now.m_ZTS_T == 15.0                      # (30 + missing 0) / 2 — Σ/n, not Σ/(n-1)
    assert now.c_ALL_ZNDB == (110 + 0) - (100 + 50)  # '\N' reads as 0 (Q-9)
    assert now.c_LSJZ_ZNDB == -40.0                 # both LS meters match the chiller-meter pattern
    assert prev.c_ALL_ZNDB == 0.0                    # no upload at T-2: no pair → 0


def test_run_flags_bounds_ties_latest(spark, dims):
    lines, stations, points = dims
    cl = P.classify_points(points, stations)
    status = spark.createDataFrame([
        ("sa", 0, at(T, -60), "1"),                          # inside (T-72, T)
        ("sa", 5, at(T), "1"),                               # exactly at T: excluded at T
        ("sa", 1, at(T - 10), "0"), ("sa", 1, at(T - 10), "1"),   # tie at the latest ts: any '1'
        ("sa", 6, at(T, -600), "1"), ("sa", 6, at(T, -300), "0"), # latest is '0'
    ], SC.STATUS)
    grid = spark.createDataFrame([("sa", T), ("sa", T + 1), ("sa", T + 71), ("sa", T + 72)],
                                 "station_abbr string, seq bigint")
    on = {(r.id, r.seq): r.on for r in S.point_on_at(status, S.run_points(cl).select("station_abbr", "id").distinct(),
                                                     grid).collect()}
    assert on[(0, T)] == 1 and on[(0, T + 71)] == 1 and on[(0, T + 72)] == 0
    assert on[(5, T)] == 0 and on[(5, T + 1)] == 1 and on[(5, T + 71)] == 1
    assert on[(5, T + 72)] == 0          # lower bound is exclusive: ts == T*1200 drops out
    assert on[(1, T)] == 1
    assert on[(6, T)] == 0
    flags = {r.seq: r for r in S.run_flags(status, cl, grid).collect()}
    assert flags[T].on_LSJZ_Run == 1.0 and flags[T].on_KT_Run == 0.0 and flags[T + 1].on_KT_Run == 1.0


def test_latest_state_keeps_ties(spark):
    st = spark.createDataFrame([("sa", 1, at(T), "0"), ("sa", 1, at(T), "1"), ("sa", 1, at(T - 1), "1")], SC.STATUS)
    got = sorted(r.value for r in S.latest_state(st).collect())
    assert got == ["0", "1"]


def _score_row(spark, **cols):
    base = dict(station_abbr="sa", seq=T, area=500.0, e_ALL_ZNDB=0.0,
                **{f"m_{c}": 0.0 for c in ("KT_Hz", "HPF_Hz", "SF_T", "XF_T", "ZTX_T", "ZTS_T", "LD_yield", "LD_IT",
                                           "LD_OT", "LQ_yield", "LQ_IT", "LQ_OT")},
                **{f"c_{c}": 0.0 for c in ("LSJZ_ZNDB", "LDB_ZNDB", "LQB_ZNDB", "LT_ZNDB", "KT_ZNDB", "HPF_ZNDB",
                                           "ALL_ZNDB")},
                **{f"on_{c}": 0.0 for c in ("LSJZ_Run", "LDB_Run", "LQB_Run", "LT_Run", "KT_Run", "HPF_Run")})
    base.update(cols)
    return spark.createDataFrame([tuple(base.values())], list(base.keys()))


def test_d4_room_temperature_unclamped(spark):
    for ztx, zts, want in ((32.0, 30.0, 50.0), (28.0, 28.0, 100.0), (20.0, 21.0, 0.0), (40.0, 40.0, -100.0)):
        x = _score_row(spark, m_ZTX_T=ztx, m_ZTS_T=zts)
        assert K.scores(x, Params(), ("d4",)).first().d4 == pytest.approx(want)


def test_d5_chiller_branches(spark):
    p = Params()
    off = _score_row(spark, on_LSJZ_Run=0.0, c_LSJZ_ZNDB=10.0)
    assert K.scores(off, p, ("d5",)).first().d5 == 0.0
    no_energy = _score_row(spark, on_LSJZ_Run=1.0, c_LSJZ_ZNDB=0.0)
    assert K.scores(no_energy, p, ("d5",)).first().d5 == 0.0
    # W = 4182*1000*y*(OT-IT)*20 / (216e6 * c); y=30, OT-IT=5, c=1 → 58.08 > 5 → 100
    hi = _score_row(spark, on_LSJZ_Run=1.0, c_LSJZ_ZNDB=1.0, m_LD_yield=30.0, m_LD_OT=12.0, m_LD_IT=7.0)
    assert K.scores(hi, p, ("d5",)).first().d5 == 100.0
    lo = _score_row(spark, on_LSJZ_Run=1.0, c_LSJZ_ZNDB=100.0, m_LD_yield=30.0, m_LD_OT=12.0, m_LD_IT=7.0)
    w = 4182 * 1000 * 30 * 5 * 20 / (216000000 * 100)
    assert K.scores(lo, p, ("d5",)).first().d5 == pytest.approx(w / 5 * 100)


def test_d1_power(spark):
    p = FIXTURE_PARAMS
    x = _score_row(spark, e_ALL_ZNDB=0.0)
    assert K.scores(x, p, ("d1",)).first().d1 == 100.0
    e = 1200.0 / (500 * 24)      # 0.1 > 0.05
    x = _score_row(spark, e_ALL_ZNDB=1200.0)
    assert K.scores(x, p, ("d1",)).first().d1 == pytest.approx(100 - (e - 0.05) / e * 100)
    x = _score_row(spark, e_ALL_ZNDB=1200.0, area=0.0)
    assert K.scores(x, p, ("d1",)).first().d1 is None     # area 0 → NULL, not ±Infinity (Q-8)


def test_ventilation_gates_d2_d3_d24(spark):
    p = FIXTURE_PARAMS
    off = _score_row(spark, on_KT_Run=0.0, on_HPF_Run=0.0, c_ALL_ZNDB=5.0)
    r = K.scores(off, p, ("d2", "d3", "d24")).first()
    assert (r.d2, r.d3, r.d24) == (0.0, 0.0, 0.0)
    on_no_energy = _score_row(spark, on_KT_Run=1.0, c_ALL_ZNDB=0.0)
    r = K.scores(on_no_energy, p, ("d2", "d24")).first()
    assert r.d2 == 100.0 and r.d24 == 0.0
    st = K.kpi_real_status(_score_row(spark, on_HPF_Run=1.0), p).first()
    assert (st.st_d2, st.st_d3, st.st_d24, st.st_d4) == (1.0, 1.0, 1.0, 1.0)


def test_kpi_day_range_window_with_gaps(spark):
    rows = [("sa", T + k, 100.0, *([50.0] * 8), *([1.0] * 8)) for k in (0, 1)] + \
           [("sa", T + 80, 100.0, *([20.0] * 8), *([1.0] * 8))]
    cols = ["station_abbr", "seq", "d1", "d2", "d3", "d4", "d5", "d10", "d15", "d20", "d24",
            "st_d2", "st_d3", "st_d4", "st_d5", "st_d10", "st_d15", "st_d20", "st_d24"]
    day = {r.seq: r for r in K.kpi_day(spark.createDataFrame(rows, cols)).collect()}
    assert day[T + 1].d2 == 50.0
    assert day[T + 80].d2 == 20.0          # T and T+1 are more than 71 ticks back
    zero = spark.createDataFrame([("sa", T, 100.0, *([0.0] * 16))], cols)
    assert K.kpi_day(zero).first().d5 == 0.0   # denominator 0 → 0


def test_run_status_by_day_blocks_equals_the_definition(spark):
    import random
    r = random.Random(5)
    log = [("sa", i, at(T + r.randrange(400), r.randrange(0, 1200, 300)), r.choice("01")) for i in (1, 2) for _ in range(25)]
    log += [("sa", 3, at(T), "1"), ("sa", 3, at(T + 72), "1"), ("sa", 3, at(T + 300, 1), "1")]  # on the blocks' edges
    ids = spark.createDataFrame([("sa", i) for i in (1, 2, 3, 4)], "station_abbr string, id int")
    ticks = range(T - 2, T + 480)
    grid = spark.createDataFrame([("sa", t) for t in ticks], "station_abbr string, seq bigint")
    got = {(x.id, x.seq): x.on for x in S.point_on_at(spark.createDataFrame(log, SC.STATUS), ids, grid).collect()}
    assert len(got) == 4 * len(ticks)
    for i in (1, 2, 3, 4):
        for t in ticks:
            seen = [(ts, v) for _, j, ts, v in log if j == i and at(t - 72) < ts < at(t)]
            last = max((ts for ts, _ in seen), default=None)
            assert got[i, t] == int(any(v == "1" for ts, v in seen if ts == last)), (i, t - T)
