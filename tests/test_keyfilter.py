"""C-14: what is derived from a key expression holds for every key it matches, and reaches the scan."""
import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from voltrail.operators import keyfilter as KF


def holds(bound, station, time):
    if bound.station is not None and station != bound.station:
        return False
    return station.startswith(bound.begins) and (bound.first is None or bound.first <= time <= bound.last)


def keys(r, n):
    for _ in range(n):
        t = dt.datetime(2018, 1, 1) + dt.timedelta(minutes=20 * r.randrange(60000))
        yield "".join(r.choice("abs") for _ in range(r.randrange(4))), t


def random_expression(r, depth=2):
    def one():
        k = r.randrange(12)
        if k < 4:
            return r.choice(["a", "b", "s", "2018", "20180", "08", "10", "0", "00", "20180810", "20190101"])
        if k == 4:
            return r.choice([".*", ".", ".+", "\\d", "\\d{6}", "\\d{14}", "[0-9]{14}", ".?", "\\d*"])
        if k == 5:
            return r.choice(["[ab]", "[0-2]", "[a-s]", "[01][0-9]"])
        if k < 8 and depth:
            return "(" + r.choice(["", "?:"]) + "|".join(random_expression(r, depth - 1) for _ in range(r.randrange(1, 4))) + ")" + r.choice(["", "", "{1}", "{2}", "?"])
        return r.choice(["20180810", "2018", "a", "b20"])
    return "".join(one() for _ in range(r.randrange(1, 4)))


def test_every_matching_key_is_within_the_bounds():
    r, matched, derived = random.Random(14), 0, 0
    rows = list(keys(r, 300))
    rows += [("a", dt.datetime(2018, 8, 10)), ("ab", dt.datetime(2018, 8, 10, 0, 20)), ("", dt.datetime(2019, 1, 1))]
    for _ in range(4000):
        e = r.choice(["", "^", ".*"]) + random_expression(r) + r.choice(["", "", "$", "\\d{6}$", ".*"])
        try:
            bounds = KF.derive(e)
        except RecursionError:
            raise AssertionError(e)
        if bounds is None:
            continue
        derived += any(b != KF.Bound() for b in bounds)
        for station, time in rows:
            if re.search(e, f"{station}{time:%Y%m%d%H%M%S}"):
                matched += 1
                assert any(holds(b, station, time) for b in bounds), (e, station, time, bounds)
    assert matched > 10000 and derived > 500


@pytest.mark.parametrize("expression,bounds", [
    (".*(20180810002000|20180810004000){1}", [KF.Bound(first=dt.datetime(2018, 8, 10, 0, 20), last=dt.datetime(2018, 8, 10, 0, 20)), KF.Bound(first=dt.datetime(2018, 8, 10, 0, 40), last=dt.datetime(2018, 8, 10, 0, 40))]),
    ("^sa20180810", [KF.Bound(station="sa", first=dt.datetime(2018, 8, 10), last=dt.datetime(2018, 8, 10, 23, 59, 59))]),
    ("^s[ab]201802", [KF.Bound(station=x, first=dt.datetime(2018, 2, 1), last=dt.datetime(2018, 2, 28, 23, 59, 59)) for x in ("sa", "sb")]),
    ("2018081[0-2]\\d{6}$", [KF.Bound(first=dt.datetime(2018, 8, 10), last=dt.datetime(2018, 8, 12, 23, 59, 59))]),
    ("^sa", [KF.Bound(begins="sa")]), ("20180810", [KF.Bound()]), ("2018081000200012", []), ("0a", [KF.Bound()]),
])
def test_derived_bounds(expression, bounds):
    assert KF.derive(expression) == bounds


@pytest.mark.parametrize("expression", ["(?i)sa", "a(?=2)", "(a)\\1", "[^a]2018", "a{1,2}{3}", "(" + "|".join("abcdefgh") + "){5}", "(a", "a)"])
def test_nothing_is_derived_from_what_is_not_read(expression):
    assert KF.derive(expression) is None


ROWS = [("sa", dt.datetime(2018, 8, d, h, m), d * h) for d in (9, 10, 11, 12) for h in (0, 7, 23) for m in (0, 20)] + [
    ("sb", dt.datetime(2018, 8, 10, 0, 20), 1), ("sab", dt.datetime(2018, 8, 10, 0, 20, 0, 5), 2), (None, dt.datetime(2018, 8, 10, 0, 20), 3), ("sa", None, 4)]


@pytest.mark.parametrize("expression", [
    ".*(20180810002000|20180811234000|20180812070000){1}", "^sa2018081[01]0", "2018081(0|2)\\d{6}$", "^s.?b", "sb|^sab", "(?i)SA2018", "0810.*2000$", "2018081000200077", "^sa", "x^",
])
def test_rows_are_those_that_the_expression_matches(spark, tmp_path, expression):
    df = spark.createDataFrame(ROWS, "station_abbr string, tick timestamp, v int").withColumn("date", F.to_date("tick"))
    key = F.concat("station_abbr", F.date_format("tick", "yyyyMMddHHmmss"))
    want = sorted(map(tuple, df.filter(key.rlike(expression)).collect()))
    assert sorted(map(tuple, KF.key_filter(df, expression).collect())) == want
    assert sorted(r[2] for r in KF.key_filter(df.drop("date"), expression).collect()) == sorted(r[2] for r in want)


def test_predicates_reach_the_scan(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "station_abbr string, tick timestamp, v int").withColumn("date", F.to_date("tick"))
    path = str(tmp_path / "readings")
    df.filter(F.col("date").isNotNull()).write.partitionBy("date").parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    for expression, files in ((".*(20180810002000|20180811234000){1}", 2), ("^sa2018081[01]", 2), ("^sb20180810", 1)):
        got = KF.key_filter(stored, expression)
        plan = got._jdf.queryExecution().executedPlan().toString()
        scan = plan[plan.index("PartitionFilters"):]
        assert "date" in scan[:scan.index("PushedFilters")]
        pushed = scan[scan.index("PushedFilters"):scan.index("ReadSchema")]
        assert "tick" in pushed
        assert ("station_abbr" in pushed.replace("IsNotNull(station_abbr)", "")) == expression.startswith("^")
        assert got.select(F.col("_metadata.file_path")).distinct().count() <= files * spark.sparkContext.defaultParallelism
        assert {r["date"].day for r in got.collect()} <= {10, 11}


def test_many_instants_make_no_deep_plan(spark):
    ticks = [dt.datetime(2018, 8, 1) + dt.timedelta(minutes=20 * i) for i in range(0, 2000, 2)]
    df = spark.createDataFrame([("sa", t) for t in ticks[:5]] + [("sb", dt.datetime(2019, 1, 1))], "station_abbr string, tick timestamp")
    assert KF.key_filter(df, ".*(" + "|".join(f"{t:%Y%m%d%H%M%S}" for t in ticks) + ")").count() == 5
