"""Codec and tick literals (FIXTURES §3)."""
import datetime as dt

from pyspark.sql import functions as F

from voltrail.functions import codec as C
from voltrail.functions import ticks as TK


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_digits_and_letters(spark):
    assert one(spark, C.digits_only(F.lit("qlz2018-08-10 00:20:00"))) == "20180810002000"
    assert one(spark, C.key_head(F.lit("qlz20180810004000"))) == "qlz"
    assert one(spark, C.key_tail(F.lit("qlz20180810004000"))) == "20180810004000"
    assert one(spark, C.letters_only(F.lit("qlz20180810004000"))) == "qlz"


def test_key_regex(spark):
    rx = ".*(20171212104000|20171213102000|20171213104000){1}"
    assert one(spark, F.lit("yzl20171213104000").rlike(rx)) is True
    assert one(spark, F.lit("yzl20171213100000").rlike(rx)) is False


def test_clean_value(spark):
    assert one(spark, C.clean_value(F.lit("7.8753e-43"))) == 7.8753e-43
    assert one(spark, C.clean_value(F.lit("\\N"))) == 0.0
    assert one(spark, C.clean_value(F.lit(None).cast("string"))) == 0.0
    assert one(spark, C.clean_value(F.lit("junk"))) == 0.0


def test_tick_shift_across_edges(spark):
    # start / last day of 2018-02-16 20:20 and across a month edge (Q-7)
    for end, start, last in (("20180216202000", "20180216200000", "20180215202000"),
                             ("20180301000000", "20180228234000", "20180228000000")):
        t = TK.parse_tick(F.lit(end))
        assert one(spark, TK.tick_text(TK.shift_ticks(t, -1))) == start
        assert one(spark, TK.tick_text(TK.shift_ticks(t, -72))) == last


def test_tick_floor_and_parse(spark):
    ts = F.lit(dt.datetime(2024, 1, 1, 0, 39, 59)).cast("timestamp")
    assert one(spark, TK.tick_text(TK.tick_floor(ts))) == "20240101002000"
    assert one(spark, TK.parse_tick(F.lit("2018021620200"))) is None   # 13 digits: rejected
    assert one(spark, C.pad3(F.lit(7))) == "007"
