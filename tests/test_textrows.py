"""Typed writes of text: what becomes a row, what is rejected, and that nothing is lost or written twice."""
import datetime as dt

from pyspark.sql import types as T

from voltrail.session import scratch_path
from voltrail.sources import textrows as TR

SCHEMA = T.StructType([T.StructField("key", T.StringType()), T.StructField("age", T.IntegerType()), T.StructField("day", T.DateType())])
LINES = ["a, 5 ,2024-01-02", "a,6,2024-01-01", " b ,,", "c,x,2024-01-01", ",1,2024-01-01", "d,1", "d,1,2024-01-01,9", "e,7,2024-13-01", "", None, "d,1", "f,99999999999,"]


def lines(spark, items):
    return spark.createDataFrame([(x,) for x in items], "line string")


def stored(spark, root):
    return sorted(tuple(r) for r in TR.read_typed(spark, root, SCHEMA).collect())


def rejected(spark, root):
    return {(r.batch, r.line): (r.reason, r.n) for r in TR.read_rejected(spark, root).collect()}


def test_rows_and_rejected_lines_are_all_lines(spark):
    root = scratch_path(spark, "textrows")
    for _ in range(2):  # the second write changes nothing
        TR.typed_write(lines(spark, LINES), SCHEMA, root, ["key"], ["day"])
        assert stored(spark, root) == [("a", 5, dt.date(2024, 1, 2)), ("b", None, None)]
        bad = rejected(spark, root)
        assert bad == {(0, "c,x,2024-01-01"): ("age is no int", 1), (0, ",1,2024-01-01"): ("key is empty", 1), (0, "d,1"): ("2 cells instead of 3", 2),
                       (0, "d,1,2024-01-01,9"): ("4 cells instead of 3", 1), (0, "e,7,2024-13-01"): ("day is no date", 1), (0, ""): ("1 cells instead of 3", 1),
                       (0, None): ("no line", 1), (0, "f,99999999999,"): ("age is no int", 1)}
        assert sum(n for _, n in bad.values()) + 3 == len(LINES)


def test_a_later_write_wins_where_its_order_columns_are_no_less(spark):
    root = scratch_path(spark, "textrows")
    TR.typed_write(lines(spark, ["a,1,2024-01-05", "b,1,2024-01-05"]), SCHEMA, root, ["key"], ["day"], 1)
    TR.typed_write(lines(spark, ["a,2,2024-01-05", "b,2,2024-01-04", "c,2,x"]), SCHEMA, root, ["key"], ["day"], 2)
    assert [(k, a) for k, a, _ in stored(spark, root)] == [("a", 2), ("b", 1)]
    assert rejected(spark, root) == {(2, "c,2,x"): ("day is no date", 1)}


def test_nothing_written_and_other_separators(spark):
    root = scratch_path(spark, "textrows")
    TR.typed_write(lines(spark, []), SCHEMA, root, ["key"])
    assert stored(spark, root) == [] and rejected(spark, root) == {}
    TR.typed_write(lines(spark, ["a|b,c|2024-01-01", "x|3|2024-01-01"]), SCHEMA, root, ["key"], sep="|")
    assert stored(spark, root) == [("x", 3, dt.date(2024, 1, 1))]
    assert [v[0] for v in rejected(spark, root).values()] == ["age is no int"]
