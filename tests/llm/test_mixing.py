import math
import re
from collections import defaultdict

from pyspark.sql import functions as F

from tests.llm.conftest import ODD
from voltrail.llm import mixing as M

SCHEMA = "doc_id bigint, source string, text string"


def brute_targets(sizes, most=3):
    """Share by weight, cut what is above, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: M.WEIGHTS[i % 3] for i, s in enumerate(names)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in fixed]
        rest, w = total - sum(fixed.values()), sum(weight[s] for s in free)
        share = {s: rest * weight[s] / w for s in free}
        above = [s for s in free if share[s] > most * sizes[s]]
        if not above:
            return share | fixed
        fixed |= {s: most * sizes[s] for s in above}


def check(spark, rows, block=7, extra=False):
    docs = spark.createDataFrame(rows, SCHEMA)
    if extra:
        docs = docs.withColumns({c: F.lit("x") for c in ("key", "size", "rank", "n", "before", "r", "at", "weight", "all", "first", "target", "turn")})
    placed, mixed = M.mix(docs, block_words=block)
    pieces = defaultdict(list)
    for p in mixed.collect():
        pieces[p.key, p.rank].append(p)
    sizes, got = defaultdict(int), defaultdict(int)
    for _, s, t in rows:
        sizes[s] += len(re.findall(M.WORD, t or ""))
    want, total = brute_targets(sizes), sum(sizes.values())
    found = placed.collect()
    assert sorted((r.doc_id or 0, r.size) for r in found) == sorted((i or 0, len(re.findall(M.WORD, t or ""))) for i, _, t in rows)
    for r in found:
        source = None if r.key == "1" else r.key[1:]
        assert r.source_size == sizes[source] and abs(r.target - want[source]) < 1e-6 * max(1, total)
        mine = sorted(pieces[r.key, r.rank], key=lambda p: (p.turn, p.start))
        for a, b in zip(mine, mine[1:]):  # a turn's pieces follow each other from its first word on
            assert b.start == a.start + a.words if a.turn == b.turn else (b.start == 0 and a.start + a.words == r.size)
        taken = sum(p.words for p in mine)
        assert taken <= 3 * r.size
        got[source] += taken
    for s in sizes:
        assert abs(got[s] - want[s]) <= 0.5 + 1e-6
    return mixed


def test_targets_are_met_and_no_word_is_taken_too_often(spark):
    rows = [(i, f"s{i % 4}" if i % 3 else "hot", "w " * (i % 17)) for i in range(300)]
    check(spark, rows, extra=True)


def test_a_source_at_its_limit_leaves_its_excess_to_the_others(spark):
    rows = [(1, "a", "x y z"), (2, "b", "w " * 500), (3, None, "v " * 40), (4, "c", "u " * 200), (5, "d", None)]
    check(spark, rows)
    assert brute_targets({"a": 3, "b": 500, None: 40, "c": 200, "d": 0})["a"] == 9


def test_odd_rows(spark):
    check(spark, [(i, None if i == 5 else "é" if i else "z", t) for i, t in ODD] * 2)


def test_no_rows_and_no_words(spark):
    assert M.digests(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [tuple(r) for r in M.digests(spark.createDataFrame([(1, "a", None), (1, "a", " ")], SCHEMA)).collect()] == [(1, 0, 0, 0.0, 0)] * 2


def test_every_stretch_of_the_schedule_holds_about_the_sources_shares(spark):
    rows = [(i, f"s{i % 5}", "w " * 60) for i in range(100)]
    mixed = check(spark, rows, block=4)
    order = [r.key for r in mixed.groupBy("at").agg(F.first("key").alias("key")).orderBy("at").collect()]
    share = {k: order.count(k) / len(order) for k in set(order)}
    assert len(order) >= 1000
    for n in range(100, len(order), 100):
        for k, p in share.items():
            assert abs(order[:n].count(k) - n * p) <= 2 * math.log2(len(order))


def test_reruns_agree(spark):
    docs = spark.createDataFrame([(i, f"s{i % 3}", "w " * (i % 9)) for i in range(200)], SCHEMA)
    one, two = (sorted(map(tuple, M.digests(d).collect())) for d in (docs, docs.repartition(7, "doc_id")))
    assert one == two
