import hashlib
import random
import re

import numpy as np

from tests.llm.conftest import ODD
from voltrail.llm import substring_dedup as S


def brute(rows):
    """What is left of each row; rows alike are one document."""
    seen, out = set(), {}
    for i, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        gone = set()
        for j in range(len(w) - 19):
            k = tuple(w[j:j + 20])
            if k in seen:
                gone.update(range(j, j + 20))
            seen.add(k)
        out[i, t] = (len(w), len(gone), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest())
    return [(i, *out[i, t]) for i, t in rows]


def rows():
    r = random.Random(5)
    passages = [" ".join(r.choice("abcdefgh") for _ in range(r.randint(5, 60))) for _ in range(12)]
    out = [(i, " ".join(r.choice(passages) for _ in range(r.randint(0, 8)))) for i in range(100, 400)]
    return [*out, (1000, "a " * 500), (1001, "a " * 300 + "b"), (-5, "a " * 25), *(x for x in ODD if x[0] != 4), (4, "same id and text"), (4, "same id and text")]


def test_dedup_equals_brute_force(spark, docs_of):
    given = rows()
    got = [tuple(r) for r in S.digests(docs_of(given, True).repartition(7)).collect()]
    assert sorted(got, key=str) == sorted(brute(given), key=str)
    assert S.digests(docs_of([])).count() == 0


def test_small_blocks_and_flushes_change_nothing(spark, docs_of, monkeypatch):
    given = [x for x in rows() if x[0] is not None]
    monkeypatch.setattr(S, "BLOCK", 2000)
    want = sorted(brute(given))
    assert sorted(tuple(r) for r in S.digests(docs_of(given).repartition(3)).collect()) == want


def test_a_row_a_group_gives_what_packed_blocks_give():
    import pyarrow as pa
    texts = [(t or "").encode() for i, t in rows() if i is not None]
    ids = np.arange(len(texts))
    _, groups = S.index_part(ids, ids * 0, texts, np.empty(0, dtype=np.uint64))
    back = S.groups_of(S.group_rows(*groups))
    assert all((a == b.ravel()).all() for a, b in zip(back, groups))
    assert all(len(x) == 0 for x in S.groups_of(S.group_rows(*(g[:0] for g in groups))))
    filed, id_, tag, start, n, five = groups
    whole = S.match_block(pa.table({"block": pa.array([0], pa.int32()), "held": pa.array([S.packed(*groups)], pa.binary())}), True)
    rowwise = S.match_block(pa.table({"block": pa.array([0] * len(n), pa.int32()), "held": S.group_rows(*groups)}), False)
    assert whole.num_rows == rowwise.num_rows and whole.equals(rowwise)


def test_many_blocks_change_nothing(spark, docs_of, monkeypatch):
    given = [x for x in rows() if x[0] is not None]
    monkeypatch.setattr(S, "BLOCK", 3)  # more than ``PACKED`` blocks
    assert sum(len(t or "") for _, t in given) / 3 > S.PACKED
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        assert sorted(tuple(r) for r in S.digests(docs_of(given).repartition(3)).collect()) == sorted(brute(given))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_equal_ids_with_other_texts_are_documents_of_their_own(spark, docs_of):
    passage = " ".join(f"w{i}" for i in range(30))
    got = sorted(tuple(r)[:3] for r in S.digests(docs_of([(1, passage), (1, passage + " more"), (2, passage)])).collect())
    assert [g[:2] for g in got] == [(1, 30), (1, 31), (2, 30)]
    assert sorted(g[2] for g in got if g[0] == 1) in ([0, 30], [0, 30]) and got[2][2] == 30


def test_windows_over_factor_boundaries(spark, docs_of):
    a, b = [f"a{i}" for i in range(40)], [f"b{i}" for i in range(40)]
    given = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(["x", *a[30:], *b[:10], "y"])), (4, " ".join(a + b))]
    got = sorted(tuple(r) for r in S.digests(docs_of(given)).collect())
    assert got == sorted(brute(given)) and got[3][2] == 80  # the middle stands in document 3 only


def test_factors_name_an_earlier_place(spark, docs_of):
    a = [f"a{i}" for i in range(60)]
    df = S.keyed(docs_of([(1, " ".join(["q", *a])), (2, " ".join(["r", "s", *a[:50]]))]))
    found = [r.asDict() for r in S.factors(df).collect()]
    assert {(f["id"], f["ref_id"], f["ref_start"] - f["start"]) for f in found} == {(2, 1, -1)}
    covered = {i for f in found for i in range(f["start"], f["start"] + f["n"])}
    assert covered == set(range(2, 52))


def test_sliding_least():
    x = np.random.default_rng(1).integers(0, 99, 50)
    for n in (1, 2, 3, 7, 10):
        assert S.sliding_least(x, n).tolist() == [x[i:i + n].min() for i in range(50 - n + 1)]


def test_a_phrase_with_other_words_around_it_is_spread_over_blocks(spark, docs_of, monkeypatch):
    phrase = " ".join(f"p{i}" for i in range(18))
    given = [(i, f"a{i} b{i} {phrase} e{i} f{i}") for i in range(300)]
    given += [(1000 + i, given[i][1]) for i in range(0, 300, 50)]
    df = docs_of(given)
    for hot in (10**9, 50):
        monkeypatch.setattr(S, "HOT", hot)
        assert (len(S.hot_anchors(S.keyed(df))) > 0) == (hot == 50)
        assert sorted(tuple(r) for r in S.digests(df).collect()) == sorted(brute(given))
    sizes = lambda h: [len(v) for b in S.index_blocks(20, h)(S.keyed(df).select("id", "tag", "text").toArrow().to_batches()) for v in b.column(1).to_pylist()]
    none, some = sizes(np.empty(0, dtype=np.uint64)), sizes(S.hot_anchors(S.keyed(df)))
    assert max(some) < max(none) / 2


def test_a_phrase_that_is_rare_in_every_task_is_spread(spark, docs_of, monkeypatch):
    phrase = " ".join(f"p{i}" for i in range(18))
    given = [(i, f"a{i} b{i} {phrase} e{i} f{i}" if i % 4 == 0 else " ".join(f"c{i}x{j}" for j in range(22))) for i in range(2400)]
    given += [(5000 + i, given[i][1]) for i in range(0, 2400, 100)]
    monkeypatch.setattr(S, "FLUSH", 28 * 120)  # some seven places of the phrase
    monkeypatch.setattr(S, "HOT", 200)
    rows = S.keyed(docs_of(given).repartition(6)).select("id", "tag", "text")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 28)
    try:
        hot = S.hot_anchors(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    of_phrase = S.anchored(S.words.split([f"q r {phrase} s t".encode()]))[1]
    assert set(of_phrase[2:3].tolist()) <= set(hot.tolist()) and len(hot) < 10
    assert sorted(tuple(r) for r in S.digests(docs_of(given)).collect()) == sorted(brute(given))


def test_tasks_follow_the_blocks(spark, docs_of, monkeypatch):
    given = [x for x in rows() if x[0] is not None]
    monkeypatch.setattr(S, "PART", 4000)
    size = sum(len((t or "").encode()) for _, t in given)
    plan = S.factors(S.keyed(docs_of(given)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(block#") == 1  # grouped where the blocks are
    assert f", {-(-size // 4000)}), REPARTITION_BY_NUM" in plan
    assert sorted(tuple(r) for r in S.digests(docs_of(given)).collect()) == sorted(brute(given))


def test_windows_of_one_anchor_are_told_apart_by_all_bits_of_their_hash():
    import pyarrow as pa
    low = np.uint64(0x1234567890)  # the five low bytes are alike
    groups = lambda high: (np.array([7, 7], dtype=np.uint64), np.array([1, 2]), np.array([0, 0]), np.array([0, 0], dtype=np.int32), np.array([1, 1], dtype=np.int32), np.array([3 << 40, high << 40], dtype=np.uint64) | low)
    for high, found in ((3, [2]), (4, [])):
        packed = pa.table({"block": pa.array([0], pa.int32()), "held": pa.array([S.packed(*groups(high))], pa.binary())})
        rowwise = pa.table({"block": pa.array([0, 0], pa.int32()), "held": S.group_rows(*groups(high))})
        assert S.match_block(packed, True)["id"].to_pylist() == S.match_block(rowwise, False)["id"].to_pylist() == found


def test_no_bits_of_a_hash_are_left_out():
    text = " ".join(f"w{i}" for i in range(40)).encode()
    _, groups = S.index_part(np.array([1]), np.array([0]), [text], np.empty(0, dtype=np.uint64))
    w = S.words.split([text])
    at = np.arange(21)
    assert groups[5].tolist() == S.words.run_hash(w.hashes(), at, at + 20).tolist()
