import math

import numpy as np
from pyspark.sql import functions as F

from voltrail.llm import hard_negatives as M

SCHEMA = "vec_id bigint, label int, embedding array<float>"


def brute(rows, positives=5, negatives=10, every=100):
    """The definition, row against row; repeated rows count once."""
    sound = set()
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            sound.add((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    out = []
    for i, label, v in sound:
        if i % every:
            continue
        scored = {(-sum(a * b for a, b in zip(v, w)), j, other == label) for j, other, w in sound if j != i or other != label}
        near = sorted({(s, j) for s, j, same in scored if same and j != i})[:positives]
        for s, j in near:
            window = sorted({(t, k) for t, k, same in scored if not same and 30 * -s <= 100 * -t <= 90 * -s})[:negatives]
            out += [(i, j, r + 1, k, -s, -t) for r, (t, k) in enumerate(window)]
    return sorted(out)


def random_rows(n=400, seed=1, width=8):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(12, width))
    return [(i, int(r.integers(10)), [float(x) for x in (centres[i % 12] + r.normal(scale=0.05 if i % 3 else 1.0, size=width)).round(2)]) for i in range(n)]


def got(spark, rows, extra=False, **how):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        df = df.withColumns({c: F.lit("x") for c in ("block", "ids", "labels", "query", "rank", "score", "anchor_id", "kind", "id")})
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(map(tuple, M.mine(df.withColumn("label", moved), F.col("vec_id") % 100 == 0, **how).collect()))


def test_many_blocks_and_chunks_equal_brute_force(spark):
    rows = random_rows()
    assert got(spark, rows, extra=True, block=37, limit=2) == brute(rows) != []


def test_nulls_ties_repeated_rows_and_vectors_of_several_lengths(spark):
    base = random_rows(120, 2, 4)
    odd = [(None, 1, [1.0]), (200, None, [1.0]), (300, 1, None), (400, 1, [1.0, None]), (500, 1, [float("nan")]), (600, 2, [float("inf")]), (700, 3, []), (800, 3, [0.5]), (900, 3, [0.5, 0.25, 0.5, 1.0, 2.0])]
    ties = [(1000 + i, i % 4, [1.0, 1.0, 0.0, 0.0]) for i in range(40)]
    near = [(2000 + i, i % 4, [0.7, 0.7, 0.0, 0.1]) for i in range(40)]
    rows = base + odd + ties * 3 + near + base[:30]
    assert got(spark, rows, block=50) == brute(rows)


def test_no_rows_no_anchors_and_a_lone_label(spark):
    assert got(spark, []) == [] and got(spark, [(1, 1, [1.0])]) == [] and got(spark, [(100, 1, [1.0])]) == []
    assert got(spark, [(100, 1, [1.0]), (101, 1, [1.0])]) == []


def test_scores_beyond_exact_doubles(spark):
    rows = [(i, i % 3, [2.0 ** 21 + i, 3.0 + i]) for i in range(0, 400, 25)]
    assert got(spark, rows) == brute(rows)


def tree_of(x):
    order, nodes, centres, radii, norm = M.cover_tree(x.astype(float))
    return M.Tree({"ids": order.astype(np.int64).tobytes(), "labels": (order % 10).astype(np.int64).tobytes(), "vectors": x[order].astype(np.int64).tobytes(), "kind": "int64", "width": x.shape[1],
                   "nodes": nodes.tobytes(), "centres": centres.tobytes(), "radii": radii.tobytes(), "norm": norm})


def test_every_node_covers_its_rows_and_bounds_their_products():
    r = np.random.default_rng(3)
    x = np.concatenate([np.floor(256 * (c + r.normal(scale=s, size=(600, 16)))) for c, s in ((0.0, 1.0), (3.0, 0.02), (-2.0, 0.1))])
    t = tree_of(x)
    q = np.floor(256 * r.normal(size=(20, 16)))
    low, high = t.bounds(q, np.sqrt((q ** 2).sum(axis=1)), slice(0, len(t.nodes)))
    at = 0
    assert sorted(t.ids) == list(range(len(x))) and len(t.nodes) > 20
    for i, (first, last, child, n) in enumerate(t.nodes):
        products = q @ t.vectors[first:last].T
        assert (products.min(axis=1) >= low[:, i]).all() and (products.max(axis=1) <= high[:, i]).all()
        if n:
            assert t.nodes[child][0] == first and t.nodes[child + n - 1][1] == last
        else:
            at += last - first
    assert at == len(x)


def test_identical_rows_are_one_leaf():
    t = tree_of(np.full((1000, 3), 7.0))
    assert len(t.nodes) == 1 and t.radii[0] == 0.0


def test_windows_skip_what_lies_outside(monkeypatch):
    r = np.random.default_rng(4)
    x = np.concatenate([np.floor(256 * (c + r.normal(scale=0.01, size=(1000, 8)))) for c in np.eye(8) * 4])
    t, verified = tree_of(x), []
    exact = M.products
    monkeypatch.setattr(M, "products", lambda a, b: verified.append(len(b)) or exact(a, b))
    ids = np.array([int(t.ids[0])])
    q = M.Queries(t.vectors[:1], ids, t.labels[:1].copy(), True, np.zeros(1, dtype=np.int64), np.full(1, M.LEAST), np.full(1, M.MOST), 5)
    best = M.Best(1, 5)
    q.search(t, best)
    assert sum(verified) < len(x) / 4  # only one of eight clusters is near
    scores = exact(t.vectors[:1], t.vectors)[0]
    fits = (t.labels == t.labels[0]) & (t.ids != t.ids[0])
    assert best.scores[0].tolist() == sorted(scores[fits].tolist(), reverse=True)[:5]
