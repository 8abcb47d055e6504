import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from voltrail.llm import merkle as M
from voltrail.llm import places

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def brute_tree(nodes):
    """Root, and each leaf's steps (left, right) to it."""
    paths, under = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, below = [], []
        for a in range(0, len(nodes), 3):
            run = nodes[a:a + 3]
            for k in range(len(run)):
                for i in under[a + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1:])))
            up.append(h(*run))
            below.append(sum(under[a:a + 3], []))
        nodes, under = up, below
    return nodes[0], paths


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    trees = {s: brute_tree([leaf_of(r) for r in groups[s]]) for s in names}
    root, above = brute_tree([trees[s][0] for s in names])
    out = []
    for s, up in zip(names, above):
        for r, path in zip(groups[s], trees[s][1]):
            path = path + up
            text = r[4]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            end = leaf_of((*r[:4], text))
            for left, right in path:
                end = h(left, end, right)
            out.append((r[0], leaf_of(r), trees[s][0], root, h(*(a + b for a, b in path)), end, end == root))
    return out


def check(spark, rows, extra=False):
    docs = spark.createDataFrame(rows, SCHEMA)
    if extra:
        docs = docs.withColumns({c: F.lit("x") for c in ("key", "n", "rank", "row", "node", "block", "tree", "path", "kids", "by", "root")})
    got = [tuple(r) for r in M.digests(docs).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_nulls_empty_repeated_and_long_rows_and_clashing_columns(spark):
    check(spark, [(None, None, None, None, None), (None, None, None, None, "a"), (1, "", "en", 0, ""), (1, "", "en", 0, ""), (2, None, "x\n", 3, "a\nb"), (3, "é", "x", 3, "\n"),
                  (3, "é", "x", 3, "\n\n"), (4, "z", None, None, "q\n" * 100000), (5, "Z", "x", 1, "-"), (6, "😀", "x", -1, "1:a")], extra=True)


@pytest.mark.parametrize("n", [1, 4, 28])
def test_small_groups(spark, n):
    check(spark, [(i, None, "en", i, "a\nb") for i in range(n)])


def test_a_group_of_several_tiers(spark):
    # 729 * 3 + 1 leaves: a second tier whose last run has one node.
    check(spark, [(i * 7 % 2189, "hot" if i < 2188 else "b", "en", i, "a\nb" * (i % 2)) for i in range(2300)])


def test_no_rows(spark):
    df = M.digests(spark.createDataFrame([], SCHEMA))
    assert df.collect() == [] and df.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_manifest_keeps_whole_proofs(spark):
    docs = spark.createDataFrame([(i, "s", "en", i, "t") for i in range(5)], SCHEMA)
    got = M.manifest(docs, "source", "doc_id", M.leaf([F.col("doc_id")]), [F.col("doc_id")]).orderBy("doc_id").collect()
    nodes = [leaf_of((i,)) for i in range(5)]
    assert [(s.left, s.right) for s in got[4].path] == [(nodes[3], ""), (h(*nodes[:3]), "")]


def test_ranks_and_running_sums_of_a_long_key(spark, monkeypatch):
    monkeypatch.setattr(places, "STEP", 8)
    df = spark.range(1000).select(F.when(F.col("id") % 3 > 0, "a").otherwise("b").alias("key"), "id", (F.col("id") % 11).alias("size"))
    got = places.running(places.ranked(df, "key", [F.col("id").desc()]), "key", "size", 1000).collect()
    for key in "ab":
        mine, total = sorted((r for r in got if r.key == key), key=lambda r: -r.id), 0
        for i, r in enumerate(mine):
            assert (r.rank, r.n, r.before) == (i, len(mine), total)
            total += r.size
