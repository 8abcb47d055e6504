import random
import re

import numpy as np
import xxhash

from tests.llm.conftest import ODD
from voltrail.llm import simhash as S
from voltrail.llm.components import components


def fold(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def brute_print(text, n=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", fold(text or ""))
    h = [xxhash.xxh64_intdigest(" ".join(w[j:j + n]).encode(), seed=42) for j in range(max(1, len(w) - n + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, tau=4):
    """Root (least index) of each fingerprint."""
    v = np.array(prints, dtype=np.uint64)
    root = list(range(len(v)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(v)):
        for j in np.flatnonzero(np.bitwise_count(v[i + 1:] ^ v[i]) <= tau) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(v))]


def texts():
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7)))
    out = []
    for _ in range(40):
        w = [word() for _ in range(r.randint(30, 120))]
        for _ in range(r.randint(1, 6)):
            v = list(w)
            for _ in range(r.randint(0, 2)):
                v[r.randrange(len(v))] = word()
            out.append(" ".join(v))
    return out


def test_fingerprints_equal_the_definition():
    some = [*texts(), *(t or "" for _, t in ODD[:9] if t is None or len(t) < 5000), "ÀÉ Abc", "a b c d", "a b c d e"]
    got = S.fingerprints_of([t.encode() for t in some], 4, 42)
    assert got.tolist() == [brute_print(t) for t in some]


def expected(rows):
    prints = [brute_print(t) for _, t in rows]
    roots = brute_components(prints)
    least = {}
    for (i, _), r in zip(rows, roots):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return [(i, f"{p:016x}", least.get(r)) for (i, _), p, r in zip(rows, prints, roots)]


def test_components_equal_brute_force(spark, docs_of):
    rows = [*((100 + i, t) for i, t in enumerate(texts())), *((i, t) for i, t in ODD if t is None or len(t) < 5000)]
    got = [tuple(r) for r in S.digests(docs_of(rows, True)).collect()]
    assert sorted(got, key=str) == sorted(expected(rows), key=str)
    assert S.digests(docs_of([])).count() == 0


def test_one_document_of_each_group_stays(spark, docs_of):
    some = texts()
    rows = [*((100 + i, t) for i, t in enumerate(some)), (5, some[0]), (5, some[1] + " other words"), (1, None), (2, ""), (None, some[3])]
    df = docs_of(rows, True)
    out = S.keep_one(df)
    assert out.columns == df.columns
    want = {i for i, _, c in expected(rows) if i is not None and i == c}
    got = [r["doc_id"] for r in out.collect()]
    assert sorted(x for x in got if x is not None) == sorted(want) and got.count(None) == 1


def test_every_link_is_found_for_any_thresholds(spark):
    r = random.Random(7)
    prints = set()
    for _ in range(150):
        x = r.getrandbits(64)
        prints.add(x)
        for _ in range(3):
            y = x
            for b in r.sample(range(64), r.randint(1, 6)):
                y ^= 1 << b
            prints.add(y)
    prints = sorted(prints)
    signed = [x - 2**64 if x >= 2**63 else x for x in prints]
    members = spark.createDataFrame([(x, x) for x in signed], "fp bigint, class bigint")
    want = {tuple(sorted((signed[i], signed[j]))) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4}
    bits = list(range(64))
    for parts in ([(bits[:21], 1), (bits[21:42], 1), (bits[42:], 0)], [(bits[::2], 1), (bits[1::2], 2)], [(bits[i::5], 0) for i in range(5)]):
        assert sum(t + 1 for _, t in parts) == 5
        got = {tuple(x) for x in S.class_links(members, parts, 4).collect()}
        assert got == want


def test_allocation_is_the_cheapest():
    from itertools import product
    rng = np.random.default_rng(3)
    for m in (2, 3, 4):
        costs = np.cumsum(rng.random((m, 5)), axis=1).tolist()
        cost, limits = S.allocate(costs, 4)
        every = [(sum(costs[i][t] for i, t in enumerate(ts) if t >= 0), ts) for ts in product(range(-1, 5), repeat=m) if sum(t + 1 for t in ts) == 5]
        assert abs(cost - min(every)[0]) < 1e-9 and sum(t + 1 for t in limits) == 5


def test_components_of_paths_stars_and_ties(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(1, 7)] + [(50, 51), (51, 50), (60, 60), (8, 9), (9, 10), (10, 8)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = {**{i: 100 for i in range(100, 141)}, **{i: 1 for i in range(1, 8)}, 50: 50, 51: 50, 8: 8, 9: 8, 10: 8}
    assert got == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
