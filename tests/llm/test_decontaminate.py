import random

from tests.llm.conftest import ODD
from voltrail.llm import decontaminate as D


def given(table):
    import duckdb
    return [(r[0], r[1]) for r in duckdb.sql(f"select * exclude(n) from (select *, 1 n from '/root/testdata/sf0.01/{table}.parquet')").fetchall()]


def distance(item, doc):
    """Least word edits between the item and any stretch of the document."""
    row = [0] * (len(doc) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(doc, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def split(text):
    return D.word_hashes([text.encode()]).hashes().tolist()


def planted(n, share, seed):
    r = random.Random(seed)
    items = [t for _, t in given("benchmark")]
    other = [t for _, t in given("documents") if len(t) > 2000][:60]
    out = []
    for k in range(n):
        i = r.randrange(len(items))
        w = items[i].split()
        for _ in range(int(share * len(split(items[i])))):
            at, kind = r.randrange(len(w)), r.randrange(3)
            w[at:at + 1] = [f"zz{r.randrange(999)}"] if kind == 0 else [] if kind == 1 and len(w) > 1 else [w[at], f"yy{r.randrange(999)}"]
        a, b = r.choice(other).split()[:80], r.choice(other).split()[:80]
        out.append((i, " ".join(a + w + b)))
    return items, out


def test_recall_at_the_most_edits_and_for_copies():
    for share, least in ((0.0, 1.0), (0.1, 0.97), (0.2, 0.9)):
        items, docs = planted(200, share, 3)
        found = D.Index([t.encode() for t in items]).search([t.encode() for _, t in docs])
        assert sum(any(h[0] == i for h in f) for (i, _), f in zip(docs, found)) >= least * len(docs)


def test_every_hit_is_within_the_limit_and_exact():
    items, docs = planted(60, 0.12, 4)
    index = D.Index([t.encode() for t in items])
    for (_, text), found in zip(docs, index.search([t.encode() for _, t in docs])):
        words = split(text)
        for item, start, n, edits in found:
            s = split(items[item])
            assert edits <= int(0.2 * len(s) + 1e-9)
            assert edits == distance(s, words[max(0, start - 2 * len(s)):start + 3 * len(s)])
            assert distance(s, words[start:start + n]) == edits


def test_search_equals_brute_force_on_given_documents():
    items = [t for _, t in given("benchmark")]
    docs = [t or "" for _, t in given("documents")][:300]
    found = D.Index([t.encode() for t in items]).search([t.encode() for t in docs])
    for text, hits in zip(docs, found):
        w, got = split(text), {h[0] for h in hits}
        vocabulary = set(w)
        for k, item in enumerate(items):
            s = split(item)
            limit = int(0.2 * len(s) + 1e-9)
            if sum(x not in vocabulary for x in s) > limit:
                assert k not in got  # more words are missing than edits allowed
            else:
                assert (k in got) == (distance(s, w) <= limit)


def test_leaks_and_clean(spark, docs_of):
    item = "The quick brown fox jumps over the lazy dog and runs away from the very big angry bear"
    near = item.replace("brown", "red").replace(",", "")
    rows = [*ODD, (20, f"before {item}, after"), (21, f"x {near.upper()} y"), (22, "The quick brown fox is elsewhere"), (23, item)]
    items = spark.createDataFrame([(1, item), (2, item + "!"), (3, None), (4, ""), (5, "..."), (6, "not there at all in any")], "item_id bigint, text string").selectExpr("*", "1 as doc_id")
    df = docs_of(rows, True)
    got = sorted((r["doc_id"], r["item_id"], r["start_word"], r["distance"]) for r in D.leaks(df, items).collect())
    assert got == [(d, i, s, e) for d, s, e in ((20, 1, 0), (21, 1, 1), (23, 0, 0)) for i in (1, 2)]
    out = D.clean(df, items)
    assert out.columns == df.columns
    assert sorted((str(r["doc_id"]) for r in out.collect())) == sorted(str(i) for i, _ in rows if i not in (20, 21, 23))
    none = items.limit(0)
    assert D.leaks(df, none).count() == 0 and D.clean(df, none).count() == len(rows) and D.leaks(docs_of([]), items).count() == 0


def test_more_blocks_find_the_same(spark, docs_of, monkeypatch):
    items, docs = planted(40, 0.0, 6)
    table = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    df = docs_of([(k, t) for k, (_, t) in enumerate(docs)])
    whole = sorted(tuple(r) for r in D.leaks(df, table).collect())
    monkeypatch.setattr(D.blocks, "__defaults__", (3000,))
    assert sorted(tuple(r) for r in D.leaks(df, table).collect()) == whole and len(whole) >= 40


def test_items_at_the_edges_of_texts():
    item = " ".join(f"w{i}" for i in range(20))
    cut = [" ".join(f"w{i}" for i in range(4, 20)), " ".join(f"w{i}" for i in range(16)), "x y " + item, item + " x y", item]
    found = D.Index([item.encode()]).search([t.encode() for t in cut] + [b"", b"w1"])
    assert [[(h[1], h[3]) for h in f] for f in found] == [[(0, 4)], [(0, 4)], [(2, 0)], [(0, 0)], [(0, 0)], [], []]


def sized(sizes, seed):
    r = random.Random(seed)
    return [" ".join(f"v{r.randrange(20000)}" for _ in range(n)) for n in sizes]


def missed(items, of, n, seed):
    """Share of ``n`` documents with an item of ``of``, edited as much as is allowed, in which it isn't found."""
    r, docs = random.Random(seed), []
    for _ in range(n):
        i = r.choice(of)
        w = items[i].split()
        for _ in range(int(0.2 * len(w) + 1e-9)):
            at, kind = r.randrange(len(w)), r.randrange(3)
            w[at:at + 1] = [f"zz{r.randrange(9999)}"] if kind == 0 else [] if kind == 1 and len(w) > 1 else [w[at], f"yy{r.randrange(9999)}"]
        a, b = ([f"q{r.randrange(999)}" for _ in range(40)] for _ in range(2))
        docs.append((i, " ".join(a + w + b)))
    found = D.Index([t.encode() for t in items]).search([t.encode() for _, t in docs])
    return sum(all(h[0] != i for h in f) for (i, _), f in zip(docs, found)) / n


def test_each_size_class_reaches_the_recall():
    # A tenth of the items is long, behind the first 400 or among too few of them to count in a pooled rate.
    for short in (270, 900):
        items = sized([12] * short + [400] * (short // 9), 1)
        assert missed(items, range(short, len(items)), 300, 5) <= 0.06
        assert missed(items, range(short), 300, 5) <= 0.06


def test_trials_are_spread_over_all_items():
    index = D.Index([t.encode() for t in sized([12] * 1000, 2)])
    tried = [i for i, _, _ in index.edited([D.np.arange(1000)])]
    assert len(set(tried)) == D.TRIALS and max(tried) > 990 and index.most.max() == 2


def test_classes_that_the_walks_do_not_reach_are_searched_everywhere(monkeypatch):
    monkeypatch.setattr(D, "MOST", 1)
    items = sized([12] * 40 + [60] * 10, 3)
    index = D.Index([t.encode() for t in items])
    assert len(index.reps) == 1 and len(index.everywhere) == 50
    assert missed(items, range(50), 200, 6) == 0
    edge = [" ".join(items[40].split()[12:]), "x " + " ".join(items[40].split()[:48]), items[3] + " " + items[4]]
    assert [[(h[0], h[1], h[3]) for h in f] for f in index.search([t.encode() for t in edge])] == [[(40, 0, 12)], [(40, 1, 12)], [(3, 0, 0), (4, 12, 0)]]
