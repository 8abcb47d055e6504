import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import ODD
from voltrail.llm import quality_rules as Q


def brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen = Counter(tuple(w[j:j + 3]) for j in range(len(w) - 2))
    again = {j + k for j in range(len(w) - 2) if seen[tuple(w[j:j + 3])] > 1 for k in range(3)}
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(again)


ROWS = [*ODD, (20, "a b\na b\n a b\n\n \na b c a b c | # é"), (21, "\xa0\n\xa0\n"), (22, "x y z " * 30 + "q w"), (23, "\n".join(["same line here"] * 5))]


def test_counts_equal_the_definitions(spark, docs_of):
    got = Q.judge(docs_of(ROWS, True), []).collect()
    want = []
    for i, t in ROWS:
        b = brute(t)
        failed = b[0] < 50 or 100 * b[4] > 50 * b[0]
        want.append((i, *b, failed, not failed))
    assert sorted(((r["doc_id"], *(r[c] for c in Q.COUNTS[:5]), r["base_failed"], r["kept"]) for r in got), key=str) == sorted(want, key=str)
    assert Q.judge(docs_of([]), []).count() == 0


def test_given_documents_have_the_defined_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r["doc_id"]: tuple(r[c] for c in Q.COUNTS[:5]) for r in Q.judge(docs, []).collect()}
    assert got == {r["doc_id"]: brute(r["text"]) for r in docs.collect()}


def test_held_out_accuracy(spark):
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet")
    docs, labels = read("documents"), read("labels")
    rules = Q.fit(docs, labels.where("doc_id % 2 = 0"))
    out = Q.judge(docs, rules).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").collect()
    bad = [r["kept"] for r in out if r["quality"] == 0]
    good = [r["kept"] for r in out if r["quality"] == 1]
    assert rules and np.mean(good) > 0.99 and np.mean(bad) < 0.1


def test_rules_are_an_ordered_condition(spark, docs_of):
    rules = [(Q.Condition("symbols_per_word", True, 0.5), Q.Condition("n_words", True, 60.0)), (Q.Condition("repeat_share", True, 0.3),)]
    rows = [(1, " ".join(f"w{i}" for i in range(70))), (2, " ".join(f"w{i}|" for i in range(70))), (3, " ".join(f"w{i}|" for i in range(55))), (4, " ".join(f"w{i}" for i in range(60)) + " a b c" * 10)]
    assert sorted(r["doc_id"] for r in Q.judge(docs_of(rows), rules).where("kept").collect()) == [1, 3]


def test_learning_finds_planted_rules_and_bad_labels_give_none():
    rng = np.random.default_rng(5)
    n = 3000
    rows = {f: rng.random(n) for f in Q.FEATURES}
    bad = (rows["symbols_per_word"] > 0.8) & (rows["repeat_share"] > 0.5) | (rows["word_length"] <= 0.1)
    rules = Q.learn(rows, bad, np.arange(n) % 3 == 0)
    fresh = {f: rng.random(n) for f in Q.FEATURES}
    want = (fresh["symbols_per_word"] > 0.8) & (fresh["repeat_share"] > 0.5) | (fresh["word_length"] <= 0.1)
    got = np.any([Q.covers(r, fresh, n) for r in rules], axis=0)
    assert (got == want).mean() > 0.98
    assert Q.learn(rows, rng.random(n) < 0.5, np.arange(n) % 3 == 0) == []


def test_labels_may_be_absent_null_or_repeated(spark, docs_of):
    df = docs_of([(i, f"word{i} " * 60) for i in range(30)])
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert Q.fit(df, none) == []
    odd = spark.createDataFrame([(1, None, 0), (None, 0, 0), (2, 1, 0), (2, 1, 1)], "doc_id bigint, quality int, toxic int")
    assert Q.fit(df, odd) == []


def test_sample_is_bounded(spark, docs_of):
    df = docs_of([(i, f"w{i} " * 60) for i in range(200)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id bigint, quality int")
    assert Q.labelled(df, labels, 50).count() == 50


@pytest.mark.parametrize("extra", [False, True])
def test_kept_rows_have_all_their_columns(spark, docs_of, extra):
    df = docs_of([*ODD, (30, " ".join(f"w{i}" for i in range(70)))], extra)
    out = Q.keep_good(df, [])
    assert out.columns == df.columns and [r["doc_id"] for r in out.collect()] == [30]


def test_learning_goes_on_after_a_rule_that_fails():
    rng = np.random.default_rng(6)
    n = 6000
    rows = {f: rng.random(n) for f in Q.FEATURES}
    noisy = (rows["word_length"] > 0.8) & (rng.random(n) < 0.7)  # never precise, and the first to be tried
    rare = rows["repeat_share"] < 0.02
    rules = Q.learn(rows, noisy | rare, np.arange(n) % 3 == 0)
    fresh = {f: rng.random(n) for f in Q.FEATURES}
    got = np.any([Q.covers(r, fresh, n) for r in rules], axis=0)
    assert got[fresh["repeat_share"] < 0.015].mean() > 0.9 and got[fresh["repeat_share"] > 0.03].mean() < 0.02


def test_few_labels_are_enough_for_a_clear_kind():
    rng = np.random.default_rng(7)
    rows = {f: rng.random(90) for f in Q.FEATURES}
    bad = np.arange(90) < 12
    rows["symbols_per_word"][bad] += 2
    rules = Q.learn(rows, bad, np.arange(90) % 3 == 0)  # four of the twelve are for pruning
    assert rules and (np.any([Q.covers(r, rows, 90) for r in rules], axis=0) == bad).all()


def test_rows_beyond_the_sample_are_cut_at_random(spark, docs_of, monkeypatch):
    # Each id stands in four rows, two of them long; half of the rows are cut.
    seen = []
    monkeypatch.setattr(Q, "learn", lambda rows, bad, prune: seen.append(rows["n_words"]) or [])
    df = docs_of([(i, f"w{i} x{k} " * size) for i in range(60) for k, size in enumerate((30, 30, 200, 200))])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, quality int")
    Q.fit(df, labels, 120)
    assert len(seen[0]) == 120 and 40 < (seen[0] > 300).sum() < 80
