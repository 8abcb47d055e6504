import re

from tests.llm.conftest import ODD
from voltrail.llm import license_scan as L

ROWS = [
    *ODD, (20, "under the MIT license under the mit License, Version"), (21, "cc by nc nc by cc by nc Apache License, Version 2.0"), (22, "under the mit licenseé under the mit"),
    (23, " ".join(["cc by nc"] * 300)), (24, "Permission is hereby granted, free of charge, to any person obtaining a copy of this SOFTWARE and associated documentation stuff"),
    (25, "This work is licensed under the GNU General Public License, version 3."), (26, "general public words of a licence, under the version and software"),
]
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def brute(text):
    w = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    at = [(j, label) for p, label in PHRASES.items() for j in range(len(w)) if w[j:j + len(p.split())] == p.split()]
    starts = [j for j, _ in at]
    return len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))


def test_base_places_equal_brute_force_and_the_method_adds_labels(spark, docs_of):
    got = L.digests(docs_of(ROWS, True)).collect()
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(((i, *brute(t)) for i, t in ROWS), key=str)
    by = {r["doc_id"]: r for r in got}
    assert by[24]["labels"] == "mit" and by[24]["base_labels"] == "" and 0.8 <= by[24]["score"] < 1
    assert by[25]["labels"] == "gpl" and by[26]["labels"] == "" and by[26]["score"] == 0 and by[20]["score"] == 1
    assert all(0 <= r["score"] <= 1 and set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) for r in got)
    assert L.digests(docs_of([])).count() == 0


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["doc_id"]: tuple(r)[1:6] for r in L.digests(docs).collect()}
    assert got == {r["doc_id"]: brute(r["text"]) for r in docs.collect()}


def test_document_counts_are_of_all_documents(spark, docs_of):
    n, counts = L.document_counts(docs_of([(1, "mit MIT x"), (2, "mit apache"), (3, None)]).repartition(3), [b"apache", b"mit", b"none"])
    assert (n, counts) == (3, {b"apache": 1, b"mit": 2, b"none": 0})


def test_a_notice_needs_its_key_phrase():
    idf = {x: 1.0 for x in L.vocabulary(L.TEMPLATES)}
    index = L.Index(L.TEMPLATES, idf)
    text = L.NOTICES[0].text
    assert index.scan([text.encode()])[0]["labels"] == ["mit"]
    assert index.scan([text.replace("free of charge", "free for all").encode()])[0]["labels"] == []


def scan(text):
    return L.Index(L.TEMPLATES, {x: 1.0 for x in L.vocabulary(L.TEMPLATES)}).scan([text.encode()])[0]


def test_a_word_in_or_out_keeps_the_label():
    for t in (*L.NOTICES, *L.TEXTS):
        w, key = t.text.split(), len(t.key.split())
        spoiled = 0
        for i in range(len(w)):
            for changed in (w[:i] + ["whatever"] + w[i:], w[:i] + w[i + 1:], w[:i] + ["whatever"] + w[i + 1:]):
                spoiled += t.label not in scan(" ".join(changed))["labels"]
        # Only words put into the key phrase, or taken out of it, cost the label.
        assert spoiled <= 3 * key + 1, (t.label, spoiled)


def test_wrapped_and_commented_licences():
    import textwrap
    for t in L.TEXTS:
        lines = textwrap.wrap(t.text, 60)
        for text in ("\n".join(f" * {x}" for x in lines), "\n".join(f"rem {x}" for x in lines) if t.label == "mit" else "// " + "\n// ".join(lines)):
            found = scan("int main; the code " * 40 + text + " and so on" * 30)
            if text.startswith("rem"):  # a word a line: in the key phrase it costs the label, elsewhere it doesn't
                found = scan(text.replace("rem ", "", 2))
            assert t.label in found["labels"], t.label
            place = next(p for p in found["places"] if p["label"] == t.label)
            assert place["score"] >= 0.8


def test_notices_repeat_and_stand_side_by_side():
    mit, gpl = L.TEXTS[0].text, next(t.text for t in L.TEXTS if t.label == "gpl")
    found = scan(" ".join([mit, "x y z", mit, gpl, mit]))
    n = len(re.findall("[a-z0-9]+", mit.lower()))
    whole = L.TEMPLATES.index(L.TEXTS[0])
    index = L.Index(L.TEMPLATES, {x: 1.0 for x in L.vocabulary(L.TEMPLATES)})
    w = L.lower_words([" ".join([mit, "x y z", mit, gpl, mit]).encode()])
    which = index.table.get(w.hashes())
    holds = [float((which == i).any()) for i in range(index.names)]
    assert [(s, x) for _, s, x in index.find(whole, which, holds)][:2] == [(0, 1.0), (n + 3, 1.0)] and len(index.find(whole, which, holds)) == 3
    assert {"mit", "gpl"} <= set(found["labels"])


def test_scattered_words_are_no_licence():
    import random
    for t in (*L.NOTICES, *L.TEXTS):
        w = re.findall("[a-z0-9]+", t.text.lower())
        random.Random(5).shuffle(w)
        if len(w) > 20:
            found = scan(t.key + " " + " ".join(w))
            assert t.label not in set(found["labels"]) - set(found["base_labels"]), t.label
    assert scan(L.TEXTS[0].key)["labels"] == []


def test_common_subsequence_against_brute_force():
    import itertools
    import random

    import numpy as np
    r = random.Random(3)
    for _ in range(60):
        s, f = [r.randrange(4) for _ in range(r.randrange(7))], [r.randrange(5) - 1 for _ in range(r.randrange(8))]
        gain = [r.randrange(1, 9) for _ in s]
        best = 0
        for n in range(len(s) + 1):
            for pick in itertools.combinations(range(len(s)), n):
                rest = iter(f)
                if all(s[i] in rest for i in pick):
                    best = max(best, sum(gain[i] for i in pick))
        assert L.common(np.array(s, dtype=int), np.array(gain, dtype=float), np.array(f, dtype=int)) == best
