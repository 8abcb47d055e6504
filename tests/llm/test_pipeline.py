import hashlib
import random
import re

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as P
from tests.llm.test_quality import brute as counts
from tests.llm.test_secrets import brute as secret_spans
from tests.llm.test_simhash import brute_components, brute_print
from voltrail.llm import decontaminate, quality_rules, secret_scan


def masked(text):
    """The text with every maximal covered stretch masked."""
    cover = [None] * (len(text) + 1)
    out, at = [], 0
    end = -1
    for _, s, e in secret_spans(text, secret_scan.RULES):
        if s >= end:
            if end >= 0:
                at = end
            out += [text[at:s], "[secret]"]
        end = max(end, e)
    del cover
    return "".join([*out, text[max(end, 0):] if out else text])


def make(spark, folder):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefghijklm") for _ in range(r.randint(3, 8)))
    items = [" ".join(word() for _ in range(20)) for _ in range(5)]
    rows, labels = [], []
    for i in range(320):
        w = [word() for _ in range(r.randint(60, 140))]
        if i % 8 == 1:
            w = [f"{x} |" for x in w]
        if i % 8 == 2:
            w[10:10] = items[i % 5].split()
        if i % 8 == 3:
            w[5:5] = ["password=abcdefgh12"]
        if i % 8 == 4 and rows:
            w = rows[-1][1].split()
            w[r.randrange(len(w))] = word()
        rows.append((i, " ".join(w), "en", "s", 0))
        labels.append((i, int(i % 8 != 1), 0))
    rows += [(900, None, None, None, None), (901, "", "en", "s", 0), (902, "short text", "en", "s", 10), (903, rows[0][1], "en", "s", 1)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.mode("overwrite").parquet(f"{folder}/benchmark.parquet")
    return rows, items


def test_run_equals_a_brute_force_version(spark, tmp_path):
    rows, items = make(spark, tmp_path)
    rules = quality_rules.fit(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet"))
    assert rules
    kept = []
    for i, t, *_ in rows:
        n, chars, symbols, dup, again = counts(t)
        if n < 50 or 100 * again > 50 * n:
            continue
        c = {k: v[0] for k, v in quality_rules.count([(t or "").encode()]).items()}
        x = {f: [float(c[a])] if b is None else [c[a] / c[b] if c[b] else 0.0] for f, (a, b) in quality_rules.FEATURES.items()}
        if not any(all(x[q.feature][0] > q.threshold if q.above else x[q.feature][0] <= q.threshold for q in rule) for rule in rules):
            kept.append((i, t))
    assert all(i % 8 != 1 or i >= 900 for i, _ in kept)
    roots = brute_components([brute_print(t) for _, t in kept])
    least = {}
    for (i, _), r in zip(kept, roots):
        least[r] = min(least.get(r, i), i)
    kept = [(i, t) for (i, t), r in zip(kept, roots) if least[r] == i]
    kept = [(i, t) for i, t in kept if not any(x in t for x in items)]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in kept:
        ids = library.encode(masked(t), add_special_tokens=False).ids
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted(tuple(r) for r in P.run(spark, str(tmp_path)).collect()) == sorted(want)
    assert any(re.search("password", t) for _, t in kept) and len(want) < len(rows)


def test_stages_keep_the_columns_of_documents(spark, tmp_path):
    make(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").selectExpr("*", "1 as kept", "'x' as row", "2 as hits", "3 as fp")
    for k, (_, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < len(P.STAGES) - 1:
            assert out.schema.names == docs.schema.names
            assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
            assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    assert decontaminate.RATE == 0.2


def test_every_operator_is_registered_once():
    import __spark_entry__ as E
    names = list(E.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names
