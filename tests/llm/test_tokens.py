import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tests.llm.conftest import ODD
from voltrail.llm import bpe, token_counts

BYTE = public_tokenizers.path("byte_bpe_50k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def given():
    import duckdb
    return [r[0] or "" for r in duckdb.sql("select text from '/root/testdata/sf0.01/documents.parquet'").fetchall()]


def random_texts(alphabet, n, most=30, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice(alphabet) for _ in range(r.randint(0, most))) for _ in range(n)]


def test_bpe_ids_equal_the_library(given):
    library, mine = Tokenizer.from_file(BYTE), bpe.load(BYTE)
    odd = random_texts([*" \n\t  ab'sTé中😀  \x1c\x85 1²٣_-\r\x0b", "<|endoftext|>"], 4000)
    odd += random_texts([*"the and ing\n\t,.", "  "], 2000) + ["a" * 5000 + "ab" * 3000, "", " ", "x" + " " * 60 + "y" * 100]
    some = given + odd
    ids, n = mine.encode_all([t.encode() for t in some])
    ends = np.cumsum(n)
    for t, a, b in zip(some, ends - n, ends):
        want = library.encode(t, add_special_tokens=False).ids
        assert ids[a:b].tolist() == want, t[:80]
        assert b"".join(map(bpe.tokens(BYTE).__getitem__, want)).decode("utf-8", errors="replace") == library.decode(want, skip_special_tokens=False)


def test_fragments_between_forced_cuts_are_independent():
    mine = bpe.load(BYTE)
    for t in random_texts([*"abcdeé中😀%#,.;"], 500, seed=4):
        whole = mine.encode_piece(t.encode())
        raw = t.encode()
        cuts = [0, *(i for i in range(1, len(raw)) if not mine.inside[raw[i - 1], raw[i]]), len(raw)]
        parts = [i for a, b in zip(cuts, cuts[1:]) for i in mine.encode_piece(raw[a:b])]
        assert whole == parts


def test_bpe_digests(spark, docs_of):
    rows = [*ODD, (20, "a<|endoftext|>b")]
    library = Tokenizer.from_file(BYTE)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    got = [tuple(r) for r in bpe.digests(docs_of(rows, True), BYTE).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert bpe.digests(docs_of([]), BYTE).count() == 0
    back = bpe.encode_documents(docs_of(rows, True), BYTE).select("doc_id", "text", bpe.token_text(F.col("token_ids"), BYTE).alias("back"))
    assert all(r["back"] == (r["text"] or "") for r in back.collect())


def test_prefix_counts_equal_the_library_at_every_prefix(given):
    library, table = SentencePieceProcessor(model_file=PIECE), token_counts.load(PIECE)
    some = random_texts(["a", "th", "  ", " ", "é", "中", "😀", "\n", "\t", "▁", "<s>", "0", "ing", " the", "the", "́", "Q"], 400, 14) + [t[:150] for t in given[:20]]
    for t in some:
        assert table.every_prefix(t).tolist() == [len(library.encode(t[:i])) for i in range(len(t) + 1)], t
    assert [table.run(n) for n in range(1, 120)] == [len(library.encode("a" + " " * n)) - 1 for n in range(1, 120)]


def test_counts_and_truncation(given):
    library, table = SentencePieceProcessor(model_file=PIECE), token_counts.load(PIECE)
    some = [*given, "", "x" * 5000, "  two", "end ", "y" * 100 + " z"]
    for limit in (4, 300):
        n, fits = table.count_all(some, limit)
        assert n.tolist() == [len(x) for x in library.encode(some)]
        for i in [*range(0, len(given), 60), *range(len(given), len(some))]:
            assert fits[i] == np.flatnonzero(table.every_prefix(some[i]) <= limit)[-1]


def test_count_documents(spark, docs_of):
    library = SentencePieceProcessor(model_file=PIECE)
    got = [tuple(r)[:4] for r in token_counts.count_documents(docs_of(ODD, True), PIECE, limit=100).collect()]
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "")), n > 100) for i, t in ODD]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert token_counts.count_documents(docs_of([]), PIECE).count() == 0


def test_stored_prefixes_answer_budgets(spark, docs_of):
    df = docs_of([(1, "the quick brown fox"), (2, ""), (3, None)])
    rows = df.select("doc_id", token_counts.prefix_counts(F.col("text"), PIECE).alias("c")).select("doc_id", token_counts.longest_within(F.col("c"), 2).alias("n")).collect()
    library = SentencePieceProcessor(model_file=PIECE)
    t = "the quick brown fox"
    assert {r["doc_id"]: r["n"] for r in rows} == {1: max(i for i in range(len(t) + 1) if len(library.encode(t[:i])) <= 2), 2: 0, 3: 0}
