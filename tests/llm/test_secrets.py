import hashlib
import random
import re

from tests.llm.conftest import ODD
from voltrail.llm import secret_scan as S

PARTS = ["password", "ToKen", "api_key", "apiKey", "=", ":", " ", "'", '"', "abcdefgh12", "AKIA", "ABCDEFGHIJKL99", "deadbeef" * 4, "é", "中", "ſecret", "Key", "x", "\n", "ghp_" + "a" * 36, "-----BEGIN RSA PRIVATE KEY-----", "sk_live_abcdefghijklmnop", "eyJabcdefghijk.eyJabcdefghijk.abcdefgh1"]


def brute(text, rules):
    found = [(m.start(), o, m.end()) for o, r in enumerate(rules) for m in re.finditer(r.pattern, text, re.ASCII) if len(m[r.group]) >= r.shortest]
    return [(rules[o].kind, s, e) for s, o, e in sorted(found)]


def texts(n=3000):
    r = random.Random(3)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, 12))) for _ in range(n)]


def test_scan_equals_matching_every_rule_on_every_text():
    some = texts()
    assert S.Scanner(S.RULES).scan([t.encode() for t in some]) == [brute(t, S.RULES) for t in some]


def test_queries_hold_for_every_match():
    assert S.trigram_query("abc") == ("and", b"abc")
    assert S.trigram_query("[0-9a-f]+") is S.ANY and S.trigram_query("ab") is S.ANY
    assert S.trigrams(S.trigram_query(r"AKIA[A-Z0-9]+")) == {b"aki", b"kia"}
    scanner = S.Scanner(S.RULES)
    for t in texts(500):
        index = scanner.postings([t.encode()])
        for rule, pattern, query in scanner.rules:
            if pattern.search(t):
                assert 0 in scanner.candidates(query, index, range(1)), (rule.kind, t)


def test_letters_fold_in_ascii_only():
    scan = S.Scanner(S.BASE).scan
    assert scan(["ſecret=abcdefgh".encode(), "PASSWD = abcdefgh".encode(), "toKen=abcdefgh".encode()]) == [[], [("assign", 0, 17)], []]


def test_digests(spark, docs_of):
    rows = [*ODD, *((100 + i, t) for i, t in enumerate(texts(300)))]
    got = sorted((tuple(r) for r in S.digests(docs_of(rows, True)).collect()), key=str)
    want = []
    for i, t in rows:
        found = brute(t or "", S.RULES)
        base = [f for f in found if f[0] in ("assign", "access", "hex")]
        say = lambda x: ",".join(f"{k}:{s}:{e}" for k, s, e in x)
        want.append((i, *(sum(f[0] == k for f in base) for k in ("assign", "access", "hex")), hashlib.sha256(say(base).encode()).hexdigest(), say(found)))
    assert got == sorted(want, key=str)
    assert S.digests(docs_of([])).count() == 0


def test_redaction_masks_spans_and_keeps_the_rest(spark, docs_of):
    rows = [(1, "a password=abcdefgh12 b"), (2, None), (3, "nothing"), (4, "é token: " + "deadbeef" * 4 + " z AKIAABCDEFGHIJKL99")]
    df = docs_of(rows, True)
    out = S.redact_documents(df)
    assert out.columns == df.columns
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    assert got == {1: ("a [secret] b", 12), 2: (None, None), 3: ("nothing", 7), 4: ("é [secret] z [secret]", 21)}


def test_a_private_key_is_masked_whole(spark, docs_of):
    body = "\n".join("Ab3/" * 16 for _ in range(5)) + "\nshortEnd="
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    headers = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00FF\n"
    flat = body.replace("\n", "\\n")
    texts = [f"a {begin}\n{body}\n{end} b", f"a {begin}\n{headers}\n{body}\n{end}\nb", f"a {begin}\n{body}\nthen some words", f"a {begin}\n{headers}\n{body}",
             f'a "{begin}\\n{flat}\\n{end}" b', f'a "{begin}\\n{flat}" b', f"the line {begin} alone\nand words", f"{begin} and {begin}\n{body}\n{end}", f"{begin}\r\n" + body.replace("\n", "\r\n") + f"\r\n{end}"]
    want = ["a [secret] b", "a [secret]\nb", "a [secret]\nthen some words", "a [secret]", 'a "[secret]" b', 'a "[secret]" b', "the line [secret] alone\nand words", "[secret] and [secret]", "[secret]"]
    out = {r["doc_id"]: r["text"] for r in S.redact_documents(docs_of(list(enumerate(texts)))).collect()}
    assert [out[i] for i in range(len(texts))] == want


def test_many_unended_keys_take_linear_time():
    import time
    t0 = time.time()
    found = S.Scanner(S.RULES).scan([b"-----BEGIN PRIVATE KEY-----\n" * 20_000, b"-----BEGIN PRIVATE KEY-----\n" + b"a b - " * 200_000, b"-----BEGIN PRIVATE KEY-----" + b"\n" * 200_000 + b"A" * 100_000])
    assert [len(f) for f in found] == [20_000, 1, 1] and time.time() - t0 < 20
