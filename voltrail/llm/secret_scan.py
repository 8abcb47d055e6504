"""Secret scans over a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived: the trigrams that
any matching text must hold.  The texts of a segment (an Arrow batch) are indexed by the trigrams
that some query names, postings are intersected and united as the query says, and only the texts
that are left are matched.  A rule without mandatory trigrams scans every text.  The index folds
ASCII case, so a query holds for either case.

A span is (kind, start, end) in code points, end exclusive.  Matches of a rule are leftmost and
don't overlap; those that are too short are dropped after matching.  Null or empty text: no spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from re import _constants as C
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltrail.llm import words

ANY = True  # the query that every text satisfies
WIDEST = 48  # alternatives kept apart while a query is derived


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    shortest: int = 1  # characters of ``group``; shorter matches are dropped
    group: int = 0


BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]+", 32),
)
#: A key reaches to its END line or, where that is missing, through its headers and lines of base64; the last may be short.
#: Lines may also be parted by spaces or written-out line ends.
_GAP = r"(?:\s|\\[rn])+"
_LINE = _GAP + r"""[A-Za-z0-9+/]{40,}={0,2}(?=[\s\\"'`,]|\Z)"""
_BODY = rf"""(?:{_GAP}(?:Proc-Type|DEK-Info):[^\r\n]*)*(?:{_LINE})+(?:(?:[\r\n]|\\[rn])+[A-Za-z0-9+/]+={{0,2}}(?=\s*[\r\n\\"'`,]|\s*\Z))?"""
RULES = (
    *BASE,
    Rule("private_key", rf"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?:[^-]|-(?!----))*+-----END [A-Z ]*PRIVATE KEY-----|{_BODY})?"),
    Rule("code_host", r"gh[opsu]_[A-Za-z0-9]{36}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("payment", r"[rs]k_live_[A-Za-z0-9]{16,}"),
)
SPANS = "array<struct<kind:string,start:int,end:int>>"


def both(a, b):
    return b if a is ANY else a if b is ANY else ("and", a, b)


def of_strings(strings: set[str]):
    """Texts that hold one of the strings: or over and of trigrams."""
    out = None
    for s in sorted(strings):
        raw = s.encode().lower()
        if len(raw) < 3:
            return ANY
        one = ("and", *sorted({raw[i:i + 3] for i in range(len(raw) - 2)}))
        out = one if out is None else ("or", out, one)
    return out


def derive(items) -> tuple[set[str] | None, object]:
    """(the exact strings that a parsed expression matches, or None if they are many; its query)."""
    now, query = {""}, ANY  # strings that end the part read so far; exact until a flush
    exact = True

    def flush() -> None:
        nonlocal now, query, exact
        query, now, exact = both(query, of_strings(now)), {""}, False

    for op, arg in items:
        found, inner = None, ANY
        if op is C.LITERAL:
            found = {chr(arg)}
        elif op is C.IN:
            chars = [chr(c) for kind, v in arg if kind in (C.LITERAL, C.RANGE) for c in ([v] if kind is C.LITERAL else range(v[0], min(v[1], v[0] + WIDEST) + 1))]
            if len(chars) <= 8 and all(kind in (C.LITERAL, C.RANGE) for kind, _ in arg):
                found = set(chars)
        elif op is C.SUBPATTERN:
            found, inner = derive(arg[3])
        elif op is C.BRANCH:
            branches = [derive(b) for b in arg[1]]
            if all(b[0] is not None for b in branches):
                found = set().union(*(b[0] for b in branches))
            else:
                inner = None
                for strings, q in branches:
                    q = both(q, of_strings(strings)) if strings is not None else q
                    inner = q if inner is None else ANY if ANY in (q, inner) else ("or", inner, q)
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT):
            least, most, body = arg
            strings, q = derive(body)
            if strings is not None and (least, most) == (0, 1):
                found = strings | {""}
            elif strings is not None and least == most and len(strings) ** least <= WIDEST:
                found = {""}
                for _ in range(least):
                    found = {a + b for a in found for b in strings}
            elif least:
                inner = q if strings is None else of_strings(strings)
        elif op is C.AT:
            found = {""}
        if found is not None and len(now) * len(found) <= WIDEST:
            now = {a + b for a in now for b in found}
            continue
        flush()
        if found is not None and len(found) <= WIDEST:
            now = set(found)
        else:
            query = both(query, inner)
    if exact:
        return now, ANY
    return None, both(query, of_strings(now))


def trigram_query(pattern: str):
    """Boolean query over lower-case trigrams: bytes, ("and", ...), ("or", ...), or ANY."""
    strings, query = derive(parser.parse(pattern))
    return of_strings(strings) if strings is not None else query


def trigrams(query) -> set[bytes]:
    return set() if query is ANY else {query} if isinstance(query, bytes) else set().union(*map(trigrams, query[1:]))


class Scanner:
    def __init__(self, rules: Sequence[Rule]):
        self.rules = [(r, compiled(r), trigram_query(r.pattern)) for r in rules]
        self.names = sorted(set().union(*(trigrams(q) for _, _, q in self.rules)))
        self.table = np.zeros(1 << 24, dtype=np.uint8 if len(self.names) < 256 else np.uint16)
        for i, t in enumerate(self.names, 1):
            self.table[t[0] << 16 | t[1] << 8 | t[2]] = i
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32

    def postings(self, texts: list[bytes]) -> dict[bytes, set[int]]:
        """Trigram -> the texts that hold it, of the trigrams that queries name."""
        data = self.lower[np.frombuffer(b"\0".join(texts), dtype=np.uint8)]
        if not self.names or len(data) < 3:
            return {}
        code = data[:-2].astype(np.int32)
        for more in (data[1:-1], data[2:]):
            code <<= 8
            code |= more
        found = self.table[code]
        at = np.flatnonzero(found)
        ends = np.cumsum([len(t) + 1 for t in texts])
        pairs = np.unique(found[at].astype(np.int64) * len(texts) + np.searchsorted(ends, at, side="right"))
        which, text = np.divmod(pairs, len(texts))
        cut = np.searchsorted(which, np.arange(1, len(self.names) + 2))
        return {t: set(text[cut[i]:cut[i + 1]].tolist()) for i, t in enumerate(self.names)}

    def candidates(self, query, index: dict[bytes, set[int]], everything: range) -> set[int] | range:
        if query is ANY:
            return everything
        if isinstance(query, bytes):
            return index.get(query, set())
        parts = [self.candidates(q, index, everything) for q in query[1:]]
        return set.intersection(*parts) if query[0] == "and" else set.union(*parts)

    def scan(self, texts: list[bytes]) -> list[list[tuple[str, int, int]]]:
        """Spans (kind, start, end) of each text, by start and then by the order of the rules."""
        index, found = self.postings(texts), [[] for _ in texts]
        for order, (rule, pattern, query) in enumerate(self.rules):
            for i in self.candidates(query, index, range(len(texts))):
                if texts[i]:
                    found[i] += [(m.start(), order, m.end()) for m in pattern.finditer(texts[i].decode()) if m.end(rule.group) - m.start(rule.group) >= rule.shortest]
        return [[(self.rules[o][0].kind, s, e) for s, o, e in sorted(f)] for f in found]


def compiled(rule: Rule) -> re.Pattern:
    """A rule that is ``[class]+`` with a least length is matched as ``[class]{length,}``: the same maximal runs, found faster."""
    one = re.fullmatch(r"(\[[^\]\\]+\])\+", rule.pattern)
    return re.compile(f"{one[1]}{{{rule.shortest},}}" if one else rule.pattern, re.ASCII)


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


def secret_spans(text: Column, rules: Sequence[Rule] = RULES) -> Column:
    """All spans of each text, by start and then by the order of the rules."""
    rules = tuple(rules)

    @F.arrow_udf(SPANS)
    def spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scan = scanner(rules).scan
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for column in batches:
            out = []
            for _, texts in words.parts([pa.RecordBatch.from_arrays([column], ["t"])], "t"):
                out += [[{"kind": k, "start": s, "end": e} for k, s, e in found] for found in scan(texts)]
            yield pa.array(out, kind)

    return spans(text)


def spelled(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_documents(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """doc_id and ``found``, the spans of every whole text."""
    return docs.select("doc_id", secret_spans(F.col("text"), rules).alias("found"))


def digests(docs: DataFrame) -> DataFrame:
    found = scan_documents(docs)
    base = F.filter("found", lambda s: s["kind"].isin([r.kind for r in BASE]))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    return found.select("doc_id", *(count(r.kind).alias(f"n_{r.kind}") for r in BASE), F.sha2(spelled(base), 256).alias("base_sha256"), spelled(F.col("found")).alias("spans"))


def mask_spans(text: str, found: Sequence[tuple[str, int, int]], mask: str) -> str:
    """``text`` with each maximal stretch that spans (in order) cover replaced by ``mask``."""
    parts, end = [], 0
    for _, a, b in found:
        if a >= end:
            parts += [text[end:a], mask]
        end = max(end, b)
    return "".join([*parts, text[end:]])


def masked(text: Column, rules: Sequence[Rule], mask: str) -> Column:
    """struct(text, n): each text with its secrets masked (null stays null), and how many spans it had."""
    rules = tuple(rules)

    @F.arrow_udf("struct<text:string,n:int>")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scan = scanner(rules).scan
        for column in batches:
            for part, texts in words.parts([pa.RecordBatch.from_arrays([column], ["t"])], "t"):
                found = scan(texts)
                out = [None if t is None else mask_spans(t, f, mask) if f else t for t, f in zip(part.column(0).to_pylist(), found)]
                yield pa.StructArray.from_arrays([pa.array(out, pa.string()), pa.array([len(f) for f in found], pa.int32())], ["text", "n"])

    return clean(text)


def redact_documents(docs: DataFrame, rules: Sequence[Rule] = RULES, mask: str = "[secret]") -> DataFrame:
    """The same rows and columns with secrets masked in ``text``, and ``n_chars`` (if any) counted anew where a text changed."""
    kept = docs.columns
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"))
    row = row.select("row", masked(F.col("row.text"), rules, mask).alias("clean"))
    new = {"text": F.col("clean.text")}
    if "n_chars" in kept:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(F.col("clean.n") > 0, F.char_length("clean.text").cast(kind)).otherwise(F.col("row.n_chars"))
    return row.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in kept))
