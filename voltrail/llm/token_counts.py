"""Exact token counts of every prefix of a text, for a SentencePiece BPE model.

Dynamic programming over prefixes: the encoding of a prefix that ends at ``i`` is the encoding of
a shorter prefix ending at ``j`` plus one token ``text[j:i]``, and it is that token exactly if the
last token at ``j`` and the new one stay apart when their concatenation is encoded.  So each
prefix stores its last token and its count, and no prefix is encoded again.  A sequence of such
pairs is the encoding, as the merges of a neighbouring pair depend on nothing else.

White space starts a token and never stands inside one, so a text falls into words whose prefix
counts add up; each different word of a batch is done once, and all of them side by side, a
character a round.  Truncation ("how much of the text fits in N tokens") and budgets read the
stored counts.

Null or empty text: 0 tokens, nothing over any limit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltrail.llm import words
from voltrail.llm.words import Table

SPACE = "▁"
LONG = 48  # characters of a word beyond which it is done on its own
UNKNOWN = -1  # the last token of a prefix that ends with a character without a token
WIDER, UTF8 = np.array([0x80, 0x800, 0x10000]), np.array([1, 2, 3, 4])
WORDS = re.compile(f"{SPACE}+[^{SPACE}]*").findall


class PrefixCounts:
    """Token counts of the prefixes of texts."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2
        spec = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        norm = spec.normalizer_spec
        if spec.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not spec.trainer_spec.byte_fallback:
            raise ValueError("only BPE models with byte fallback and no normalisation are counted")
        self.score = {p.piece: p.score for p in spec.pieces if p.type == 1}
        runs = [p for p in self.score if SPACE * 2 in p]
        if any(p.strip(SPACE) for p in runs) or any(SPACE in p[1:] for p in self.score if SPACE * 2 not in p):
            raise ValueError("a token holds white space after another character")
        floor = min((s for p, s in self.score.items() if len(p) > 1 and SPACE * 2 not in p), default=0.0)
        if any(self.score[p] >= floor for p in runs) or len({self.score[p] for p in runs}) > 1:
            raise ValueError("tokens of several spaces must be merged last, and alike")
        self.run_sizes = {len(p) for p in runs}
        if any(c not in self.score for piece in self.score for c in piece):
            raise ValueError("every character of a token must be a token")
        #: Tokens that texts are ever encoded to.
        self.tokens = [t for t in self.score if len(t) == 1 or self.merge(t) == [t]]
        self.number = {t: i for i, t in enumerate(self.tokens)}
        # Tokens read from the last character to the first: (node, character) -> node, and the token that ends at a node.
        step, token_at = {}, [-1]
        for i, token in enumerate(self.tokens):
            node = 0
            for c in reversed(token):
                node = step.setdefault(node << 21 | ord(c), len(token_at))
                if node == len(token_at):
                    token_at.append(-1)
            token_at[node] = i
        self.step = step
        self.steps = Table(np.array(list(step), dtype=np.uint64), np.array(list(step.values())))
        self.token_at = np.array(token_at)
        self.apart: dict[int, int] = {}  # (token, token) -> whether the two stay apart
        self.known = Table(np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64))
        self.n_known = 0
        self.run_state, self.run_count = [], [0]

    def merge(self, text: str) -> list[str]:
        """Best score first, leftmost first among equals."""
        parts, score = list(text), self.score.get
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def stays_apart(self, a: int, b: int) -> int:
        pair = a << 20 | b
        known = self.apart.get(pair)
        if known is None:
            x, y = self.tokens[a], self.tokens[b]
            known = self.apart[pair] = int(self.merge(x + y) == [x, y])
        return known

    def pairs_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pair = a.astype(np.uint64) << np.uint64(20) | b.astype(np.uint64)
        out = self.known.get(pair)
        left = np.flatnonzero(out < 0)
        if len(left):
            new, of = np.unique(pair[left], return_inverse=True)
            out[left] = np.array([self.stays_apart(p >> 20, p & 0xFFFFF) for p in new.tolist()])[of]
            if len(self.apart) > 1.25 * self.n_known + 1024:
                self.n_known = len(self.apart)
                self.known = Table(np.array(list(self.apart), dtype=np.uint64), np.array(list(self.apart.values())))
        return out == 1

    def word_prefixes(self, chars: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Counts of every prefix of many words (code points, each with the space before it), side by side; as long as ``chars``."""
        counts, lasts = np.zeros(len(chars), dtype=np.int32), np.full(len(chars), UNKNOWN, dtype=np.int64)
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        for i in range(int(sizes[0]) if len(sizes) else 0):
            at = starts[:np.searchsorted(-sizes, -i, side="left")] + i
            node = np.zeros(len(at), dtype=np.int64)
            for back in range(i + 1):
                if not len(at):
                    break
                node = self.steps.get(node.astype(np.uint64) << np.uint64(21) | chars[at - back].astype(np.uint64))
                there = node >= 0
                if not back:  # a character without a token: its bytes
                    odd = at[~there]
                    counts[odd] = (counts[odd - 1] if i else 0) + UTF8[np.searchsorted(WIDER, chars[odd], side="right")]
                at, node = at[there], node[there]
                token = self.token_at[node]
                ends = np.flatnonzero(token >= 0)
                if i > back:
                    before = lasts[at[ends] - back - 1]
                    known = np.flatnonzero(before != UNKNOWN)
                    ok = np.ones(len(ends), dtype=bool)
                    ok[known] = self.pairs_apart(before[known], token[ends][known])
                    ends = ends[ok]
                counts[at[ends]] = 1 + (counts[at[ends] - back - 1] if i > back else 0)
                lasts[at[ends]] = token[ends]
                going = np.ones(len(at), dtype=bool)
                going[ends] = False
                at, node = at[going], node[going]
        return counts

    def prefixes(self, text: str) -> list[tuple[int, str]]:
        """(count, last token) of every prefix of a space and one word of any length."""
        here: list[tuple[int, str]] = [(0, "")]
        for i, c in enumerate(text):
            node, j, options = 0, i, []
            while j >= 0 and (node := self.step.get(node << 21 | ord(text[j]), 0)):
                if self.token_at[node] >= 0:
                    options.append((j, int(self.token_at[node])))
                j -= 1
            if not options:
                here.append((here[i][0] + len(c.encode()), c))
                continue
            for j, token in reversed(options):
                before = self.number.get(here[j][1], -1)
                if not j or before < 0 or self.stays_apart(before, token):
                    break
            here.append((here[j][0] + 1, self.tokens[token]))
        return here[1:]

    def run(self, n: int) -> int:
        """Tokens of ``n`` spaces: the leftmost pair that makes a token is merged, again and again."""
        state, sizes = self.run_state, self.run_sizes
        while len(self.run_count) <= n:
            state.append(1)
            at = max(0, len(state) - 4)
            while at < len(state) - 1:
                if state[at] + state[at + 1] in sizes:
                    state[at:at + 2] = [state[at] + state[at + 1]]
                    at = max(0, at - 2)
                else:
                    at += 1
            self.run_count.append(len(state))
        return self.run_count[n]

    def after_spaces(self, fragment: str) -> list[int]:
        """Counts of every prefix of several spaces and a word: the last space may belong to the word."""
        word = fragment.lstrip(SPACE)
        n = len(fragment) - len(word)
        out, heads = [self.run(i) for i in range(1, n + 1)], [""]
        for i, (count, token) in enumerate(self.prefixes(SPACE + word), 1):
            heads.append(heads[i - len(token)] or token)
            if i > 1:
                out.append(self.run(n) + count - 1 if heads[i] == SPACE else self.run(n - 1) + count)
        return out

    def of_word(self, fragment: str) -> list[int]:
        return self.after_spaces(fragment) if fragment.startswith(SPACE * 2) else [c for c, _ in self.prefixes(fragment)]

    def count_all(self, texts: list[str], limit: int) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of each text, characters of its longest prefix of at most ``limit`` tokens); each different word is done once."""
        total, fits = np.zeros(len(texts), dtype=np.int64), np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        plain = np.flatnonzero(fits)
        chars = np.frombuffer("".join(" " + texts[i] for i in plain).encode("utf-32-le"), dtype=np.uint32).copy()
        chars[chars == 32] = ord(SPACE)
        text_at = np.cumsum(fits[plain] + 1) - fits[plain] - 1
        space = chars == ord(SPACE)
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins[text_at] = True
        starts = np.flatnonzero(begins)
        if not len(starts):
            return total, fits
        ends = np.concatenate((starts[1:], [len(chars)]))
        _, one, of = np.unique(words.stretch_hash(words.mix(chars.astype(np.uint64)), starts, ends), return_index=True, return_inverse=True)
        s, size = starts[one], (ends - starts)[one]
        several = (size > 1) & space[np.minimum(s + 1, len(chars) - 1)]
        short = (size <= LONG) & ~several
        counts = self.word_prefixes(chars, s[short], size[short])
        for a, n in zip(s[~short].tolist(), size[~short].tolist()):
            counts[a:a + n] = self.of_word(chars[a:a + n].tobytes().decode("utf-32-le"))
        tokens = counts[s + size - 1].astype(np.int64)[of]
        first = np.searchsorted(starts, text_at)
        total[plain] = np.add.reduceat(tokens, first)
        for k in np.flatnonzero(total[plain] > limit).tolist():
            before = np.cumsum(tokens[first[k]:first[k + 1] if k + 1 < len(first) else None])
            w = int(np.searchsorted(before, limit, side="left"))  # the word in which the limit is reached
            base = int(before[w - 1]) if w else 0
            u = of[first[k] + w]
            inside = np.flatnonzero(base + counts[s[u]:s[u] + size[u]] <= limit)
            there = starts[first[k] + w] - text_at[k] + (inside[-1] + 1 if len(inside) else 0) - 1
            fits[plain[k]] = max(0, there)
        return total, fits

    def every_prefix(self, text: str) -> np.ndarray:
        """Token counts of ``text[:0]``, ``text[:1]``, .. ``text``."""
        if not text:
            return np.zeros(1, dtype=np.int32)
        found, total = [], 0
        for f in WORDS(SPACE + text.replace(" ", SPACE)):
            found.append(np.array(self.of_word(f), dtype=np.int32) + total)
            total = int(found[-1][-1])
        out = np.concatenate(found)
        out[0] = 0  # the space that the model puts before a text isn't part of it
        return out


@lru_cache(maxsize=2)
def load(path: str) -> PrefixCounts:
    return PrefixCounts(path)


def prefix_counts(text: Column, path: str) -> Column:
    """``array<int>``: element ``i`` is the token count of the first ``i`` characters."""

    @F.arrow_udf("array<int>")
    def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = load(path)
        for column in batches:
            yield pa.array([table.every_prefix(t or "") for t in column.to_pylist()], pa.list_(pa.int32()))

    return counts(text)


def longest_within(counts: Column, budget: int) -> Column:
    """Characters of the longest prefix of at most ``budget`` tokens, from stored ``prefix_counts``."""
    return F.array_max(F.filter(F.sequence(F.lit(0), F.size(counts) - 1), lambda i: F.get(counts, i) <= budget))


def token_counts(text: Column, path: str, limit: int) -> Column:
    """struct(n_tokens, over_limit, fitting_chars): the last prefix's count, and how many characters fit in ``limit`` tokens."""

    @F.arrow_udf("struct<n_tokens:bigint,over_limit:boolean,fitting_chars:bigint>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = load(path)
        for column in batches:
            for _, texts in words.parts([pa.RecordBatch.from_arrays([column], ["t"])], "t"):
                n, fits = table.count_all([t.decode() for t in texts], limit)
                yield pa.StructArray.from_arrays([pa.array(n), pa.array(n > limit), pa.array(fits)], ["n_tokens", "over_limit", "fitting_chars"])

    return count(text)


def count_documents(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and fitting_chars of every whole text."""
    found = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), token_counts(F.col("text"), path, limit).alias("found"))
    return found.select("doc_id", "n_bytes", "found.*")
