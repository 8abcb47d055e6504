"""Byte-level BPE encoding and decoding by forced-boundary splitting.

A pair of bytes that stands next to each other inside no vocabulary token can't be merged by any
rule, so a text may be cut between the two: the fragments are encoded on their own and their ids
concatenated.  The pre-tokenizer forces cuts as well: it always starts a piece where white space
follows another character, and looks at nothing to the left of it, so a whole text is first cut
there.  The pieces of what lies between are cut at every forced byte pair (known from
the vocabulary alone).  Each different word of a batch is encoded once, and all fragments merge
side by side, one merge of each a round; very long fragments go through a heap.

Null text: no tokens.  Empty text: no tokens.  Special tokens written in a text become their ids,
as the library does by default.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltrail.llm import words
from voltrail.llm.words import Table

WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The pre-tokenizer's pieces; white space spelled out, as Python's own class has four characters more.
PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
CUT, NONE, LOW = 1 << 63, 1 << 62, (1 << 32) - 1
LONG = 48  # bytes of a fragment beyond which it is merged on its own
SLICE = 512  # texts decoded at a time
#: UTF-8 of the white space beyond ASCII.
ODD_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2(?:\x80[\x80-\x8a\xa8\xa9\xaf]|\x81\x9f)|\xe3\x80\x80").search
KEPT = 50_000  # words, and pieces, that a task remembers; beyond it starts over


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def vocabulary(spec: dict) -> tuple[dict[str, bytes], dict[str, int], list[bytes]]:
    """(bytes of each token of the model, ids of special tokens, bytes by id)."""
    alphabet = byte_alphabet()
    vocab = spec["model"]["vocab"]
    raw = {t: bytes(map(alphabet.__getitem__, t)) for t in vocab if all(c in alphabet for c in t)}
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    by_id: list[bytes] = [b""] * (max([*vocab.values(), *special.values()]) + 1)
    for t, b in raw.items():
        by_id[vocab[t]] = b
    for t, i in special.items():
        by_id[i] = t.encode()
    return raw, special, by_id


@lru_cache(maxsize=2)
def tokens(path: str) -> list[bytes]:
    with open(path, encoding="utf-8") as f:
        return vocabulary(json.load(f))[2]


class Bpe(dict):
    """Word -> ids of a space and the word, made on first use."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        raw, self.special, self.tokens = vocabulary(spec)
        vocab = spec["model"]["vocab"]
        self.ids = {t: vocab[name] for name, t in raw.items()}
        self.byte_ids = [self.ids.get(bytes([b])) for b in range(256)]
        self.merges: dict[tuple[int, int], int] = {}  # rank in the high bits, merged id in the low
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.merges.setdefault((vocab[a], vocab[b]), rank << 32 | vocab[a + b])
        #: Of byte pairs that stand inside some token; all others are cut.
        self.byte_ranks = {pair: self.merges.get((self.byte_ids[pair[0]], self.byte_ids[pair[1]]), NONE) for t in raw.values() for pair in zip(t, t[1:])}
        self.known: dict[str, list[int]] = {}
        pairs = np.array(list(self.merges), dtype=np.uint64).reshape(-1, 2)
        self.rank_of = Table(pairs[:, 0] << np.uint64(32) | pairs[:, 1], np.array(list(self.merges.values()), dtype=np.int64))
        self.byte_array = np.array([-1 if i is None else i for i in self.byte_ids], dtype=np.int64)
        self.inside = np.zeros((256, 256), dtype=bool)
        for a, b in self.byte_ranks:
            self.inside[a, b] = True
        self.special_bytes = [t.encode() for t in self.special]
        self.pieces = regex.compile(PIECES).findall
        self.blank = regex.compile(rf"[{WHITE}]").match
        self.fragments = regex.compile(rf"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+").findall
        self.cut = regex.compile("|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))) if self.special else None

    def __missing__(self, word: str) -> tuple[int, ...] | None:
        """Ids of a space and ``word``; None where the space isn't the only white space before it."""
        ids = None if not word or self.blank(word) else self.encode_fragment(" " + word)
        if len(word) <= 64:
            if len(self) >= KEPT:
                self.clear()
            self[word] = ids
        return ids

    def encode_fragment(self, fragment: str) -> tuple[int, ...]:
        out: list[int] = []
        known = self.known
        for piece in self.pieces(fragment):
            ids = known.get(piece)
            if ids is None:
                ids = self.encode_piece(piece.encode())
                if len(piece) <= 64:
                    if len(known) >= KEPT:
                        known.clear()
                    known[piece] = ids
            out += ids
        return tuple(out)

    def encode_piece(self, piece: bytes) -> list[int]:
        """Forced cuts first: what lies between them is merged on its own."""
        ids = [*map(self.byte_ids.__getitem__, piece)]
        get = self.byte_ranks.get
        ranks = [get(pair, CUT) for pair in zip(piece, piece[1:])]
        if CUT not in ranks:
            return self.merge(ids, ranks)
        out: list[int] = []
        cuts = [0, *(i for i, r in enumerate(ranks, 1) if r == CUT), len(ids)]
        for a, b in zip(cuts, cuts[1:]):
            out += self.merge(ids[a:b], ranks[a:b - 1])
        return out

    def merge(self, ids: list[int], ranks: list[int]) -> list[int]:
        """Lowest rank first, leftmost first among equals."""
        if len(ids) > LONG:
            return self.merge_long(ids)
        get = self.merges.get
        while ranks and (best := min(ranks)) < NONE:
            i = ranks.index(best)
            ids[i:i + 2] = [best & LOW]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = get((ids[i], ids[i + 1]), NONE)
            if i:
                ranks[i - 1] = get((ids[i - 1], ids[i]), NONE)
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over a linked list, for fragments of any length."""
        n, get = len(ids), self.merges.get
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(m >> 32, i, ids[i], ids[i + 1], m & LOW) for i in range(n - 1) if (m := get((ids[i], ids[i + 1]), NONE)) != NONE]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, to = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = to, -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
                if (m := get((to, ids[after[i]]), NONE)) != NONE:
                    heapq.heappush(heap, (m >> 32, i, to, ids[after[i]], m & LOW))
            if (p := before[i]) >= 0 and (m := get((ids[p], to), NONE)) != NONE:
                heapq.heappush(heap, (m >> 32, p, ids[p], to, m & LOW))
        return [i for i in ids if i >= 0]

    def encode(self, text: str) -> list[int]:
        if self.cut is None or not self.cut.search(text):
            return self.encode_plain(text)
        out: list[int] = []
        at = 0
        for m in self.cut.finditer(text):
            out += self.encode_plain(text[at:m.start()])
            out.append(self.special[m[0]])
            at = m.end()
        return out + self.encode_plain(text[at:])

    def encode_plain(self, text: str) -> list[int]:
        head, space, tail = text.partition(" ")
        if space and head:
            try:
                return [*chain.from_iterable(map(self.encode_fragment, self.fragments(head))), *chain.from_iterable(map(self.__getitem__, tail.split(" ")))]
            except TypeError:  # a run of white space that isn't one space: cut before the run
                pass
        return [*chain.from_iterable(map(self.encode_fragment, self.fragments(text)))]

    def merge_all(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merges every fragment ``ids[start:next start]`` at once, a merge of each a round; (ids, how many each has)."""
        size = np.diff(np.concatenate((starts, [len(ids)])))
        done_of, done_ids = [], []
        for k in np.flatnonzero(size > LONG):
            merged = self.merge_long(ids[starts[k]:starts[k] + size[k]].tolist())
            done_of.append(np.full(len(merged), k))
            done_ids.append(np.array(merged, dtype=np.int64))
        of = np.repeat(np.arange(len(starts)), size)
        live = size[of] <= LONG
        ids, of = ids[live], of[live]

        def ranks(i: np.ndarray) -> np.ndarray:
            """Of the pairs that start at i."""
            j = np.minimum(i + 1, len(ids) - 1)
            found = self.rank_of.get(ids[i].astype(np.uint64) << np.uint64(32) | ids[j].astype(np.uint64))
            return np.where((found >= 0) & (of[i] == of[j]) & (i != j), found, NONE)

        rank = ranks(np.arange(len(ids)))
        while len(ids):
            first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
            best = np.minimum.reduceat(rank, first)
            n = np.diff(np.concatenate((first, [len(ids)])))
            ended = np.repeat(best == NONE, n)
            done_of.append(of[ended])
            done_ids.append(ids[ended])
            at = np.flatnonzero((rank == np.repeat(best, n)) & ~ended)
            at = at[np.concatenate(([True], of[at][1:] != of[at][:-1]))] if len(at) else at  # leftmost
            ids[at] = rank[at] & LOW
            stay = ~ended
            stay[at + 1] = False
            moved = np.cumsum(stay)[at] - 1
            ids, of, rank = ids[stay], of[stay], rank[stay]
            again = np.concatenate((moved, moved[moved > 0] - 1))
            rank[again] = ranks(again)
        of, ids = np.concatenate(done_of), np.concatenate(done_ids)
        order = np.argsort(of, kind="stable")
        return ids[order], np.bincount(of, minlength=len(starts))

    def encode_words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many each word has) of words with the white space before them."""
        bare = ~words.SPACE[data[starts]]  # a text's first word; a line feed before it changes none of its pieces
        size = ends - starts
        flat = np.repeat(np.uint8(10), int((size + bare).sum()))
        at = np.cumsum(size + bare) - size
        flat[words.spread(at, size)] = data[words.spread(starts, size)]
        pieces = self.pieces(flat.tobytes().decode())
        chars = np.flatnonzero((flat & 0xC0) != 0x80)
        n_chars = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        piece_at = chars[np.cumsum(n_chars) - n_chars]
        cut = np.zeros(len(flat), dtype=bool)
        cut[1:] = ~self.inside[flat[:-1], flat[1:]]  # forced: no token holds the two bytes
        cut[piece_at] = True
        starts = np.flatnonzero(cut)
        ids, n = self.merge_all(self.byte_array[flat], starts)
        drop = np.zeros(len(flat), dtype=bool)
        drop[(at - 1)[bare]] = True
        word = np.searchsorted(at - bare, starts, side="right") - 1
        ids = ids[np.repeat(~drop[starts], n)]
        n = np.where(drop[starts], 0, n)
        return ids, np.bincount(word, weights=n, minlength=len(at)).astype(np.int64)

    def odd(self, text: bytes) -> bool:
        """Whether a text is encoded on its own: special tokens, or white space that isn't ASCII."""
        return any(t in text for t in self.special_bytes) or not text.isascii() and ODD_SPACE(text) is not None

    def encode_all(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many each text has); each different word is encoded once."""
        odd = np.array([self.odd(t) for t in texts], dtype=bool)
        plain = [b"" if o else t for t, o in zip(texts, odd)]
        data = np.frombuffer(b"".join(plain), dtype=np.uint8)
        end = np.cumsum([len(t) for t in plain])
        first = end - [len(t) for t in plain]
        blank = words.SPACE[data]
        cut = np.zeros(len(data) + 1, dtype=bool)
        cut[1:len(data)] = blank[1:] & ~blank[:-1]
        cut[first[first < end]] = True
        starts = np.flatnonzero(cut)
        ends = np.concatenate((starts[1:], [len(data)])) if len(starts) else starts
        out, n = np.empty(0, dtype=np.int32), np.zeros(len(texts), dtype=np.int64)
        if len(starts):
            _, one, of = np.unique(words.stretch_hash(words.BYTE[data], starts, ends), return_index=True, return_inverse=True)
            s, e = starts[one], ends[one]
            dark = ~blank[e - 1]  # else the end of a text, white space only
            ids, count = self.encode_words(data, s[dark], e[dark])
            size = np.zeros(len(one), dtype=np.int64)
            size[dark] = count
            at = np.cumsum(size) - size
            more = [self.encode_fragment(data[a:b].tobytes().decode()) for a, b in zip(s[~dark], e[~dark])]
            size[~dark] = [len(m) for m in more]
            at[~dark] = len(ids) + np.cumsum(size[~dark]) - size[~dark]
            ids = np.concatenate((ids, np.array([i for m in more for i in m], dtype=np.int64)))
            out = ids[words.spread(at[of], size[of])].astype(np.int32)
            n = np.add.reduceat(np.concatenate((size[of], [0])), np.searchsorted(starts, first))
            n[first == end] = 0
        if odd.any():
            ends = np.cumsum(n)
            found = [np.array(self.encode(texts[i].decode()), dtype=np.int32) if odd[i] else out[ends[i] - n[i]:ends[i]] for i in range(len(texts))]
            out, n = np.concatenate(found), np.array([len(f) for f in found])
        return out, n

@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)


def lists(ids: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))


def decoded(token, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The text of each stretch of ids; ``token`` gives an id's bytes."""
    return pa.array([b"".join(map(token, ids[a:b].tolist())).decode("utf-8", errors="replace") for a, b in zip(ends.tolist(), ends[1:].tolist())], pa.string())


def token_ids(text: Column, path: str) -> Column:
    """``array<int>`` of the ids of each text; null text: empty."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = load(path)
        for batch in batches:
            for _, texts in words.parts([pa.RecordBatch.from_arrays([batch], ["t"])], "t"):
                ids, n = bpe.encode_all(texts)
                yield lists(ids, np.concatenate(([0], np.cumsum(n))))

    return encode(text)


def token_text(ids: Column, path: str) -> Column:
    """The text that ids stand for, special tokens included; null: empty."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        token = tokens(path).__getitem__
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                column = batch.slice(at, SLICE)
                yield decoded(token, column.values.to_numpy(), column.offsets.to_numpy())

    return decode(ids)


def round_trip(text: Column, path: str) -> Column:
    """struct(ids, text): what each text is encoded to, and what those ids are decoded to, in one pass through Python."""

    @F.arrow_udf("struct<ids:array<int>,text:string>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe, token = load(path), tokens(path).__getitem__
        for batch in batches:
            for _, texts in words.parts([pa.RecordBatch.from_arrays([batch], ["t"])], "t"):
                ids, n = bpe.encode_all(texts)
                ends = np.concatenate(([0], np.cumsum(n)))
                yield pa.StructArray.from_arrays([lists(ids, ends), decoded(token, ids, ends)], ["ids", "text"])

    return both(text)


def encode_documents(docs: DataFrame, path: str, text: str = "text", into: str = "token_ids") -> DataFrame:
    """``docs`` with the ids of every whole text in ``into`` (replaced if there is one)."""
    return docs.withColumn(into, token_ids(F.col(f"`{text}`"), path))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256: what a round trip through the ids gives."""
    coded = docs.select("doc_id", round_trip(F.col("text"), path).alias("r"))
    return coded.select(
        "doc_id",
        F.size("r.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("r.ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("r.text", 256).alias("decoded_sha256"),
    )
