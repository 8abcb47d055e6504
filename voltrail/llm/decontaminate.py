"""Benchmark decontamination: which documents hold a benchmark item, up to edits.

Texts are words (ASCII letters folded, ASCII punctuation and white space between words).  An item
of n words is in a document if some stretch of it is within ``floor(rate * n)`` word edits.

Candidates come from CGK embeddings: a random walk reads a word sequence, and at each step writes
the word it stands on and moves on if a random bit of (step, word) says so, so that few edits
change few of the symbols written and edit distance becomes Hamming distance.  Each repetition
draws a new walk, a word of the item to start from (edits near one place don't fail them all) and
positions to sample; a window of the document is a candidate if all sampled symbols agree with an
item's.  Windows start at every word.  They are taken item-sized: how far samples reach follows
the item's length.  A window is dropped at the first symbol that no item has, so most cost
one look-up a repetition.  Each size class of items gets the repetitions that a simulation with the
largest allowed number of random edits on its own items needs for ``recall``.  A class that doesn't
get there in ``MOST`` repetitions is searched for at every place where enough of its words stand.

A candidate without any of the item's k + 1 rarest words (k: the edits allowed) needs more edits
than that and is dropped.  Every other one is verified by the exact word edit distance between the item and the best stretch
around the window, so nothing is reported that isn't there.

Items go to tasks in blocks of bounded size; a larger benchmark is more passes over the documents.
Null or empty texts hold nothing, and an item without words is nowhere.  Items alike after
folding are searched for once and each reported.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltrail.llm import words

RATE = 0.2  # word edits a word of the item
RECALL = 0.97  # that the walks must reach in each class of items with the most edits allowed
BLOCK_BYTES = 8 << 20  # of item text that goes to tasks at once
MOST = 60  # repetitions, a bit of a word each
TRIALS = 400  # a class
FEW = 7  # edits: below this, one edit more or less makes a class of its own in the simulation
BETWEEN = words.SPACE.copy()
BETWEEN[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
PAD = np.uint64(0)
HIT = "array<struct<item:int,start:int,n:int,distance:int>>"


def word_hashes(texts: list[bytes]) -> words.Words:
    return words.split([t.lower() for t in texts], BETWEEN)


def steps(seed: int, h: np.ndarray, at: np.ndarray, end: np.ndarray, pos: np.ndarray, a: int, b: int) -> np.ndarray:
    """Positions after steps a..b-1 of walk ``seed`` from ``pos``; past ``end`` a walk stands still."""
    pos = pos.copy()
    for j in range(a, b):
        live = np.minimum(pos, end - 1)
        salt = words.mix(np.array([seed * 1_000_003 + j // 32], dtype=np.uint64))[0]
        bit = (words.mix(h[live] ^ salt) >> np.uint64(j % 32)) & np.uint64(1)
        pos += np.where(pos < end, bit.astype(np.int64), 0)
    return pos


def symbol(h: np.ndarray, end: np.ndarray, pos: np.ndarray) -> np.ndarray:
    return np.where(pos < end, h[np.minimum(pos, end - 1)], PAD)


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return words.mix(a * np.uint64(0x9E3779B97F4A7C15) + b)


@dataclass
class Repetition:
    """One walk: where it starts in each item, which steps are sampled, and the items' symbols."""

    seed: int
    second: int  # step of the second sample
    third: dict[int, int]  # size class -> step of the third, of the classes that need this repetition
    offset: np.ndarray  # word of each item that the walk starts from
    first: np.ndarray  # the items' symbols: sorted, without repeats
    pairs: np.ndarray
    triples: dict[int, tuple[np.ndarray, np.ndarray]]  # size class -> (sorted keys, items)


def size_class(n: int) -> int:
    return max(0, int(np.log(n) / np.log(1.35)))


def samples(rep: Repetition, h: np.ndarray, at: np.ndarray, end: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The three chained keys of the sequences ``h[at:end]`` of size classes ``kind``."""
    one = symbol(h, end, at)
    pos = steps(rep.seed, h, at, end, at, 0, rep.second)
    two = joined(one, symbol(h, end, pos))
    three = np.zeros(len(at), dtype=np.uint64)
    for c, step in rep.third.items():
        of = np.flatnonzero(kind == c)
        three[of] = joined(two[of], symbol(h, end[of], steps(rep.seed, h, at[of], end[of], pos[of], rep.second, step)))
    return one, two, three


class Index:
    """Walks and symbols of a block of items."""

    def __init__(self, texts: list[bytes], rate: float = RATE, recall: float = RECALL, seed: int = 11):
        w = word_hashes(texts)
        h = w.hashes()
        seqs = [h[a:b] for a, b in zip(w.first, w.first[1:])]
        alike: dict[bytes, list[int]] = {}
        for i, s in enumerate(seqs):
            if len(s):
                alike.setdefault(s.tobytes(), []).append(i)
        self.items = list(alike.values())  # items of one word sequence
        self.seqs = [seqs[m[0]] for m in self.items]
        self.most = np.array([int(rate * len(s) + 1e-9) for s in self.seqs], dtype=np.int64)
        self.kind = np.array([size_class(len(s)) for s in self.seqs], dtype=np.int64)
        self.names = np.unique(np.concatenate(self.seqs)) if self.seqs else np.empty(0, dtype=np.uint64)
        self.vocabulary = words.Table(self.names, np.arange(len(self.names)))
        self.word_of = [np.searchsorted(self.names, s) for s in self.seqs]
        self.rng = np.random.Generator(np.random.PCG64(seed))
        self.reps: list[Repetition] = []
        if not self.seqs:
            return
        same, group = np.unique(self.kind * (FEW + 1) + np.minimum(self.most, FEW), return_inverse=True)
        trials = self.edited([np.flatnonzero(group == g) for g in range(len(same))])
        missed = np.ones((len(same), TRIALS), dtype=bool)
        lacking = np.ones(len(same), dtype=bool)
        while len(self.reps) < MOST and lacking.any():
            self.reps.append(self.repetition(len(self.reps) + seed * 100, np.unique(same[lacking] // (FEW + 1))))
            missed &= ~self.caught(self.reps[-1], trials).reshape(missed.shape)
            lacking = missed.mean(axis=1) > 1 - recall
        self.everywhere = np.flatnonzero(lacking[group])  # items that the walks don't find often enough

    def flat(self, seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        end = np.cumsum([len(s) for s in seqs])
        return np.concatenate(seqs), end - [len(s) for s in seqs], end

    def repetition(self, seed: int, kinds: np.ndarray) -> Repetition:
        rng = self.rng
        n = np.array([len(s) for s in self.seqs])
        offset = np.minimum((rng.random(len(n)) * (0.5 * n)).astype(np.int64), np.maximum(n - 1, 0))
        third = {}
        for c in kinds.tolist():
            # A walk moves on at every second step: about this many lie before the end of the item.
            reach = int(n[self.kind == c].min())
            third[c] = int(rng.integers(min(3, reach), max(4, reach)))
        rep = Repetition(seed, int(rng.integers(1, 4)), third, offset, *[np.empty(0, dtype=np.uint64)] * 2, {})
        mine = np.flatnonzero(np.isin(self.kind, kinds))
        h, at, end = self.flat([self.seqs[i] for i in mine])
        one, two, three = samples(rep, h, at + offset[mine], end, self.kind[mine])
        rep.first, rep.pairs = np.unique(one), np.unique(two)
        for c in third:
            of = np.flatnonzero(self.kind[mine] == c)
            of = of[np.argsort(three[of], kind="stable")]
            rep.triples[c] = three[of], mine[of]
        return rep

    def edited(self, groups: list[np.ndarray]) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """TRIALS items of each group, spread over all of it, with as many random edits as are allowed and other words after
        them: (item, words, which word of the item each is)."""
        out, rng = [], self.rng
        for of in groups:
            for i in of[np.arange(TRIALS) * max(len(of), TRIALS) // TRIALS % len(of)].tolist():
                s, k = list(zip(self.seqs[i].tolist(), range(len(self.seqs[i])))), int(self.most[i])
                draws, new = rng.random((k, 2)).tolist(), rng.integers(2**63, size=k + 30).tolist()
                for (kind, place), word in zip(draws, new):
                    kind, at = int(3 * kind), int(place * len(s))
                    s[at:at + 1] = [(word, -1)] if kind == 0 else [] if kind == 1 and len(s) > 1 else [(word, -1), s[at]]
                out.append((i, np.array([x[0] for x in s] + new[k:], dtype=np.uint64), np.array([x[1] for x in s])))
        return out

    def caught(self, rep: Repetition, trials: list) -> np.ndarray:
        """Whether the walk from the place where the item's starting word now stands finds the item."""
        out = np.zeros(len(trials), dtype=bool)
        at, seqs, which = [], [], []
        for t, (i, s, place) in enumerate(trials):
            k = np.flatnonzero(place == rep.offset[i])
            if len(k) and self.kind[i] in rep.third:
                at.append(int(k[0]))
                seqs.append(s)
                which.append(t)
        if not which:
            return out
        h, start, end = self.flat(seqs)
        item = np.array([trials[t][0] for t in which])
        got = samples(rep, h, start + at, end, self.kind[item])[2]
        want = np.zeros(len(self.seqs), dtype=np.uint64)
        for keys, of in rep.triples.values():
            want[of] = keys
        out[which] = got == want[item]
        return out

    def candidates(self, h: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, expected start, first sampled word) of the windows of words ``h`` (``end``: where each word's text ends) that agree with an item."""
        # One bit a repetition: which of them have a word of this hash prefix first.
        table = np.zeros(1 << 18, dtype=np.uint64)
        for r, rep in enumerate(self.reps):
            slot = (rep.first >> np.uint64(46)).astype(np.int64)
            table[slot] |= np.uint64(1 << r)
        some = table[(h >> np.uint64(46)).astype(np.int64)]
        items, starts, seen = ([np.empty(0, dtype=np.int64)] for _ in range(3))
        for r, rep in enumerate(self.reps):
            at = np.flatnonzero(some & np.uint64(1 << r))
            one = h[at]
            near = end[at]
            pos = steps(rep.seed, h, at, near, at, 0, rep.second)
            two = joined(one, symbol(h, near, pos))
            slot = np.minimum(np.searchsorted(rep.pairs, two), len(rep.pairs) - 1)
            live = np.flatnonzero(rep.pairs[slot] == two)
            at, near, pos, two = at[live], near[live], pos[live], two[live]
            if not len(at):
                continue
            for c, (keys, of) in rep.triples.items():
                key = joined(two, symbol(h, near, steps(rep.seed, h, at, near, pos, rep.second, rep.third[c])))
                a, b = np.searchsorted(keys, key, side="left"), np.searchsorted(keys, key, side="right")
                n = b - a
                which = np.repeat(np.arange(len(key)), n)
                item = of[np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())]
                items.append(item)
                starts.append(at[which] - rep.offset[item])
                seen.append(at[which])
        return np.concatenate(items), np.concatenate(starts), np.concatenate(seen)

    def places(self, item: int, which: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, a word of its text) of windows that hold every stretch within the item's edits: such a stretch has at most
        n + k words, n - k of them the item's.  ``which`` names the words in the vocabulary (-1: no item's)."""
        k, n = int(self.most[item]), len(self.seqs[item])
        own = np.zeros(len(self.names) + 1, dtype=bool)
        own[self.word_of[item]] = True
        held = np.concatenate(([0], np.cumsum(own[which])))
        at = np.arange(len(which))
        first = np.flatnonzero(held[np.minimum(at + n + k, end)] - held[at] >= n - k)
        # A window is good for stretches that start up to k words before it.
        start = -(-first // (k + 1)) * (k + 1)
        fresh = np.flatnonzero(np.concatenate(([True], (start[1:] != start[:-1]) | (end[first[1:]] != end[first[:-1]])))[:len(first)])
        return start[fresh], first[fresh]

    def plausible(self, item: int, start: np.ndarray, there: np.ndarray, held: np.ndarray) -> np.ndarray:
        """Which windows hold one of the item's k + 1 rarest words: without them all, k edits don't do.

        ``there[held[w]:held[w + 1]]`` is where word w of the vocabulary stands in these texts."""
        k, n = int(self.most[item]), len(self.seqs[item])
        own = np.unique(self.word_of[item])
        rare = own[np.argsort(held[own + 1] - held[own], kind="stable")[:k + 1]]
        places = np.sort(np.concatenate([there[held[w]:held[w + 1]] for w in rare.tolist()]))
        return np.searchsorted(places, start - 2 * k) < np.searchsorted(places, start + n + 2 * k)

    def verified(self, h: np.ndarray, begin: np.ndarray, end: np.ndarray, item: int, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, words, edits) of the best stretch around each window; begin and end bound the window's text."""
        s, k = self.seqs[item], int(self.most[item])
        n = len(s)
        width = n + 2 * k + 2 * k  # a start may be off by k words, and the stretch longer by k
        at = start[:, None] - 2 * k + np.arange(width)
        inside = (at >= begin[:, None]) & (at < end[:, None])
        doc = np.where(inside, h[np.clip(at, 0, len(h) - 1)], PAD)
        # Fitting alignment: it may start and end anywhere; where it starts is carried along.
        wide = np.int64(1) << 32
        row = np.broadcast_to(np.arange(width + 1, dtype=np.int64), (len(start), width + 1)).copy()  # edits * wide + start
        step = np.arange(width + 1, dtype=np.int64) * wide
        for word in s:
            left = np.concatenate((row[:, :1] + wide, np.minimum(row[:, 1:] + wide, row[:, :-1] + np.where(doc == word, 0, wide))), axis=1)
            row = np.minimum.accumulate(left - step, axis=1) + step
        last = row.argmin(axis=1)
        best = row[np.arange(len(row)), last]
        # What lies outside the text stands for words of the item that aren't there.
        first = np.maximum(start - 2 * k + (best & (wide - 1)), begin)
        return first, np.maximum(np.minimum(start - 2 * k + last, end) - first, 0), best >> np.int64(32)

    def search(self, texts: list[bytes]) -> list[list[tuple[int, int, int, int]]]:
        """(item, start, words, edits) of the items in each text; of several places of one item the best, then the first."""
        out: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
        w = word_hashes(texts)
        if not len(w.starts) or not self.reps:
            return out
        h, text = w.hashes(), w.text_of
        item, start, seen = self.candidates(h, w.first[1:][text])
        which = self.vocabulary.get(h)
        for i in self.everywhere.tolist():
            more = self.places(i, which, w.first[1:][text])
            item, start, seen = (np.concatenate(x) for x in ((item, np.full(len(more[0]), i)), (start, more[0]), (seen, more[1])))
        if not len(item):
            return out
        of = text[seen]  # an expected start may lie before its text
        order = np.lexsort((of, start, item))
        item, start, of = item[order], start[order], of[order]
        fresh = np.concatenate(([True], (item[1:] != item[:-1]) | (start[1:] != start[:-1]) | (of[1:] != of[:-1])))
        item, start, of = item[fresh], start[fresh], of[fresh]
        cut = np.searchsorted(item, np.arange(len(self.seqs) + 1))
        there = np.flatnonzero(which >= 0)
        there = there[np.argsort(which[there], kind="stable")]
        held = np.searchsorted(which[there], np.arange(len(self.names) + 1))
        for i in np.flatnonzero(np.diff(cut)):
            mine = slice(cut[i], cut[i + 1])
            likely = self.plausible(int(i), start[mine], there, held)
            every, texts_of = start[mine][likely], of[mine][likely]
            size = max(1, (1 << 20) // (len(self.seqs[i]) + 4 * int(self.most[i]) + 1))
            for a in range(0, len(every), size):
                s, t = every[a:a + size], texts_of[a:a + size]
                first, n, edits = self.verified(h, w.first[t], w.first[t + 1], int(i), s)
                good = np.flatnonzero(edits <= self.most[i])
                for g in good.tolist():
                    out[t[g]].append((int(i), int(first[g] - w.first[t[g]]), int(n[g]), int(edits[g])))
        return [self.best(found) for found in out]

    def best(self, found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
        least: dict[int, tuple[int, int, int, int]] = {}
        for hit in found:
            if hit[0] not in least or (hit[3], hit[1]) < (least[hit[0]][3], least[hit[0]][1]):
                least[hit[0]] = hit
        return [(m, *hit[1:]) for i, hit in sorted(least.items()) for m in self.items[i]]


_kept: dict[bytes, Index] = {}


def index_of(texts: list[bytes], rate: float, recall: float) -> Index:
    """A worker's index of a block of items; the last one is kept."""
    key = repr((len(texts), hash(tuple(texts)), rate, recall)).encode()
    if key not in _kept:
        _kept.clear()
        _kept[key] = Index(texts, rate, recall)
    return _kept[key]


def hits(text: Column, items: list[bytes], rate: float, recall: float) -> Column:
    """The items (by place in ``items``) that each whole text holds."""

    @F.arrow_udf(HIT)
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = index_of(items, rate, recall)
        kind = pa.list_(pa.struct([(c, pa.int32()) for c in ("item", "start", "n", "distance")]))
        for column in batches:
            out = []
            for _, texts in words.parts([pa.RecordBatch.from_arrays([column], ["t"])], "t"):
                out += [[dict(zip(("item", "start", "n", "distance"), x)) for x in found] for found in index.search(texts)]
            yield pa.array(out, kind)

    return search(text)


def blocks(items: DataFrame, limit: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """(item_id, text) of the items, in blocks of about ``limit`` bytes each, which bounds what a task gets."""
    rows = items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).where("text <> ''")
    size, n = rows.agg(F.sum(F.octet_length("text") + 64), F.count("*")).first()
    count = -(-(size or 0) // limit)
    for b in range(count):
        mine = rows if count == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == b)
        yield [(r[0], r[1].encode()) for r in mine.orderBy("item_id", "text").collect()]  # about ``limit`` bytes


def leaks(docs: DataFrame, items: DataFrame, rate: float = RATE, recall: float = RECALL) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, distance) of every item that a document holds."""
    out = None
    for block in blocks(items):
        spark = docs.sparkSession
        names = spark.createDataFrame([(i, r[0]) for i, r in enumerate(block)], f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")
        found = docs.select("doc_id", F.explode(hits(F.col("text"), [r[1] for r in block], rate, recall)).alias("h"))
        found = found.select("doc_id", "h.*").join(F.broadcast(names), "item")  # a block's items at most
        found = found.select("doc_id", "item_id", F.col("start").cast("long").alias("start_word"), F.col("n").cast("long").alias("n_words"), F.col("distance").cast("long").alias("distance"))
        out = found if out is None else out.unionByName(found)
    if out is None:
        none = F.lit(None).cast("long")
        return docs.select("doc_id", none.alias("item_id"), none.alias("start_word"), none.alias("n_words"), none.alias("distance")).where("false")
    return out


def clean(docs: DataFrame, items: DataFrame, rate: float = RATE, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs`` whose text holds no item, with all their columns."""
    out = docs
    for block in blocks(items):
        row = out.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
        row = row.select("row", hits(F.col("row.text"), [r[1] for r in block], rate, recall).alias("hits")).where(F.size("hits") == 0)
        out = row.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))
    return out
