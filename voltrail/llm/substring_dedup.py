"""Duplicate passages: every window of ``WINDOW`` words that also stands earlier.

Relative Lempel-Ziv parsing cuts a document into factors: longest runs of words that also stand,
in one piece, at an earlier place (a smaller doc_id, or further up in the same document).  Factors
of ``WINDOW`` words or more are duplicate spans.  A span may end where one factor ends and the next
begins, though a window across that boundary stands earlier as well, at a third place.  And the
longest factor at a word is known only when the document was held against every block, which is
work by the square of the input.  So factors aren't grown here: every window of ``WINDOW`` words is looked up by its hash, a word goes if any
window over it is found, and windows found side by side are glued to pieces of factors.

The reference is all text, indexed in blocks.  The least hash of the 11-word runs in a window is
its anchor; equal windows have equal anchors, and neighbouring windows mostly share theirs.  A
window is filed under its anchor in the block that the anchor's hash names, so each block answers
for every window that could match in it and no block sees a document whole.  A block's size is
bounded (``BLOCK`` bytes of text a block on average): their number follows the input, and so does that of the tasks (``PART`` bytes of text each on average).
Two things keep single blocks from growing.  Before anything is sent, a task drops what repeats within the
text it has at hand, so that a passage that many documents share reaches its block once a task
and not once a document.  And the anchors of all text are counted first (those that are rare in
a task by an unbiased draw, as their sum over all tasks matters): the windows of an anchor
that stands in very many places (a phrase with ever other words around it) are filed under
their own hashes instead, over all blocks.  That a window matches doesn't depend on it.

Null or empty text: no words, nothing removed.  Rows with equal doc_id: different texts are
different documents (ordered by a hash of the text), rows alike in both are one document.  A null
doc_id comes before all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltrail.llm import words
from voltrail.llm.store import written

WINDOW = 20
ANCHOR = 11  # words whose hash files a window; WINDOW - ANCHOR + 1 of them stand in it
BLOCK = 24 << 20  # bytes of text a block of the index
PART = 64 << 20  # bytes of text whose blocks a task matches, one block after another
FLUSH = 24 << 20  # bytes of text that a task indexes at a time
LOCAL_HOT = 32  # places of an anchor in ``FLUSH`` bytes of text from which it is counted place by place
HOT = 20_000  # places of an anchor in all text from which its windows are spread
MOST_HOT = 500_000  # so many anchors at most are spread: those with more than this share of all places
PACKED = 4096  # blocks up to which a task sends each block one value; beyond, these would be small, and each group is a row
NO_ID = -(2**63)
FACTOR = "id bigint, tag bigint, start int, n int, ref_id bigint, ref_start int"
KIND = np.dtype([("id", "<i8"), ("tag", "<i8"), ("start", "<i4"), ("n", "<i4"), ("ref_id", "<i8"), ("ref_start", "<i4")])


def sliding_least(x: np.ndarray, n: int) -> np.ndarray:
    """Least of ``x[i:i + n]`` for each i."""
    size = 1
    while size * 2 <= n:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:len(x) - (n - size)], x[n - size:]) if size < n else x


def runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new run of rows alike in all keys starts."""
    if not len(keys[0]):
        return np.empty(0, dtype=np.int64)
    new = np.ones(len(keys[0]), dtype=bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def factors_of(ids: np.ndarray, tags: np.ndarray, starts: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(factors, which windows are found earlier) of windows in order of (id, tag, start); windows alike in all keys are equal."""
    order = np.lexsort(keys)
    head = np.zeros(len(order), dtype=np.int64)
    new = runs(*(k[order] for k in keys))
    head[new] = new
    first = np.empty(len(order), dtype=np.int64)
    first[order] = order[np.maximum.accumulate(head)]
    found = (ids[first] != ids) | (tags[first] != tags) | (starts[first] != starts)
    at = np.flatnonzero(found)
    ref = first[at]
    step = starts[at] - np.arange(len(at))  # alike along consecutive windows
    cut = runs(ids[at], tags[at], step, ids[ref], tags[ref], starts[ref] - starts[at])
    out = np.empty(len(cut), dtype=KIND)
    size = np.diff(np.concatenate((cut, [len(at)])))
    out["id"], out["tag"], out["start"], out["n"] = ids[at][cut], tags[at][cut], starts[at][cut], size + WINDOW - 1
    out["ref_id"], out["ref_start"] = ids[ref][cut], starts[ref][cut]
    return out, found


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one value; integers of few distinct bytes shrink, hashes are stored as they are."""
    raw = [a.tobytes() if a.dtype == np.uint64 or a.dtype == np.uint8 else zstandard.ZstdCompressor(level=1).compress(a.tobytes()) for a in arrays]
    return np.array([len(r) for r in raw], dtype="<i8").tobytes() + b"".join(raw)


def unpacked(value: bytes, *kinds: np.dtype) -> list[np.ndarray]:
    sizes = np.frombuffer(value, dtype="<i8", count=len(kinds))
    out, at = [], 8 * len(kinds)
    for size, kind in zip(sizes.tolist(), map(np.dtype, kinds)):
        raw = value[at:at + size]
        at += size
        out.append(np.frombuffer(raw if kind in (np.uint64, np.uint8) else zstandard.ZstdDecompressor().decompress(raw), dtype=kind))
    return out


HEAD = np.dtype([("filed", "<u8"), ("id", "<i8"), ("tag", "<i8"), ("start", "<i4"), ("n", "<i4")])
GROUPS = ("u8", "<i8", "<i8", "<i4", "<i4", "u8")  # what a window is filed under, id, tag, start, windows; each window's hash


def group_rows(filed: np.ndarray, ids: np.ndarray, tags: np.ndarray, start: np.ndarray, n: np.ndarray, whole: np.ndarray) -> pa.Array:
    """Each group as a value of its own: a head and eight bytes a window."""
    head = np.empty(len(filed), dtype=HEAD)
    for name, x in zip(HEAD.names, (filed, ids, tags, start, n)):
        head[name] = x
    size = HEAD.itemsize + 8 * n.astype(np.int64)
    ends = np.concatenate(([0], np.cumsum(size)))
    out = np.empty(int(ends[-1]), dtype=np.uint8)
    out[ends[:-1, None] + np.arange(HEAD.itemsize)] = head.view(np.uint8).reshape(-1, HEAD.itemsize)
    out[words.spread(ends[:-1] + HEAD.itemsize, 8 * n.astype(np.int64))] = whole.view(np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(out)])


def groups_of(values: pa.Array) -> list[np.ndarray]:
    """``GROUPS`` of what ``group_rows`` made."""
    at = np.frombuffer(values.buffers()[1], dtype=np.int32)[values.offset:values.offset + len(values) + 1].astype(np.int64)
    data = np.frombuffer(values.buffers()[2], dtype=np.uint8) if at[-1] else np.empty(0, dtype=np.uint8)
    head = np.ascontiguousarray(data[at[:-1, None] + np.arange(HEAD.itemsize)]).view(HEAD).ravel()
    whole = data[words.spread(at[:-1] + HEAD.itemsize, 8 * head["n"].astype(np.int64))].view("<u8")
    return [*(np.ascontiguousarray(head[name]) for name in HEAD.names), whole]


def anchored(w: words.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first words of the windows, their anchors, word hashes)."""
    word = w.hashes()
    at = w.windows(WINDOW)
    if not len(at):
        return at, np.empty(0, dtype=np.uint64), word
    n = np.arange(len(word) + 1)
    grams = words.run_hash(word, n[:-ANCHOR], n[ANCHOR:])
    return at, sliding_least(grams, WINDOW - ANCHOR + 1)[at], word


def hot_anchors(rows: DataFrame) -> np.ndarray:
    """Anchors with very many places in all text, sorted; at most ``MOST_HOT``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            anchor, n = np.unique(np.concatenate(held), return_counts=True)
            # Of anchors with n < ``LOCAL_HOT`` places n in ``LOCAL_HOT`` are drawn, by a hash, and count for that many:
            # an anchor with few places in each of many tasks comes to about what it has.
            salt = words.mix(np.bitwise_xor.reduce(anchor) ^ np.uint64(len(anchor)))
            drawn = (words.mix(anchor ^ salt) % np.uint64(LOCAL_HOT)).astype(np.int64) < n
            return pa.RecordBatch.from_arrays([pa.array(anchor[drawn].view(np.int64)), pa.array(np.maximum(n[drawn], LOCAL_HOT))], ["anchor", "n"])

        for _, texts in words.parts(batches, "text"):
            w = words.split(texts)
            at, anchor, _ = anchored(w)
            if len(at):
                held.append(anchor[runs(anchor, w.text_of[at])])
                size += sum(map(len, texts))
            if size >= FLUSH:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    counts = rows.select("text").mapInArrow(count, "anchor bigint, n bigint").groupBy("anchor").agg(F.sum("n").alias("n"))
    counts = written(counts, "anchors")
    total = counts.agg(F.sum("n")).first()[0] or 0
    often = counts.where(F.col("n") >= max(HOT, total // MOST_HOT + 1)).select("anchor")
    return np.sort(np.array([r[0] for r in often.collect()], dtype=np.int64).view(np.uint64))  # ``MOST_HOT`` at most


def among(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(x), dtype=bool)
    return ordered[np.minimum(np.searchsorted(ordered, x), len(ordered) - 1)] == x


def index_part(ids: np.ndarray, tags: np.ndarray, texts: list[bytes], hot: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """(factors within these texts, the other windows grouped by anchor)."""
    by = np.lexsort((tags, ids))
    ids, tags, w = ids[by], tags[by], words.split([texts[i] for i in by])
    at, anchor, word = anchored(w)
    if not len(at):
        return np.empty(0, dtype=KIND), tuple(np.empty(0, dtype=k) for k in GROUPS)
    n = np.arange(len(word) + 1)
    whole = words.run_hash(word, n[at], n[at] + WINDOW)
    text = w.text_of[at]
    start = (at - w.first[text]).astype(np.int32)
    local, found = factors_of(ids[text], tags[text], start, whole)
    keep = np.flatnonzero(~found)
    anchor, whole, start, text = anchor[keep], whole[keep], start[keep], text[keep]
    spread = among(anchor, hot)
    filed = np.where(spread, words.mix(anchor ^ whole), anchor)
    cut = runs(filed, text, start - np.arange(len(keep)))
    size = np.diff(np.concatenate((cut, [len(keep)]))).astype(np.int32)
    return local, (filed[cut], ids[text[cut]], tags[text[cut]], start[cut], size, whole)


def index_blocks(n_blocks: int, hot: np.ndarray):
    """Documents -> rows (block, index): what each block is to hold, and factors that were found at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            local = np.concatenate([h[0] for h in held])
            anchor, ids, tags, start, n, whole = (np.concatenate([h[1][i] for h in held]) for i in range(6))
            block = (words.mix(anchor) % np.uint64(n_blocks)).astype(np.int64)
            if n_blocks > PACKED:
                rows, to = group_rows(anchor, ids, tags, start, n, whole), pa.array(block, pa.int32())
                if len(local):
                    rows, to = pa.concat_arrays([rows, pa.array([local.tobytes()], pa.binary())]), pa.concat_arrays([to, pa.array([-1 - int(local["id"][0] % n_blocks)], pa.int32())])
                return pa.RecordBatch.from_arrays([to, rows], ["block", "held"])
            order = np.argsort(block, kind="stable")
            ends = np.searchsorted(block[order], np.arange(n_blocks + 1))
            first = np.concatenate(([0], np.cumsum(n)))
            out, to = [], []
            for b in np.flatnonzero(np.diff(ends)):
                g = order[ends[b]:ends[b + 1]]
                of = np.repeat(first[g] - np.concatenate(([0], np.cumsum(n[g])[:-1])), n[g]) + np.arange(n[g].sum())
                out.append(packed(anchor[g], ids[g], tags[g], start[g], n[g], whole[of]))
                to.append(int(b))
            if len(local):  # any block passes these on
                out.append(local.tobytes())
                to.append(-1 - int(local["id"][0] % n_blocks))
            return pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(out, pa.large_binary()).cast(pa.binary())], ["block", "held"])

        for batch, texts in words.parts(batches, "text"):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            tags = batch.column(1).to_numpy(zero_copy_only=False)
            held.append(index_part(ids, tags, texts, hot))
            size += sum(map(len, texts))
            if size >= FLUSH:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return run


def match_block(table: pa.Table, packed_values: bool) -> pa.Table:
    """All that one block holds -> its factors."""
    block, held = table.column("block")[0].as_py(), table.column("held")
    if block < 0:
        out = np.concatenate([np.frombuffer(v, dtype=KIND) for v in held.to_pylist()])
        return pa.table([pa.array(np.ascontiguousarray(out[f])) for f in KIND.names], names=list(KIND.names))
    parts = [unpacked(v, *GROUPS) for v in held.to_pylist()] if packed_values else [groups_of(c) for c in held.chunks if len(c)]
    anchor, ids, tags, start, n, whole = (np.concatenate([p[i] for p in parts]) for i in range(6))
    del parts
    names, of = np.unique(anchor, return_inverse=True)
    often = np.flatnonzero((np.bincount(of, minlength=len(names)) > 1)[of])
    first = np.concatenate(([0], np.cumsum(n)))
    g = often[np.lexsort((start[often], tags[often], ids[often]))]
    count = n[g]
    inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    key, filed = whole[np.repeat(first[g], count) + inner], np.repeat(of[g].astype(np.int32), count)
    found, _ = factors_of(np.repeat(ids[g], count), np.repeat(tags[g], count), np.repeat(start[g], count) + inner.astype(np.int32), key, filed)
    return pa.table([pa.array(np.ascontiguousarray(found[f])) for f in KIND.names], names=list(KIND.names))


def keyed(docs: DataFrame) -> DataFrame:
    """id, tag and text; the tag tells rows of one doc_id apart."""
    rows = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "doc_id", "text")
    again = rows.groupBy("id").agg(F.count("*").alias("rows")).where("rows > 1").select("id", F.lit(True).alias("again"))
    if again.isEmpty():
        return rows.withColumn("tag", F.lit(0).cast("long"))
    return rows.join(again, "id", "left").withColumn("tag", F.when(F.col("again"), F.xxhash64(F.coalesce("text", F.lit("")))).otherwise(F.lit(0).cast("long"))).drop("again")


def factors(rows: DataFrame) -> DataFrame:
    """(id, tag, start, n, ref_id, ref_start): pieces of factors of ``keyed`` rows, each of ``WINDOW`` words or more; pieces of one factor overlap."""
    spark = rows.sparkSession
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_blocks = max(partitions, -(-size // BLOCK))
    filed = rows.select("id", "tag", "text").mapInArrow(index_blocks(n_blocks, hot_anchors(rows)), "block int, held binary")
    if size > partitions * PART:  # tasks follow the blocks, whatever the session's setting
        filed = filed.repartition(-(-size // PART), "block")
    packed_values = n_blocks <= PACKED
    return filed.groupBy("block").applyInArrow(lambda table: match_block(table, packed_values), FACTOR)


def without_spans(text: Column, spans: Column) -> Column:
    """struct(n_words, n_removed, kept): the words that no span covers, joined by one space."""

    @F.arrow_udf("struct<n_words:bigint,n_removed:bigint,kept:string>")
    def cut(texts: pa.Array, found: pa.Array) -> pa.Array:
        n, gone, kept = [], [], []
        for t, f in zip(words.as_bytes(texts), found):
            w = t.split()
            n.append(len(w))
            f = f.values
            if f is None or not len(f):
                gone.append(0)
                kept.append(b" ".join(w))
                continue
            at, size = f.field("start").to_numpy(), f.field("n").to_numpy()
            edge = np.zeros(len(w) + 1, dtype=np.int32)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + size, -1)
            stay = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
            gone.append(len(w) - len(stay))
            kept.append(b" ".join([w[i] for i in stay]))
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["n_words", "n_removed", "kept"])

    return cut(text, spans)


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and ``kept`` (the text that is left) of every row."""
    rows = keyed(docs)
    spans = factors(rows).groupBy("id", "tag").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    joined = rows.join(spans, ["id", "tag"], "left")
    return joined.select("doc_id", without_spans(F.col("text"), F.col("spans")).alias("r")).select("doc_id", "r.*")


def digests(docs: DataFrame) -> DataFrame:
    return dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
