"""Hard negatives: for an anchor and each of its nearest rows of the same label, the best rows of other labels that score in a window.

A row is (vec_id, label, embedding); each component x counts as floor(256 * x), and the score of two rows is the integer
inner product.  Higher scores come first, of equal ones the smaller vec_id.  An anchor's positives are its first rows of
its own label with another vec_id; a positive's negatives are the first rows of other labels whose score n fulfils
low * p <= 100 * n <= high * p, where p is the positive's score.

Method: all rows lie in blocks of a bounded number of rows, each with a cover tree of its own, built in a task and kept as
a table row.  Vectors x are augmented by sqrt(M^2 - |x|^2), M being the block's longest norm, so that the inner product with an
anchor q falls with the distance to (q, 0).  Level by level a node's children are centres picked farthest first until the node's
radius is halved (or there are ``FAN`` of them), with the rows nearest to each; each node keeps the radius that covers its
rows.  Distance to a centre and covering radius bound the inner products below a node from both sides.  A search descends
best first, by the highest upper bound, for all anchors of a chunk side by side; at each node only the anchors remain whose
window and worst kept score the bounds still reach, and leaves are verified by exact inner products.

Scale: anchors go in chunks of ``ANCHORS`` rows, which alone are sent to tasks; a chunk makes two passes over the trees (positives,
then the windows that follow from them).  A task carries its best rows from block to block and gives one short list an anchor,
so what is shuffled is tasks x anchors x k; no list of all candidates exists anywhere.

Rows: those with a null vec_id, label or vector, or a null or non-finite component, take no part.  Vectors of several lengths are filled
with zeros.  Repeated rows (equal id and score) count once, as anchors too.  Scores must fit 64 bits.  Without rows or anchors the result is
empty.  Other columns aren't read, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltrail.llm.store import written

SCALE = 256
#: Rows of a block, rows of a leaf, children of a node, levels of a tree; anchors of a chunk.
BLOCK, LEAF, FAN, LEVELS = 8192, 128, 16, 24
ANCHORS = 8192
TREE = "block bigint, ids binary, labels binary, vectors binary, kind string, width int, nodes binary, centres binary, radii binary, norm double"
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def taking_part(rows: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) of the rows that can be scored."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return rows.select("vec_id", "label", "embedding").where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & sound)


def matrix(vectors: pa.Array, width: int | None = None) -> np.ndarray:
    """floor(256 * x) of each vector, filled with zeros to one length, as int64."""
    n = np.asarray(vectors.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
    flat = np.floor(SCALE * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).astype(np.int64)
    width = int(n.max(initial=0)) if width is None else width
    if (n == width).all():
        return flat.reshape(len(n), width)
    out = np.zeros((len(n), max(width, int(n.max(initial=0)))), dtype=np.int64)
    out[np.repeat(np.arange(len(n)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of a and b: in doubles while no sum can leave their exact integers."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    if width * float(np.abs(a).max()) * float(np.abs(b).max()) < 2 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


# ------------------------------------------------------------------ the tree

def cover_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, float]:
    """(order, nodes, centres, radii, norm) of vectors: node i covers rows order[first:last] and its children are nodes[child:child + n];
    nodes has (first, last, child, n) of each, the root first."""
    square = (x * x).sum(axis=1)
    norm2 = square.max(initial=0.0)
    y = np.concatenate((x, np.sqrt(np.maximum(norm2 - square, 0.0))[:, None]), axis=1)
    order = np.arange(len(x))
    nodes, centres, radii = [(0, len(x), 0, 0)], [y[0]], [float(np.sqrt(((y - y[0]) ** 2).sum(axis=1).max()))]
    level = [0]
    for _ in range(LEVELS):
        deeper = []
        for node in level:
            first, last, _, _ = nodes[node]
            if last - first <= LEAF or radii[node] == 0.0:
                continue
            rows = y[order[first:last]]
            near = ((rows - centres[node]) ** 2).sum(axis=1)  # to the nearest centre so far
            nearest, count = np.zeros(len(rows), dtype=np.int64), 1
            picked = [centres[node]]
            while count < FAN and near.max() > (radii[node] / 2) ** 2:
                far = rows[int(near.argmax())]
                away = ((rows - far) ** 2).sum(axis=1)
                closer = away < near
                nearest[closer], near = count, np.where(closer, away, near)
                picked.append(far)
                count += 1
            by = np.argsort(nearest, kind="stable")
            order[first:last] = order[first:last][by]
            cuts = np.searchsorted(nearest[by], np.arange(count + 1))
            child = len(nodes)
            for c in range(count):
                if cuts[c] < cuts[c + 1]:
                    deeper.append(len(nodes))
                    nodes.append((first + int(cuts[c]), first + int(cuts[c + 1]), 0, 0))
                    centres.append(picked[c])
                    radii.append(float(np.sqrt(near[by][cuts[c]:cuts[c + 1]].max())))
            nodes[node] = (first, last, child, len(nodes) - child)
        level = deeper
    return order, np.array(nodes, dtype=np.int64), np.array(centres), np.array(radii), float(np.sqrt(norm2))


class Tree:
    """A block as it is kept in a table row."""

    def __init__(self, row: dict):
        self.ids, self.labels = np.frombuffer(row["ids"], dtype=np.int64), np.frombuffer(row["labels"], dtype=np.int64)
        self.vectors = np.frombuffer(row["vectors"], dtype=row["kind"]).reshape(len(self.ids), row["width"]).astype(np.int64)
        self.nodes = np.frombuffer(row["nodes"], dtype=np.int64).reshape(-1, 4)
        self.centres, self.radii = np.frombuffer(row["centres"]).reshape(len(self.nodes), -1), np.frombuffer(row["radii"])
        self.norm = row["norm"]

    def bounds(self, queries: np.ndarray, lengths: np.ndarray, nodes: slice) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product of each query with any row below each node, with room for rounding."""
        both = lengths[:, None] ** 2 + self.norm ** 2
        width = min(queries.shape[1], self.centres.shape[1] - 1)
        to = np.sqrt(np.maximum(lengths[:, None] ** 2 + (self.centres[nodes] ** 2).sum(axis=1) - 2 * queries[:, :width] @ self.centres[nodes, :width].T, 0.0))
        slack = 1e-9 * both + 1.0
        low = (both - (to + self.radii[nodes]) ** 2) / 2 - slack
        return low, (both - np.maximum(to - self.radii[nodes], 0.0) ** 2) / 2 + slack


def build(table: pa.Table) -> pa.Table:
    """The tree of one block's rows (block, vec_id, label, embedding)."""
    ids, labels = (np.asarray(table.column(c).combine_chunks().to_numpy(zero_copy_only=False), dtype=np.int64) for c in ("vec_id", "label"))
    x = matrix(table.column("embedding").combine_chunks())
    by = np.lexsort((labels, ids))
    order, nodes, centres, radii, norm = cover_tree(x[by].astype(np.float64))
    by = by[order]
    kind = next(k for k in ("int16", "int32", "int64") if np.abs(x).max(initial=0) <= np.iinfo(k).max)
    row = {"block": table.column("block")[0].as_py(), "ids": ids[by].tobytes(), "labels": labels[by].tobytes(), "vectors": x[by].astype(kind).tobytes(), "kind": kind, "width": x.shape[1],
           "nodes": nodes.tobytes(), "centres": centres.tobytes(), "radii": radii.tobytes(), "norm": norm}
    return pa.table({k: pa.array([v], t) for (k, v), t in zip(row.items(), (pa.int64(), *[pa.binary()] * 3, pa.string(), pa.int32(), *[pa.binary()] * 3, pa.float64()))})


def trees(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every row's block as a tree, in a table in the shared folder."""
    rows = written(rows.select("vec_id", F.col("label").cast("bigint").alias("label"), "embedding"), "negatives-rows")
    count = max(1, -(-rows.count() // block))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(count)))
    return written(dealt.groupBy("block").applyInArrow(build, TREE), "negatives-trees")


# ------------------------------------------------------------------ the search

class Best:
    """The k best (score, id) of each query so far, best first."""

    def __init__(self, n: int, k: int):
        self.scores, self.ids = np.full((n, k), LEAST), np.full((n, k), MOST)

    @property
    def worst(self) -> np.ndarray:
        return self.scores[:, -1]

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores (LEAST: none) of the points ``ids`` for the queries ``rows``; a pair of score and id counts once."""
        k = self.scores.shape[1]
        s = np.concatenate((self.scores[rows], scores), axis=1)
        i = np.concatenate((self.ids[rows], np.where(scores == LEAST, MOST, ids)), axis=1)
        for _ in range(2):  # sorted, repeated ones out, sorted again
            by = np.lexsort((i, ~s), axis=1)  # ~s falls as s rises
            s, i = np.take_along_axis(s, by, axis=1), np.take_along_axis(i, by, axis=1)
            again = np.zeros(s.shape, dtype=bool)
            again[:, 1:] = (s[:, 1:] == s[:, :-1]) & (i[:, 1:] == i[:, :-1]) & (s[:, 1:] != LEAST)
            if not again.any():
                break
            s[again], i[again] = LEAST, MOST
        self.scores[rows], self.ids[rows] = s[:, :k], i[:, :k]


class Queries:
    """Anchors' vectors, and what each looks for: rows of its own label or of others, with scores from low to high."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray, same: bool, of: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
        self.vectors, self.ids, self.labels, self.same, self.of, self.low, self.high, self.k = vectors, ids, labels, same, of, low, high, k

    def search(self, tree: Tree, best: Best) -> None:
        """Best-first descent of one block for all queries: nodes out of a query's reach are skipped, leaves are verified."""
        q = self.vectors.astype(np.float64)
        lengths = np.sqrt((q ** 2).sum(axis=1))

        def reach(rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            return (low <= self.high[rows]) & (high >= self.low[rows]) & (high >= best.worst[rows])

        every = np.arange(len(self.of))
        low, high = (b[:, 0][self.of] for b in tree.bounds(q, lengths, slice(0, 1)))
        heap = [(-high.max(initial=0.0), 0, every, low, high)]
        while heap:
            _, node, rows, low, high = heapq.heappop(heap)
            live = reach(rows, low, high)
            if not live.any():
                continue
            rows = rows[live]
            first, last, child, n = tree.nodes[node]
            anchors, place = np.unique(self.of[rows], return_inverse=True)
            if n:
                lows, highs = tree.bounds(q[anchors], lengths[anchors], slice(child, child + n))
                for c in range(n):
                    lo, hi = lows[place, c], highs[place, c]
                    kept = reach(rows, lo, hi)
                    if kept.any():
                        heapq.heappush(heap, (-float(hi[kept].max()), int(child + c), rows[kept], lo[kept], hi[kept]))
                continue
            for a in range(first, last, LEAF):  # rows without distance between them are one leaf, however many
                part = slice(a, min(a + LEAF, last))
                scores = products(self.vectors[anchors], tree.vectors[part])
                if self.same:
                    fits = (tree.labels[part] == self.labels[anchors][:, None]) & (tree.ids[part] != self.ids[anchors][:, None])
                else:
                    fits = tree.labels[part] != self.labels[anchors][:, None]
                scores = np.where(fits, scores, LEAST)[place]
                good = (scores >= self.low[rows][:, None]) & (scores <= self.high[rows][:, None]) & (scores >= best.worst[rows][:, None]) & (scores != LEAST)
                some = good.any(axis=1)
                if some.any():
                    best.add(rows[some], np.where(good[some], scores[some], LEAST), tree.ids[part])

    def over(self, kept: DataFrame) -> DataFrame:
        """(query, rank, id, score) of each query's k best rows over all blocks."""
        me = self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = Best(len(me.of), me.k)
            for batch in batches:
                for row in batch.to_pylist():
                    me.search(Tree(row), best)
            query, place = np.nonzero(best.scores != LEAST)
            yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(best.ids[query, place]), pa.array(best.scores[query, place])], ["query", "id", "score"])

        found = kept.mapInArrow(run, "query bigint, id bigint, score bigint").distinct()
        w = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
        return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= self.k).select("query", "rank", "id", "score")


def chunks(anchors: DataFrame, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, vectors) of the anchors in chunks of about ``limit`` rows, all that the driver and a task get of them."""
    anchors = anchors.select("vec_id", F.col("label").cast("bigint").alias("label"), "embedding")
    n = -(-anchors.count() // limit)
    for c in range(n):
        mine = anchors if n == 1 else anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(n)) == c)
        table = mine.toArrow()
        ids, labels = (np.asarray(table.column(x).combine_chunks().to_numpy(zero_copy_only=False), dtype=np.int64) for x in ("vec_id", "label"))
        vectors = matrix(table.column("embedding").combine_chunks())
        whole = np.concatenate((ids[:, None], labels[:, None], vectors), axis=1)
        whole = np.unique(whole, axis=0)
        yield whole[:, 0].copy(), whole[:, 1].copy(), whole[:, 2:].copy()


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         block: int = BLOCK, limit: int = ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor and positive."""
    spark = rows.sparkSession
    rows = taking_part(rows)
    kept, out = trees(rows, block), None
    for ids, labels, vectors in chunks(rows.where(is_anchor), limit):
        of = np.arange(len(ids))
        first = Queries(vectors, ids, labels, True, of, np.full(len(ids), LEAST), np.full(len(ids), MOST), positives)
        near = first.over(kept).orderBy("query", "rank").toPandas()  # at most ``positives`` rows an anchor of the chunk
        at, positive, score = (near[c].to_numpy(dtype=np.int64) for c in ("query", "id", "score"))
        # low * p <= 100 * n <= high * p, in whole numbers
        then = Queries(vectors, ids, labels, False, at, -(-low * score // 100), high * score // 100, negatives)
        names = spark.createDataFrame(pa.table({"query": np.arange(len(at)), "anchor_id": ids[at], "positive_id": positive, "positive_score": score}))
        found = then.over(kept).join(F.broadcast(names), "query")  # a chunk's positives
        found = found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        found = written(found, "negatives")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    return out


def digests(rows: DataFrame) -> DataFrame:
    """Hard negatives of the rows whose vec_id 100 divides; where 7 divides it, the label moves on by one of ten."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.select("vec_id", moved.alias("label"), "embedding"), F.col("vec_id") % 100 == 0)
