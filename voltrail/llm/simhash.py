"""SimHash near-duplicates: Hamming search by the generalised pigeonhole principle.

The 64 bits are grouped into partitions, correlated bits together (correlations of all
fingerprints).  A pair within ``tau`` bits differs in at most ``t_i`` bits of some partition i for
any thresholds with sum(t_i + 1) = tau + 1, where t_i = -1 leaves a partition out.  Thresholds are
allocated by dynamic programming on estimated cost: probes (each fingerprint asks for every value
within t_i bits) and candidate pairs (from a bounded sample of pairs and the bits' frequencies).
The number of partitions is chosen by the same estimate, so more documents mean wider partitions.

Groups of copies are taken together first: equal fingerprints are one row, and fingerprints that
share a partition's value are linked to the smallest of them if they are within ``tau`` (one link
a row, whatever the group's size).  The search then only looks for links between the classes that
this gives.

Empty text: fingerprint 0, linked like any other.  Null text is empty.  Fewer words than a shingle
has: the whole sequence is the shingle.  Rows with equal ids are judged one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltrail.llm import words
from voltrail.llm.components import components
from voltrail.llm.store import written

BITS = 64
SAMPLE = 2048  # fingerprints whose pairs estimate the share of candidates
PROBE_COST, PAIR_COST = 1.0, 1.0  # of a probed value and of a candidate pair, in the same unit


def fingerprints_of(texts: list[bytes], shingle: int, seed: int) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    hashes: list[int] = []
    count = np.zeros(len(texts), dtype=np.int64)
    for k, t in enumerate(texts):
        w = t.lower().split()  # ASCII letters only, as these are bytes
        if len(w) <= shingle:
            if w:
                hashes.append(digest(b" ".join(w), seed))
                count[k] = 1
            continue
        joined = b" ".join(w)
        ends = list(accumulate(map(len, w), lambda a, n: a + n + 1))
        starts = [0, *(e + 1 for e in ends)]
        hashes += [digest(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1:])]
        count[k] = len(w) - shingle + 1
    out = np.zeros(len(texts), dtype=np.uint64)
    full = np.flatnonzero(count)
    if len(full):
        bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
        votes = np.add.reduceat(bits, np.concatenate(([0], np.cumsum(count[full])[:-1])), axis=0, dtype=np.int32)
        out[full] = np.packbits(2 * votes > count[full][:, None], axis=1).view(">u8").ravel()
    return out


def fingerprint(text: Column, shingle: int = 4, seed: int = 42) -> Column:
    """The 64-bit fingerprint of each whole text, as a signed bigint."""

    @F.arrow_udf("bigint")
    def simhash(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            found = [fingerprints_of(texts, shingle, seed) for _, texts in words.parts([pa.RecordBatch.from_arrays([column], ["t"])], "t", 2 << 20)]
            yield pa.array(np.concatenate(found).view(np.int64) if found else np.empty(0, dtype=np.int64))

    return simhash(text)


def bit_matrix(values: np.ndarray) -> np.ndarray:
    """One row of 64 flags a fingerprint; column b is bit b of the number."""
    return np.unpackbits(np.ascontiguousarray(values).view(np.uint64).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def pair_counts(prints: DataFrame) -> np.ndarray:
    """How many fingerprints have bits i and j set, over all of them (64 x 64)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        for batch in batches:
            bits = bit_matrix(batch.column(0).to_numpy(zero_copy_only=False)).astype(np.float32)
            total += bits.T @ bits
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS)), pa.array(total.ravel().astype(np.int64))], ["cell", "n"])

    out = np.zeros(BITS * BITS)
    for cell, n in prints.select("fp").mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect():  # 4,096 rows
        out[cell] = n
    return out.reshape(BITS, BITS)


def grouped_bits(both: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Partitions of about equal size; each takes the free bits most correlated with those it has."""
    p = np.diag(both) / n
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    tied = np.abs(both / n - np.outer(p, p)) / np.outer(spread, spread)
    free, out = set(range(BITS)), []
    for k in range(parts):
        size = (BITS * (k + 1)) // parts - (BITS * k) // parts
        group: list[int] = []
        while len(group) < size:
            rest = sorted(free)
            weight = tied[np.ix_(rest, group if group else rest)].sum(axis=1)
            group.append(rest[int(np.argmax(weight))])
            free.discard(group[-1])
        out.append(sorted(group))
    return out


def near_shares(sample: np.ndarray, p: np.ndarray, group: list[int], tau: int) -> list[float]:
    """Estimated share of pairs that differ in at most 0, 1, .. tau bits of ``group``."""
    q = 2 * p * (1 - p)
    law = np.array([1.0])  # were the bits independent
    for b in group:
        law = np.convolve(law, [1 - q[b], q[b]])
    model = np.cumsum(law)[:tau + 1]
    bits = bit_matrix(sample)[:, group].astype(np.float32)
    ones = bits.sum(axis=1)
    apart = ones[:, None] + ones[None, :] - 2 * bits @ bits.T
    pairs = max(1, len(sample) * (len(sample) - 1))
    seen = [((apart <= t + 0.5).sum() - len(sample)) / pairs for t in range(tau + 1)]
    return [max(float(a), float(b)) for a, b in zip(model, seen)]


def allocate(costs: list[list[float]], tau: int) -> tuple[float, list[int]]:
    """Thresholds with sum(t + 1) = tau + 1 of least total cost; costs[i][t] is that of partition i."""
    best: list[tuple[float, list[int]]] = [(0.0, [])] + [(float("inf"), [])] * (tau + 1)
    for cost in costs:
        step = []
        for share in range(tau + 2):
            options = [(best[share - t - 1][0] + (cost[t] if t >= 0 else 0.0), [*best[share - t - 1][1], t]) for t in range(-1, share)]
            step.append(min(options, key=lambda o: o[0]))
        best = step
    return best[tau + 1]


def plan(prints: DataFrame, tau: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each partition that is probed."""
    both = pair_counts(prints)
    n = prints.count()
    if not n:
        return []
    sample = np.array([r[0] for r in prints.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()], dtype=np.int64)
    found = []
    for parts in range(1, tau + 2):
        groups = grouped_bits(both, n, parts)
        costs = []
        for g in groups:
            shares = near_shares(sample, np.diag(both) / n, g, tau)
            costs.append([PROBE_COST * n * sum(comb(len(g), r) for r in range(t + 1)) + PAIR_COST * n * n * shares[t] for t in range(tau + 1)])
        cost, limits = allocate(costs, tau)
        found.append((cost, parts, [(g, t) for g, t in zip(groups, limits) if t >= 0]))
    return min(found)[2]


def mask(bits: list[int]) -> int:
    """As a signed 64-bit number."""
    m = sum(1 << b for b in bits)
    return m - (1 << 64) if m >> 63 else m


def near(a: str, b: str, tau: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= tau


def classes(prints: DataFrame, parts: list[tuple[list[int], int]], tau: int) -> DataFrame:
    """(fp, class): fingerprints linked to the smallest that shares some partition's value."""
    keys = prints.select("fp", F.explode(F.array(*(F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(mask(g))).alias("value")) for i, (g, _) in enumerate(parts)))).alias("k")).select("fp", "k.*")
    first = keys.groupBy("part", "value").agg(F.min("fp").alias("head"), F.count("*").alias("n")).where("n > 1").drop("n")
    links = keys.join(first, ["part", "value"]).where((F.col("fp") != F.col("head")) & near("fp", "head", tau)).select(F.col("fp").alias("a"), F.col("head").alias("b"))
    roots = components(links)
    return prints.select("fp").join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("class"))


def class_links(members: DataFrame, parts: list[tuple[list[int], int]], tau: int) -> DataFrame:
    """Links (a, b) between classes of which some members are within ``tau`` bits."""
    index, probes = [], []
    for i, (g, t) in enumerate(parts):
        value = F.col("fp").bitwiseAND(F.lit(mask(g)))
        flips = [mask(list(c)) for r in range(t + 1) for c in combinations(g, r)]
        index.append(members.select(F.lit(i).alias("part"), value.alias("value"), F.col("fp").alias("fp_a"), F.col("class").alias("a")))
        flip = F.explode(F.expr(f"array({','.join(f'{x}L' if x > -2**63 else '(-9223372036854775807L - 1L)' for x in flips)})"))
        probes.append(members.select("fp", "class", value.alias("value"), flip.alias("flip")).select(F.lit(i).alias("part"), F.col("value").bitwiseXOR(F.col("flip")).alias("value"), F.col("fp").alias("fp_b"), F.col("class").alias("b")))
    left, right = index[0], probes[0]
    for x, y in zip(index[1:], probes[1:]):
        left, right = left.unionByName(x), right.unionByName(y)
    found = right.alias("r").join(left.alias("l"), (F.col("l.part") == F.col("r.part")) & (F.col("l.value") == F.col("r.value")) & (F.col("a") < F.col("b")) & near("fp_a", "fp_b", tau))
    return found.select("a", "b").distinct()


def near_duplicates(docs: DataFrame, tau: int = 4, shingle: int = 4, seed: int = 42) -> DataFrame:
    """doc_id, fp and component_id (smallest doc_id reachable over links of at most ``tau`` bits) of every row."""
    rows = written(docs.select("doc_id", fingerprint(F.col("text"), shingle, seed).alias("fp")), "fingerprints")
    prints = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    parts = plan(prints, tau)
    if not parts:
        return rows.select("doc_id", "fp", F.col("doc_id").alias("component_id"))
    members = written(classes(prints, parts, tau), "classes")
    roots = components(class_links(members, parts, tau))
    whole = members.join(roots.withColumnRenamed("node", "class"), "class", "left").select("fp", F.coalesce("root", "class").alias("root"))
    whole = written(whole.join(prints, "fp"), "rooted")
    least = whole.groupBy("root").agg(F.min("least").alias("component_id"))
    of = whole.join(least, "root").select("fp", "component_id")
    return rows.join(of, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, tau: int = 4, shingle: int = 4, seed: int = 42) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component, with all their columns.

    Of several rows with that id the one with the smallest text stays; rows without an id all stay.
    """
    found = near_duplicates(docs.select("doc_id", "text"), tau, shingle, seed)
    kept = found.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("rows"))
    kept = written(kept, "kept-ids")
    single, several = kept.where("rows = 1").select("doc_id"), kept.where("rows > 1").select("doc_id")
    # The ids grow with the documents: one plan at every size, and the texts aren't sorted.
    out = docs.join(single.hint("shuffle_hash"), "doc_id", "left_semi").unionByName(docs.where("doc_id is null"))
    if several.isEmpty():
        return out
    names = docs.columns
    again = docs.join(several, "doc_id", "left_semi").select("doc_id", F.struct(F.coalesce("text", F.lit("")).alias("by"), F.xxhash64(*names).alias("then"), F.struct(*(F.col(f"`{c}`") for c in names)).alias("row")).alias("r"))
    least = again.groupBy("doc_id").agg(F.min_by("r.row", F.struct("r.by", "r.then")).alias("row"))
    return out.unionByName(least.select(*(F.col(f"row.`{c}`").alias(c) for c in names)))


def digests(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
