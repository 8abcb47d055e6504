"""Mixing sources to target weights: which words of which documents a training mix takes, and when.

A document's size is its number of words ``[^\\x20\\x09-\\x0D]+``.  Sources share all words by weight, but no target
exceeds ``MOST`` times its source's words; what is cut is shared again by weight until no target is above.

Method: a low-discrepancy schedule.  A source's documents are shuffled (by a digest of their id) and laid end to
end, again and again; this stream is cut into blocks of equally many words, of which the source needs
target / block words, the last one shorter, so what it takes is its target rounded to whole words.  The schedule's
points are the van der Corput points of as many bits as the blocks need: point x of the sources' cumulative
numbers of blocks comes at the time that x's bits give backwards, so any stretch of the schedule holds
about its share of every source.  A source's slots are ranked by time, and the r-th takes the r-th block.  Only DataFrame
functions are used.

Scale: a source's shuffled order and running sums come from ``places`` (no task holds a source); the slots, one a block
of words, are exploded from one row per source in steps of bounded size; slots and the documents' pieces join on
(source, r), so a source with a third of all words is spread over its blocks.  Target shares are a few
sums over one row per source a round.

Rows: null text has no words; rows without words take none; a null source comes last and has its own target; rows
that are equal in id and size are interchangeable, and each takes its own part.  Empty tables, or tables
without any word, give targets of 0.  Other columns aren't read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltrail.llm.places import ranked, running
from voltrail.llm.store import written

#: Weights of the sources in the order of their names, again and again; how often a word may be taken.
WEIGHTS, MOST = (5, 2, 1), 3
#: Words of a block, and the most blocks of a schedule (with more words, blocks grow).
BLOCK_WORDS, MOST_BLOCKS = 512, 1 << 34
#: Slots exploded from one row.
STRETCH = 4096
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """``sources`` (source_size, weight, ..) with ``target``: the words that each source gives to the mix.

    Each round shares what the sources at their limit leave by the weights of the others; the limits reached
    only grow, so it ends when a round adds none."""
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    limit, wide = F.col("source_size") * most, "decimal(19,0)"
    above, before = F.lit(False), -1
    while True:
        held, open_weight, n = sources.agg(F.sum(F.when(above, limit)), F.sum(F.when(~above, F.col("weight"))), F.count(F.when(above, 1))).first()
        rest, weight = total - (held or 0), open_weight
        if n == before or not weight:
            break
        before = n
        above = F.col("weight").cast(wide) * F.lit(rest).cast(wide) > limit.cast(wide) * F.lit(weight).cast(wide)
    share = F.col("weight") * F.lit(float(rest)) / F.lit(float(weight or 1))
    return sources.withColumn("target", F.when(above, limit.cast("double")).otherwise(share))


def schedule(sources: DataFrame, bits: int) -> DataFrame:
    """(key, r, at): the time of each source's r-th slot; ``sources`` has ``first`` and ``blocks``, its points of the cumulative weights."""
    upto = F.col("first") + F.col("blocks") - 1
    steps = sources.where("blocks > 0").select("key", upto.alias("last"), F.explode(F.sequence(F.col("first"), upto, F.lit(STRETCH).cast("bigint"))).alias("from"))
    points = steps.repartition("key", "from").select("key", F.explode(F.sequence("from", F.least(F.col("last"), F.col("from") + STRETCH - 1))).alias("x"))
    backwards = F.conv(F.reverse(F.lpad(F.bin("x"), bits, "0")), 2, 10).cast("bigint")
    return ranked(points.select("key", backwards.alias("at")), "key", ["at"]).select("key", F.col("rank").alias("r"), "at")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """The placed documents and the mix.

    Documents: (key, source, doc_id, size, rank, before, source_size, target).  The mix: (key, rank, doc_id, at, turn, start, words):
    at time ``at`` the words start .. start + words of a document, in its ``turn``-th pass."""
    key = F.coalesce(F.concat(F.lit("0"), F.col("source")), F.lit("1"))  # null last
    sized = written(docs.select("doc_id", "source", key.alias("key"), n_words(F.col("text")).alias("size")), "mix-sizes")
    by_source = ranked(sized.groupBy("key").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows")).withColumn("all", F.lit("")), "all", ["key"])
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = written(targets(written(by_source.withColumn("weight", weight), "mix-sources"), most), "mix-targets")
    words, n, rows = sources.agg(F.sum("source_size"), F.count("*"), F.max("rows")).first()
    block = max(block_words, -(-(words or 0) // MOST_BLOCKS))
    sources = sources.withColumn("quota", F.round("target").cast("bigint")).withColumn("blocks", F.expr(f"(quota + {block - 1}) div {block}"))
    sources = written(running(sources, "all", "blocks", n).withColumnRenamed("before", "first"), "mix-points")
    points = sources.agg(F.sum("blocks")).first()[0] or 0
    slots = schedule(sources, max(1, (points - 1).bit_length() if points else 1))
    order = F.md5(F.col("doc_id").cast("string"))  # shuffled, the same in every run
    placed = running(ranked(sized, "key", [order, "doc_id", "size"]).drop("n"), "key", "size", rows or 0)
    placed = written(placed.join(sources.select("key", "source_size", "target", "quota"), "key"), "mix-placed")
    turns = placed.where("size > 0").select("*", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("turn"))
    begin = F.col("turn") * F.col("source_size") + F.col("before")
    turns = turns.withColumn("begin", begin).withColumn("end", F.least(F.col("begin") + F.col("size"), "quota")).where("begin < end")
    pieces = turns.select("key", "rank", "doc_id", "turn", "begin", "end", F.explode(F.expr(f"sequence(begin div {block}, (end - 1) div {block})")).alias("r"))
    start, stop = F.greatest(F.col("begin"), F.col("r") * block), F.least(F.col("end"), (F.col("r") + 1) * block)
    pieces = pieces.select("key", "rank", "doc_id", "turn", "r", (start - F.col("begin")).alias("start"), (stop - start).alias("words"))
    return placed, pieces.join(slots, ["key", "r"]).select("key", "rank", "doc_id", "at", "turn", "start", "words")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken (words in the mix, repeats counted) of every row."""
    placed, mixed = mix(docs)
    none = placed.select("key", "rank", "doc_id", "size", "source_size", "target", F.lit(0).cast("bigint").alias("words"))
    both = none.unionByName(mixed.select("key", "rank", "doc_id", "words"), allowMissingColumns=True)
    out = both.groupBy("key", "rank").agg(F.max("doc_id").alias("doc_id"), F.max("size").alias("size"), F.max("source_size").alias("source_size"),
                                          F.max("target").alias("target"), F.sum("words").alias("taken"))
    return out.select("doc_id", "size", "source_size", "target", "taken")
