"""Merkle dataset manifest: every row's digest, its proof up to one root, and the check of a proof.

The digest H of some texts is the SHA-256 of their concatenation, in lowercase hex.  A row's leaf is H of
its fields, each ``-`` where null, else its UTF-8 bytes' number, ``:``, and its value.  A group's leaves stand
in order; while several nodes remain, every ``WIDTH`` consecutive ones become their H (the last run may be
shorter).  What remains is the group's subroot; the subroots, in order of their group (null first, by
bytes), become the root the same way.

Method: a leaf's rank is written in digits of base ``WIDTH``.  Within blocks of ``WIDTH ** DEPTH`` leaves the digit
columns are grouped away one after the other, each ``groupBy`` nesting the structs of its children; all of
them keep a block's partitioning, so a block is shuffled once.  A proof is read off the nested block by
transforming each node's children into (child, what stands beside it) and exploding them, level by level,
without a join.  A key of more than one block goes on with the blocks' nodes as the leaves of the next tier, and
one row a block brings the path above it back down; so no row holds more than a block, however large a
group is, and groups with a third of all rows are many blocks.

Rows: null fields are ``-``, and null ids come first; rows with equal ids stand in order of their leaves,
and of equal rows each has its own leaf and proof.  Empty tables have no root and give no rows.  Columns
other than the named ones aren't read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltrail.llm.places import ranked
from voltrail.llm.store import written

#: Nodes of a run, and levels of runs within a block (729 leaves).
WIDTH, DEPTH = 3, 6
BLOCK = WIDTH ** DEPTH
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: (left, right): the digests beside a node, as one text before and one after its own.
PATH = "array<struct<left: string, right: string>>"


def text_of(node: Column) -> Column:
    """A digest as lowercase hex."""
    return F.lower(F.hex(node))


def digest(text: Column) -> Column:
    """H, as 32 bytes."""
    return F.unhex(F.sha2(text, 256))


def leaf(values: list[Column]) -> Column:
    """The digest of a row's fields."""
    def one(c: Column) -> Column:
        c = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return digest(F.concat(*[one(c) for c in values]))


def blocks(nodes: DataFrame) -> DataFrame:
    """(key, n, block, tree) of nodes (key, n, rank, node, row): each block as one nested struct.

    A level that has a single node of its key (n <= WIDTH ** level) is the top already, and its node stays."""
    digits = [F.expr(f"int(rank div {WIDTH ** j} % {WIDTH})").alias(f"d{j}") for j in range(DEPTH)]
    flat = nodes.select("key", "n", F.expr(f"rank div {BLOCK}").alias("block"), *digits, F.struct("node", "row").alias("tree")).repartition("key", "block")
    for j in range(DEPTH):
        kids = F.sort_array(F.collect_list(F.struct(F.col(f"d{j}").alias("digit"), "tree"))).alias("kids")
        flat = flat.groupBy("key", "n", "block", *[f"d{i}" for i in range(j + 1, DEPTH)]).agg(kids)
        joined = digest(F.array_join(F.transform("kids", lambda k: text_of(k["tree"]["node"])), ""))
        node = F.when(F.col("n") <= WIDTH ** j, F.col("kids")[0]["tree"]["node"]).otherwise(joined)
        flat = flat.select("key", "n", "block", *[f"d{i}" for i in range(j + 1, DEPTH)], F.struct(node.alias("node"), "kids").alias("tree"))
    return flat


def children(level: int) -> Column:
    """Each child of a node of level + 1: its tree, and its path with what stands left and right of it at the front."""
    kids = F.col("tree.kids")

    def texts(some: Column) -> Column:
        return F.array_join(F.transform(some, lambda k: text_of(k["tree"]["node"])), "")

    def one(k: Column, i: Column) -> Column:
        step = F.struct(texts(F.slice(kids, F.lit(1), i)).alias("left"), texts(F.slice(kids, i + 2, F.lit(WIDTH))).alias("right"))
        path = F.when(F.col("n") <= WIDTH ** level, F.col("path")).otherwise(F.concat(F.array(step), F.col("path")))
        return F.struct(k["tree"].alias("tree"), path.alias("path"))
    return F.transform(kids, one)


def unnested(trees: DataFrame) -> DataFrame:
    """(key, subroot, root, path, node, row) of every leaf of blocks with the path above them."""
    for j in reversed(range(DEPTH)):
        trees = trees.select("key", "n", "subroot", "root", F.inline(children(j)))
    return trees.select("key", "subroot", "root", "path", "tree.*")


def proofs(leaves: DataFrame, over: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(key, subroot, root, path, node, row) of leaves (key, n, rank, node, row).

    ``over`` is given the top of every key (key, node, tier) and says what lies above it: (key, tier,
    path, subroot, root)."""
    tiers, tops, nodes = [], None, leaves
    while True:
        trees = written(blocks(nodes), "merkle-blocks")
        done = trees.where(F.col("n") <= BLOCK).select("key", "tree.node", F.lit(len(tiers)).alias("tier"))
        tops = done if tops is None else tops.unionByName(done)
        tiers.append(trees)
        more = trees.where(F.col("n") > BLOCK)
        if more.isEmpty():
            break
        rank = F.col("block").alias("rank")
        nodes = more.select("key", F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"), rank, "tree.node", F.struct(rank).alias("row"))
    reach, lower = over(tops), None
    for tier in reversed(range(len(tiers))):
        above = reach.where(F.col("tier") == tier).select("key", F.lit(0).cast("bigint").alias("block"), "path", "subroot", "root")
        if lower is not None:
            above = above.unionByName(lower.select("key", F.col("row.rank").alias("block"), "path", "subroot", "root"))
        lower = unnested(tiers[tier].join(above, ["key", "block"]))
    return lower.select("key", "subroot", "root", "path", "node", "row")


def over_groups(tops: DataFrame) -> DataFrame:
    """What lies above each group's top: the tree of all groups, which is one key of its own."""
    nodes = ranked(tops.select(F.lit("").alias("all"), "key", "node", "tier"), "all", ["key"])
    nodes = nodes.select(F.col("all").alias("key"), "n", "rank", "node", F.struct("key", "tier", F.col("node").alias("subroot")).alias("row"))
    found = proofs(nodes, lambda top: top.select("key", "tier", F.array().cast(PATH).alias("path"), F.col("node").alias("subroot"), F.col("node").alias("root")))
    return found.select("row.key", "row.tier", "path", "row.subroot", "root")


def manifest(rows: DataFrame, group: str, order: str, node: Column, carry: list[Column]) -> DataFrame:
    """(carried columns, leaf, subroot, root, path) of every row: its leaf, and what to hash it with, step by step, to the root.

    ``node`` is a row's digest, ``group`` a text column, ``order`` what its leaves ascend by."""
    key = F.coalesce(F.concat(F.lit("1"), F.col(group)), F.lit("0"))  # null first
    table = rows.select(key.alias("key"), F.col(order).alias("by"), node.alias("node"), F.struct(*carry).alias("row"))
    table = ranked(written(table, "merkle-leaves"), "key", ["by", "node"])
    found = proofs(table.select("key", "n", "rank", "node", "row"), over_groups)
    return found.select("row.*", F.col("node").alias("leaf"), "subroot", "root", "path")


def folded(node: Column, path: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(path, node, lambda n, step: digest(F.concat(step["left"], text_of(n), step["right"])))


def proof_digest(path: Column) -> Column:
    """H of all siblings from the leaf's run to the root's, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def digests(docs: DataFrame) -> DataFrame:
    """Every document's leaf and proof, and whether its text, tampered with where crc32(doc_id) is even, still leads to the root."""
    def leaf_with(text: Column) -> Column:
        return leaf([*[F.col(c) for c in FIELDS[:-1]], text])
    text = F.col("text")
    hit = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & text.contains("\n")
    changed = F.when(hit, leaf_with(F.replace(text, F.lit("\n"), F.lit(""))))  # null: as it was
    found = manifest(docs.select(*FIELDS), "source", "doc_id", leaf_with(text), [F.col("doc_id"), changed.alias("changed")])
    end = folded(F.coalesce("changed", "leaf"), F.col("path"))
    out = found.select("doc_id", text_of(F.col("leaf")).alias("leaf"), text_of(F.col("subroot")).alias("subroot"), text_of(F.col("root")).alias("root"),
                       proof_digest(F.col("path")).alias("proof_sha256"), text_of(end).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
