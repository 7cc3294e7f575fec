"""Operator 11. A Merkle manifest of a table that stores every third level only and recomputes the levels between when proofs are asked for.

Every row is a leaf. Rows get their place in their tree from a range partitioning whose blocks are counted, so no task sees a whole tree.
A stored level is a table of aligned subtrees: 8^3 nodes at most under one node three levels up. Building folds a subtree to its top node
and stores only that for the next level. Proofs go down again from the root: each stored subtree meets the proof of its top node, its
missing interior nodes are computed again from its stored nodes, the siblings of every stored node are emitted, and the interior nodes
are forgotten with the row. Trees of different depths are built in the same passes; the subroots of all trees are the leaves of one more tree.

Defined results: nulls are `-` in a leaf, empty texts `0:`; a null id has the checksum of the empty text and comes first in its tree; a null
key is a tree of its own, before all others; rows with equal ids ascend by their leaves, and equal rows are neighbouring leaves, each with
its own proof; an empty table gives no rows; extra columns are ignored; texts of any length are hashed whole.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut_lineage, remainder

ARITY_BITS, STORED = 3, 3
ARITY = 1 << ARITY_BITS
SPAN = 1 << (ARITY_BITS * STORED)
#: Rows of a block of the range partitioning.
BLOCK = 1 << 17
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sha(value: Column) -> Column:
    return F.sha2(value, 256)


def leaf(*fields: Column) -> Column:
    """The digest of a row's fields: `-` for null, else the UTF-8 byte count, a colon and the value."""
    texts = [f.cast("string") for f in fields]
    return sha(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def depth(n: Column) -> Column:
    """Levels above n leaves."""
    return F.size(F.filter(F.array(*[F.lit(ARITY**k).cast("long") for k in range(21)]), lambda p: n > p))


def placed(rows: DataFrame) -> DataFrame:
    """rows (tree, order_1 ..., payload) with idx, the row's place in its tree in the order of all its other columns, and n, the tree's size."""
    rows = cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()))
    blocks = max(1, math.ceil(rows.count() / BLOCK))
    keys = [F.col(c) for c in rows.columns]
    rows = rows.repartitionByRange(blocks, *keys).sortWithinPartitions(*keys).drop("row").withColumn("at", F.monotonically_increasing_id())
    rows = cut_lineage(rows.withColumn("block", F.shiftright("at", 33)))
    sizes = rows.groupBy("tree", "block").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    before = Window.partitionBy("tree").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut_lineage(sizes.select("tree", "block", "first", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"), F.sum("rows").over(Window.partitionBy("tree")).alias("n")))
    return rows.join(sizes, ["tree", "block"]).withColumn("idx", F.col("offset") + F.col("at") - F.col("first")).drop("block", "at", "first", "offset")


def above(nodes: Column) -> Column:
    """The digests of runs of ARITY nodes."""
    return F.transform(F.sequence(F.lit(1), F.size(nodes), F.lit(ARITY)), lambda i: sha(F.array_join(F.slice(nodes, i, ARITY), "")))


def with_levels(groups: DataFrame) -> DataFrame:
    """Adds levels, the nodes of a subtree's level 0 to the one below its top, computed again from the stored ones, and its top node."""
    out = groups.withColumn("l0", F.transform("nodes", lambda x: x["h"]))
    for k in range(1, STORED + 1):
        out = out.withColumn(f"l{k}", F.when(F.col("steps") >= k, above(F.col(f"l{k - 1}"))).otherwise(F.col(f"l{k - 1}")))
    return out.withColumn("levels", F.array(*[f"l{k}" for k in range(STORED)])).withColumn("top", F.col(f"l{STORED}")[0]).drop(*[f"l{k}" for k in range(STORED + 1)])


@dataclass
class Forest:
    """Stored levels of all trees, lowest first, and the top node of each tree."""

    stored: list[DataFrame]
    tops: DataFrame


def grow(leaves: DataFrame) -> Forest:
    """leaves: tree, idx, n, h and payload. Stores a level's subtrees (tree, idx, depth, steps, nodes), then the next level of their tops."""
    payload = [c for c in leaves.columns if c not in ("tree", "idx", "n")]
    nodes, stored, tops = leaves.withColumn("depth", depth(F.col("n"))).withColumnRenamed("n", "size"), [], []
    deepest = None
    for level in range(0, 64, STORED):
        members = F.sort_array(F.collect_list(F.struct("idx", *payload))).alias("nodes")
        groups = nodes.groupBy("tree", F.expr(f"idx div {SPAN}").alias("grp"), "depth").agg(members)
        groups = cut_lineage(groups.select("tree", F.col("grp").alias("idx"), "depth", F.least(F.lit(STORED), F.col("depth") - level).alias("steps"), "nodes"))
        stored.append(groups)
        deepest = groups.agg(F.max("depth")).first()[0] if deepest is None else deepest
        folded = with_levels(groups).select("tree", "idx", "depth", F.col("top").alias("h"))
        tops.append(folded.where(F.col("depth") <= level + STORED).select("tree", "depth", "h"))
        if deepest is None or deepest <= level + STORED:
            break
        nodes, payload = folded.where(F.col("depth") > level + STORED), ["h"]
    out = tops[0]
    for more in tops[1:]:
        out = out.union(more)
    return Forest(stored, cut_lineage(out))


def siblings(levels: Column, steps: Column, i: Column) -> Column:
    """Per level the siblings left and right of the node over stored node i, concatenated."""

    def at(j: Column) -> Column:
        level, pos = levels[j], F.call_function("shiftright", i, j * ARITY_BITS)
        k = pos % ARITY
        return F.struct(F.array_join(F.slice(level, pos - k + 1, k), "").alias("left"), F.array_join(F.slice(level, pos + 2, ARITY - 1 - k), "").alias("right"))

    every = F.array(*[at(F.lit(j)) for j in range(STORED)])
    return F.slice(every, 1, steps)


def proofs(forest: Forest, tops: DataFrame) -> DataFrame:
    """Rows of the leaves with tree, path (from the leaf up) and the columns that tops (tree, depth, path, ...) has for each tree."""
    carried = [c for c in tops.columns if c not in ("tree", "depth", "path")]
    upper = None
    for k in reversed(range(len(forest.stored))):
        level = STORED * k
        own = tops.where((F.col("depth") <= level + STORED) & (F.col("depth") > (level if k else -1))).select("tree", F.lit(0).cast("long").alias("idx"), "path", *carried)
        upper = own if upper is None else upper.select(own.columns).union(own)
        met = with_levels(forest.stored[k].join(upper, ["tree", "idx"]))
        each = F.transform("nodes", lambda x, i: F.struct(x.alias("node"), F.concat(siblings(F.col("levels"), F.col("steps"), i), F.col("path")).alias("path")))
        met = met.select("tree", *carried, F.explode(each).alias("x")).select("tree", *carried, "x.node.*", "x.path")
        upper = cut_lineage(met) if k else met
    return upper.drop("idx")


def fold(path: Column, node: Column) -> Column:
    """The root that a proof gives for a leaf."""
    return F.aggregate(path, node, lambda h, s: sha(F.concat(s["left"], h, s["right"])))


def proven(docs: DataFrame, received: dict[str, Column] | None = None, fields: tuple[str, ...] = FIELDS, key: str = "lang", order: str = "doc_id") -> DataFrame:
    """Per row of docs: the order column, leaf, seen (the leaf of the row as received: fields may be replaced by expressions), subroot, root and path."""
    kept = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys((*fields, key, order))])
    columns = {c: F.col(f"`{c}`") for c in fields}
    tree = F.coalesce(F.concat(F.lit("+"), F.col(f"`{key}`").cast("string")), F.lit("")).alias("tree")
    leaves = kept.select(tree, F.col(f"`{order}`").alias("id"), leaf(*columns.values()).alias("h"), leaf(*(columns | (received or {})).values()).alias("seen"))
    lower = grow(placed(leaves))
    upper = grow(placed(lower.tops.select(F.lit("").alias("tree"), F.col("tree").alias("id"), "h")))
    roots = proofs(upper, upper.tops.select("tree", "depth", F.expr("cast(array() as array<struct<left:string,right:string>>)").alias("path"), F.col("h").alias("root")))
    tops = cut_lineage(lower.tops.join(roots.select(F.col("id").alias("tree"), "path", "root"), "tree").withColumnRenamed("h", "subroot"))
    return proofs(lower, tops).select(F.col("id").alias(order), F.col("h").alias("leaf"), "seen", "subroot", "root", "path")


def manifest(docs: DataFrame) -> DataFrame:
    """The contract's columns: every document's proof against a copy in which every third document (by the checksum of its id) has its capitals lowered."""
    lowered = F.when(remainder(F.col("doc_id"), 3) == 0, F.translate(F.col("text"), UPPER, LOWER)).otherwise(F.col("text"))
    rows = proven(docs, {"text": lowered}).withColumn("folded_root", fold(F.col("path"), F.col("seen")))
    proof = sha(F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), ""))
    return rows.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
