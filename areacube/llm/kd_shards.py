"""Sharding by a k-d tree over the documents' metadata.

Every row is a point; its coordinates are metadata columns (text columns by
the hash of their value, numeric ones scaled to the range of the table) and its
weight is the bytes of its text plus one.  A node that is to give k shards is
cut along its widest coordinate at the weighted quantile floor(k/2) / k (the
weighted median for even k), until every leaf is one shard of the target size.

The cut is found by distributed histograms: an aggregate of the weights by
(node, bin) with partial sums in every task, a running sum over a node's bins
(at most ``BINS`` rows), and another look into the bin that holds the quantile.  All
nodes of a level are cut together; the driver sees one row per node.  Rows of
equal coordinate are ordered by a hash of their id and text, and rows equal in
all of that by their place in the input, so a source (or a repeated row) that
holds a third of all bytes is cut like anything else.

Slots number the rows of a shard from 0 without gaps: rows are counted by
(shard, block of some thousand rows), the blocks' offsets are running sums,
and a row number inside the block is added.  No task sees a whole shard.

Only DataFrame functions are used; the text is read once, all passes after
that read a narrow table in the shared folder.

Cases: a null text has no bytes (size 1, crc 0), an empty one too.  Null or
non-finite coordinates lie at place 0 (a null text column at a place of its
own); null ids are rows like others.  Repeated rows are all kept, each with a slot.
Fewer rows than shards leave shards empty; an empty table gives no
rows.  Extra columns are ignored, whatever their names; coordinates that the
table lacks are left out, and without any the hash alone decides.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch

DIMS = ("lang", "source", "n_chars")
#: Bins of one look at a node.
BINS = 4096
#: Bits of a coordinate, of the hash of id and text, and of the row's own hash: 63 in all.
PLACE_BITS, CONTENT_BITS, ROW_BITS = 24, 27, 12
TIE_BITS = CONTENT_BITS + ROW_BITS
#: A cut is good when it misses its share of the node by so little.
CLOSE = 1e-5
#: Rows of one block of slot numbers, about.
BLOCK_ROWS = 8192


@dataclass
class Node:
    """A node of the tree: the shards it gives, and its cut once that is known."""
    leaves: int
    shard: int                                  # its first shard
    total: int = 0
    dim: int = -1                               # -1: a leaf
    cut: int = 0                                # keys up to the cut go left
    left: int = 0                               # the right child is the next one
    lo: int = 0                                 # keys still looked at, weight below them
    hi: int = 0
    below: int = 0
    open: bool = False

    def wanted(self) -> float:
        return self.total * (self.leaves // 2) / self.leaves


@dataclass
class Tree:
    nodes: list[Node] = field(default_factory=list)

    def column(self, name: str, kind: str = "array<bigint>") -> Column:
        """One attribute of all nodes, as a literal array (its size follows the number of shards)."""
        return F.split(F.lit(",".join(str(int(getattr(n, name))) for n in self.nodes)), ",").cast(kind)

    def place(self, keys: list[Column], depth: int) -> Column:
        """The node that a row reaches after ``depth`` steps from the root."""
        if not depth:
            return F.lit(0).cast("bigint")
        dim, cut, left = (self.column(c) for c in ("dim", "cut", "left"))
        own = F.array(*keys)
        return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0).cast("bigint"), lambda node, _: F.when(F.get(dim, node) < 0, node).otherwise(
            F.get(left, node) + (F.get(own, F.get(dim, node)) > F.get(cut, node)).cast("bigint")))


def points(docs: DataFrame, dims: tuple[str, ...]) -> DataFrame:
    """doc_id, size, text_crc32, tie and one column p0, p1, ... per coordinate (long: a place; double: not scaled yet)."""
    content = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << CONTENT_BITS))
    row = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << ROW_BITS))
    places = []
    for k, c in enumerate(dims):
        if isinstance(docs.schema[c].dataType, T.NumericType):
            x = F.col(c).cast("double")
            places.append(F.when(F.abs(x) < float("inf"), x).alias(f"p{k}"))
        else:
            places.append(F.pmod(F.xxhash64(F.col(c).cast("string")), F.lit(1 << PLACE_BITS)).alias(f"p{k}"))
    return docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
                       F.coalesce(F.crc32("text"), F.lit(0)).cast("bigint").alias("text_crc32"),
                       (content * (1 << ROW_BITS) + row).alias("tie"), *places)


def scaled(rows: DataFrame, names: list[str]) -> DataFrame:
    """Numeric coordinates as places between the least and the greatest value of the table."""
    numeric = [c for c in names if isinstance(rows.schema[c].dataType, T.DoubleType)]
    if not numeric:
        return rows
    found = rows.agg(*[f(c) for c in numeric for f in (F.min, F.max)]).first()
    top, new = (1 << PLACE_BITS) - 1, {}
    for k, c in enumerate(numeric):
        lo, hi = found[2 * k] or 0.0, found[2 * k + 1] or 0.0
        share = (F.col(c) / 2 - lo / 2) / (hi / 2 - lo / 2) if hi > lo else F.lit(0.0)        # halves: no overflow
        new[c] = F.coalesce(F.floor(share * top), F.lit(0)).cast("bigint")
    return rows.withColumns(new)


def _extents(rows: DataFrame, names: list[str]) -> list:
    """One row per node: its number, weight, and the least and greatest place of each coordinate."""
    return rows.groupBy("node").agg(F.sum("size").alias("total"), *[f(c).alias(f"{c}_{f.__name__}") for c in names for f in (F.min, F.max)]).collect()


def _look(rows: DataFrame, tree: Tree, keys: list[Column]) -> list:
    """For every open node the bin that holds its quantile: weight before and up to it, least and greatest key in it."""
    at = lambda name: F.get(tree.column(name), F.col("node"))
    key = F.get(F.array(*keys), at("dim"))
    step = F.floor((at("hi") - at("lo")) / BINS) + 1
    inside = (rows.where(at("open") == 1).select("node", "size", key.alias("key"), at("lo").alias("lo"), at("hi").alias("hi"), step.alias("step"))
              .where("key between lo and hi"))
    bins = inside.groupBy("node", F.expr("(key - lo) div step").alias("bin")).agg(
        F.sum("size").alias("w"), F.min("key").alias("least"), F.max("key").alias("greatest"))
    upto = F.sum("w").over(Window.partitionBy("node").orderBy("bin"))
    missing = F.get(F.split(F.lit(",".join(repr(n.wanted() - n.below) for n in tree.nodes)), ",").cast("array<double>"), F.col("node"))
    return (bins.withColumn("upto", upto).where((F.col("upto") >= missing) & (F.col("upto") - F.col("w") < missing))
            .select("node", "upto", "w", "least", "greatest").collect())


def _cut_level(rows: DataFrame, tree: Tree, keys: list[Column], names: list[str], width: dict[str, int]) -> None:
    """Cuts every node that is to give more than one shard and has rows."""
    for r in _extents(rows, names):
        n = tree.nodes[r["node"]]
        n.total = r["total"]
        if n.leaves > 1:
            spread = [(r[f"{c}_max"] - r[f"{c}_min"]) / max(width[c], 1) for c in names]
            n.dim = spread.index(max(spread))
            n.lo = r[f"{names[n.dim]}_min"] << TIE_BITS
            n.hi = (r[f"{names[n.dim]}_max"] + 1 << TIE_BITS) - 1
            n.below, n.open = 0, True
    while any(n.open for n in tree.nodes):
        found = {r["node"]: r for r in _look(rows, tree, keys)}
        for k, n in enumerate(tree.nodes):
            if not n.open:
                continue
            r = found[k]
            short, over = n.wanted() - (n.below + r["upto"] - r["w"]), n.below + r["upto"] - n.wanted()
            if r["least"] == r["greatest"] or min(short, over) <= CLOSE * n.total:
                n.cut, n.open = (r["least"] - 1 if short < over else r["greatest"]), False
            else:
                n.below, n.lo, n.hi = n.below + r["upto"] - r["w"], r["least"], r["greatest"]


def grown(rows: DataFrame, names: list[str], shards: int) -> tuple[Tree, list[Column], int]:
    """The tree, the key of each coordinate and the tree's depth."""
    keys = [F.col(c) * (1 << TIE_BITS) + F.col("tie") for c in names]
    tree, depth, width = Tree([Node(shards, 0)]), 0, {}
    while True:
        at = rows.withColumn("node", tree.place(keys, depth))
        if not depth:
            whole = rows.agg(*[f(c) for c in names for f in (F.min, F.max)]).first()
            width = {c: (whole[2 * k + 1] or 0) - (whole[2 * k] or 0) for k, c in enumerate(names)}
        before = len(tree.nodes)
        _cut_level(at.where(F.get(tree.column("dim"), F.col("node")) < 0), tree, keys, names, width)
        for n in tree.nodes[:before]:
            if n.dim >= 0 and not n.left:
                n.left = len(tree.nodes)
                half = n.leaves // 2
                tree.nodes += [Node(half, n.shard), Node(n.leaves - half, n.shard + half)]
        if len(tree.nodes) == before:
            return tree, keys, depth
        depth += 1


def numbered(rows: DataFrame, blocks: int) -> DataFrame:
    """Adds ``slot``: the rows of a shard from 0, without gaps."""
    rows = rows.withColumn("block", F.pmod(F.xxhash64("tie"), F.lit(blocks)))
    counts = rows.groupBy("shard", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = F.row_number().over(Window.partitionBy("shard", "block").orderBy("doc_id", "tie"))
    return rows.withColumn("inside", inside).join(offsets, ["shard", "block"]).withColumn("slot", F.col("first") + F.col("inside") - 1)


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, dims: tuple[str, ...] = DIMS) -> DataFrame:
    """doc_id, size, text_crc32, shard (int), slot of every row of ``docs(doc_id, text, *dims)``.

    So many ``shards``, or as many as give about ``target_bytes`` each."""
    if (shards is None) == (target_bytes is None) or (shards or target_bytes) < 1:
        raise ValueError("name the number of shards or the target size of one, at least 1")
    dims = tuple(c for c in dims if c in docs.columns)
    scratch = Scratch(docs.sparkSession, "kd-shards")
    rows = scratch.written(points(docs, dims), "points")
    names = [f"p{k}" for k in range(len(dims))]
    rows = scaled(rows, names)
    if not names:
        names, rows = ["p0"], rows.withColumn("p0", F.lit(0).cast("bigint"))
    count, size = rows.agg(F.count("*"), F.sum("size")).first()
    if shards is None:
        shards = max(1, -(-(size or 0) // target_bytes))
    tree, keys, depth = grown(rows, names, shards)
    placed = rows.withColumn("shard", F.get(tree.column("shard"), tree.place(keys, depth)).cast("int"))
    out = numbered(placed, max(1, -(-count // (shards * BLOCK_ROWS))))
    return scratch.result(out.select("doc_id", "size", "text_crc32", "shard", "slot"))


def digest(sharded: DataFrame) -> DataFrame:
    """The contract's columns: sizes are near equal, no shard count but this one is served."""
    return sharded.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
