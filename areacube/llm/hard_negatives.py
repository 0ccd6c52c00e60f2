"""Hard-negative mining by slot-decomposed selection.

For each anchor the best rows of its own label are its positives; a positive
of score p asks for the best rows of other labels with scores in the window
low * p <= of * score <= of * p.  The windows of one anchor overlap.  Their upper limits (the
distinct scores of the positives, descending) split all scores into disjoint
slots: slot s holds the scores up to limit s and above limit s + 1.
A combiner keeps the best k rows of every slot in every block of rows, the
blocks' lists are merged per slot, and merging the slots from the lowest up (a
descending suffix: slot s followed by what the slots below it give, cut at k) yields for
every limit the best k rows below it.  Rows under a window's lower limit are the
last ones of such a list, so cutting them off leaves the window's best k.

Scores are integer inner products of floor(scale * x).  Anchors (a stated
query set) meet all rows in blocks: anchors and rows are dealt into blocks of
bounded bytes, and each pair of blocks is one group of a cogroup, computed in
numpy tiles.  Only the best k of a block leave it, so no label, hot or not,
gathers anywhere.  Products that doubles cannot hold exactly are computed in
whole numbers of any length; scores beyond a long stand at its limit.

Cases: rows with a null id, a null label, a null vector or a null or non-finite component take
no part.  Equal rows (id, label, vector) count once.  Rows of one id and different content are rows
of their own, also as anchors, but never each other's positives or negatives; ties
of score go by smaller id, then by content.  Vectors of different length do not meet.
Anchors without a positive, and positives without a negative in their
window, give no rows.  An empty table gives none.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

#: Bytes of the vectors of one block.
ROW_BYTES, ANCHOR_BYTES = 4 << 20, 8 << 20
#: One numpy step: anchors by rows.
TILE_ANCHORS, TILE_ROWS = 256, 8192
SCALE = 256
LONG = np.iinfo(np.int64)


def prepared(vectors: DataFrame, anchor: Column, scale: int) -> DataFrame:
    """vec_id, label (text), vector (longs), anchor, key (a hash of the whole row) of the distinct rows that take part."""
    x = F.col("embedding")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & ~odd).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.transform(x, lambda v: F.floor(v.cast("double") * scale)).alias("vector"), F.coalesce(anchor, F.lit(False)).alias("anchor")).distinct()
    return rows.withColumn("key", F.xxhash64("vec_id", "label", "vector"))


# ---- one pair of blocks ---------------------------------------------------

class Block:
    """The rows of a block in order of id and key."""

    def __init__(self, table: pa.Table):
        table = table.sort_by([("vec_id", "ascending"), ("key", "ascending")])
        self.id, self.key = (table.column(c).to_numpy() for c in ("vec_id", "key"))
        self.label = np.array(table.column("label").to_pylist(), object)
        vector = table.column("vector").combine_chunks()
        if isinstance(vector, pa.ChunkedArray):
            vector = vector.chunk(0)
        self.length = vector.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.values = vector.flatten().to_numpy(zero_copy_only=False)
        self.at = np.cumsum(self.length) - self.length
        self.limits = table.column("limits").to_pylist() if "limits" in table.column_names else None

    def matrix(self, rows: np.ndarray) -> np.ndarray:
        """Rows of one length as a matrix."""
        d = int(self.length[rows[0]])
        return self.values[self.at[rows][:, None] + np.arange(d)]


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of two matrices of longs, exact; beyond a long: its limit."""
    small = int(np.sqrt(2.0 ** 49 / max(1, a.shape[1])))
    fits = [((x <= small) & (x >= -small)).all(1) for x in (a, b)]
    if fits[0].all() and fits[1].all():
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    out = np.zeros((len(a), len(b)), np.int64)
    if fits[0].any() and fits[1].any():
        out[np.ix_(fits[0], fits[1])] = (a[fits[0]].astype(float) @ b[fits[1]].T.astype(float)).astype(np.int64)
    for i, j in ((~fits[0], np.ones(len(b), bool)), (fits[0], ~fits[1])):
        if i.any() and j.any():
            whole = a[i].astype(object) @ b[j].T.astype(object)
            out[np.ix_(i, j)] = np.clip(whole, LONG.min, LONG.max).astype(np.int64)
    return out


def best(score: np.ndarray, fit: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the best k fitting scores of each row; of equal scores the earlier columns."""
    n = score.shape[1]
    if np.abs(np.maximum(score, -LONG.max)).max(initial=0) < 1 << 49:          # one key holds score and column
        key = np.where(fit, (score << 13) + (TILE_ROWS - 1 - np.arange(n)), LONG.min)
        at = np.argpartition(key, n - k, axis=1)[:, n - k:] if n > k else np.broadcast_to(np.arange(n), score.shape)
        row = np.repeat(np.arange(len(score)), at.shape[1])
        column = at.ravel()
        keep = fit[row, column]
        return row[keep], column[keep]
    rows, columns = [], []
    for i in range(len(score)):
        own = np.flatnonzero(fit[i])
        own = own[np.argsort(~score[i, own], kind="stable")[:k]]                # ~: descending without overflow
        rows.append(np.full(len(own), i))
        columns.append(own)
    return np.concatenate(rows), np.concatenate(columns)


def _tiles(rows: Block, anchors: Block, of_rows: np.ndarray, of_anchors: np.ndarray):
    """Scores of rows and anchors of equal vector length: (anchors, rows, scores)."""
    for d in np.intersect1d(rows.length[of_rows], anchors.length[of_anchors]):
        r, a = of_rows[rows.length[of_rows] == d], of_anchors[anchors.length[of_anchors] == d]
        for i in range(0, len(r), TILE_ROWS):
            right = rows.matrix(r[i: i + TILE_ROWS])
            for j in range(0, len(a), TILE_ANCHORS):
                yield a[j: j + TILE_ANCHORS], r[i: i + TILE_ROWS], inner(anchors.matrix(a[j: j + TILE_ANCHORS]), right)


def _table(rows: Block, anchors: Block, found: list, k: int) -> pa.Table:
    """The best k of each (anchor, slot) among the tiles' best."""
    a, s, r, x = (np.concatenate([np.asarray(f[c], np.int64) for f in found]) if found else np.zeros(0, np.int64) for c in range(4))
    order = np.lexsort((r, ~x, s, a))
    a, s, r, x = a[order], s[order], r[order], x[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (s[1:] != s[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))
    keep = np.arange(len(a)) - first < k
    a, s, r, x = a[keep], s[keep], r[keep], x[keep]
    return pa.table({"anchor_id": anchors.id[a], "anchor_key": anchors.key[a], "slot": s.astype(np.int32), "vec_id": rows.id[r], "key": rows.key[r], "score": x})


def _same_label(k: int):
    """The best k rows of each anchor's own label."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, anchors, found = Block(left), Block(right), []
        for label in set(anchors.label) & set(rows.label):
            for a, r, score in _tiles(rows, anchors, np.flatnonzero(rows.label == label), np.flatnonzero(anchors.label == label)):
                i, j = best(score, rows.id[r][None, :] != anchors.id[a][:, None], k)
                found.append((a[i], np.zeros(len(i)), r[j], score[i, j]))
        return _table(rows, anchors, found, k)
    return run


def _other_labels(k: int):
    """The best k rows of other labels in every slot of each anchor."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, anchors, found = Block(left), Block(right), []
        number = {x: i for i, x in enumerate(sorted({*rows.label, *anchors.label}))}
        row_label, anchor_label = (np.array([number[x] for x in b.label], np.int64) for b in (rows, anchors))
        for a, r, score in _tiles(rows, anchors, np.arange(len(rows.id)), np.arange(len(anchors.id))):
            other = (row_label[r][None, :] != anchor_label[a][:, None]) & (rows.id[r][None, :] != anchors.id[a][:, None])
            for s in range(max(len(anchors.limits[i]) for i in a)):
                have = np.array([i for i in range(len(a)) if len(anchors.limits[a[i]]) > s])
                own = [anchors.limits[a[i]] for i in have]
                top = np.array([x[s] for x in own], np.int64)[:, None]
                end = np.array([x[s + 1] if len(x) > s + 1 else 0 for x in own], np.int64)[:, None]
                last = np.array([len(x) == s + 1 for x in own])[:, None]
                within = other[have] & (score[have] <= top) & (last | (score[have] > end))
                i, j = best(score[have], within, k)
                found.append((a[have[i]], np.full(len(i), s), r[j], score[have[i], j]))
        return _table(rows, anchors, found, k)
    return run


# ---- Spark ----------------------------------------------------------------

PAIR = ["anchor_id", "anchor_key"]
FOUND = "anchor_id long, anchor_key long, slot int, vec_id long, key long, score long"


def _met(rows: DataFrame, anchors: DataFrame, row_blocks: int, anchor_blocks: int, work) -> DataFrame:
    """``work`` on every pair of a block of rows and a block of anchors."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = lambda n: F.pmod(F.xxhash64("key"), F.lit(n)).cast("int")
    left = rows.select("vec_id", "label", "vector", "key", own(row_blocks).alias("rows_of"), every(anchor_blocks).alias("anchors_of"))
    right = anchors.select(*anchors.columns, own(anchor_blocks).alias("anchors_of"), every(row_blocks).alias("rows_of"))
    pair = ["rows_of", "anchors_of"]
    return left.groupBy(*pair).cogroup(right.groupBy(*pair)).applyInArrow(work, FOUND)


def _first(found: DataFrame, k: int) -> DataFrame:
    """The best k of each (anchor, slot) over all blocks."""
    rank = F.row_number().over(Window.partitionBy(*PAIR, "slot").orderBy(F.desc("score"), "vec_id", "key"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def suffixes(found: DataFrame, slots: int, k: int) -> DataFrame:
    """Per anchor an array: for slot s the best k rows (score, vec_id, key) of it and all slots below."""
    entry = F.struct((-F.col("score").cast("decimal(20,0)")).alias("down"), "vec_id", "key", "score")      # sorts best first
    per_slot = found.groupBy(*PAIR, "slot").agg(F.sort_array(F.collect_list(entry)).alias("own"))           # at most k
    per_anchor = per_slot.groupBy(*PAIR).agg(F.collect_list(F.struct("slot", "own")).alias("lists"))        # at most the number of positives
    kind = per_slot.schema["own"].dataType.simpleString()
    none = F.array().cast(kind)
    of_slot = lambda s: F.flatten(F.transform(F.filter("lists", lambda x: x["slot"] == s), lambda x: x["own"]))
    merged = F.aggregate(F.sequence(F.lit(slots - 1), F.lit(0)), F.array().cast(f"array<{kind}>"), lambda done, s: F.array_append(
        done, F.slice(F.concat(of_slot(s), F.coalesce(F.get(done, F.size(done) - 1), none)), 1, k)))
    return per_anchor.select(*PAIR, F.reverse(merged).alias("upto"))


def hard_negatives(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, of: int = 100,
                   scale: int = SCALE) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    ``vectors(vec_id, embedding, label)``; ``anchor`` is a condition on its columns that names the query set."""
    scratch = Scratch(vectors.sparkSession, "hard-negatives")
    rows = scratch.written(prepared(vectors, anchor, scale), "rows")
    count, wide, asked = rows.agg(F.count("*"), F.max(F.size("vector")), F.count_if("anchor")).first()
    each = 8 * max(wide or 1, 1)
    row_blocks, anchor_blocks = max(1, -(-count * each // ROW_BYTES)), max(1, -(-asked * each // ANCHOR_BYTES))
    anchors = rows.where("anchor").select("vec_id", "label", "vector", "key")

    best_own = _first(_met(rows, anchors, row_blocks, anchor_blocks, _same_label(positives)), positives)
    level = F.dense_rank().over(Window.partitionBy(*PAIR).orderBy(F.desc("score"))) - 1
    chosen = scratch.written(best_own.select(*PAIR, F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), level.alias("level")), "positives")

    limits = chosen.groupBy(F.col("anchor_id").alias("vec_id"), F.col("anchor_key").alias("key")).agg(
        F.sort_array(F.collect_set("positive_score"), asc=False).alias("limits"))                # at most ``positives``
    asking = scratch.written(anchors.join(limits, ["vec_id", "key"]).select(*anchors.columns, "limits"), "asking")
    found = _first(_met(rows, asking, row_blocks, anchor_blocks, _other_labels(negatives)), negatives)

    exact = lambda c, n: c.cast("decimal(20,0)") * F.lit(n).cast("decimal(10,0)")
    within = F.filter(F.get("upto", F.col("level")), lambda x: exact(x["score"], of) >= exact(F.col("positive_score"), low))
    out = chosen.join(suffixes(found, positives, negatives), PAIR).select(
        "anchor_id", "positive_id", "positive_score", F.posexplode(within).alias("at", "negative"))
    return scratch.result(out.select("anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("negative.vec_id").alias("negative_id"),
                                     "positive_score", F.col("negative.score").alias("negative_score")))
