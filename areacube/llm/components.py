"""Connected components of a link table, by alternating large-star and
small-star steps (Kiveris et al. 2014) on DataFrames.

Every step is a minimum per node (an aggregate with map-side partial sums)
and a join back on the node, so a node with very many links is spread by
the adaptive skew join; no component is ever gathered in one task or on the
driver.  After the two steps each task replaces the links it holds by their
spanning stars, which saves both rows and rounds; that is the one Python step of a round, so a
core runs one Python worker.  The links of one round are written to the shared folder before the next.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: Links that one task contracts.
TASK_ROWS = 1 << 18


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links (node, least node) of the components of one batch of links."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    while (root[root] != root).any():
        root = root[root]
    keep = root != np.arange(len(nodes))
    return nodes[keep], nodes[root[keep]]


def stars(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """The spanning stars of some links."""
    node, low = _forest(a, b)
    return pa.RecordBatch.from_arrays([pa.array(node), pa.array(low)], ["node", "low"])


def _contract(batches):
    """Each batch of links by its spanning stars: fewer rows, same components."""
    for batch in batches:
        a, b = (batch.column(i).to_numpy() for i in (0, 1))
        if len(a):
            yield stars(a, b)


def _state(links: DataFrame) -> tuple[int, int]:
    """The number of (distinct) links, and of nodes that keep them from being stars around least nodes:
    those with two lower ones, or with a lower and a higher one."""
    ends = links.select(F.col("node").alias("id"), F.lit(1).alias("up")).unionByName(links.select(F.col("low").alias("id"), F.lit(0).alias("up")))
    found = ends.groupBy("id").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    wrong = (F.col("ups") > 1) | ((F.col("ups") == 1) & (F.col("least") == 0))
    rows, bad = found.agg(F.coalesce(F.sum("ups"), F.lit(0)), F.count(F.when(wrong, 1))).first()
    return rows, bad


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("low").alias("node"), F.col("node").alias("low")))
    least = both.groupBy("node").agg(F.min("low").alias("m")).select(F.col("node").alias("n_"), F.least("node", "m").alias("m"))
    return (both.join(least, F.col("node") == F.col("n_")).where(F.col("low") > F.col("node"))
            .select(F.col("low").alias("node"), F.col("m").alias("low")))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("node").agg(F.min("low").alias("m")).select(F.col("node").alias("n_"), "m")
    moved = links.join(least, F.col("node") == F.col("n_")).select(F.col("low").alias("node"), F.col("m").alias("low"))
    return (moved.unionByName(least.select(F.col("n_").alias("node"), F.col("m").alias("low")))
            .where(F.col("node") != F.col("low")))


def _smaller(links: DataFrame, rows: int) -> DataFrame:
    """Contracted in as many tasks as the rows need, two a core at least: many small batches would contract little."""
    tasks = max(2 * links.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))
    return links.coalesce(tasks).mapInArrow(_contract, "node long, low long")


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``links(a, b)`` of longs, in any direction, repeats allowed: one row
    (node, root) per linked node, root the least node of its component.
    Links of a node with itself are ignored; an empty table gives an empty one.
    Rounds end when the links are stars.  The result is the table ``roots`` of ``scratch``.
    """
    a, b = links.columns[:2]
    now = scratch.written(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("node"), F.least(a, b).alias("low")).distinct(), "roots")
    rows, bad = _state(now)
    while bad:
        now = scratch.written(_smaller(_small_star(_large_star(now)), rows).distinct(), "roots")
        rows, bad = _state(now)
    return now.select("node", F.col("low").alias("root"))
