"""Cell counts at one or many grains (AGG1, AGG2, AGG5-AGG9).

The microdata is scanned and shuffled once, at the finest grain any output
needs; Spark's partial (map-side) aggregation keeps the exchange at cell
size even when one key holds a large share of the rows.  Coarser grains are
rolled up from that cell table, since counts are additive.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from areacube.session import materialize


def count_cells(df: DataFrame, dims: Sequence[str], name: str = "n") -> DataFrame:
    """AGG1: ``group_by(dims) %>% summarize(n = n())``; NULL is a group of its own."""
    return df.groupBy(*dims).agg(F.count(F.lit(1)).alias(name))


def roll_up(cells: DataFrame, dims: Sequence[str], measure: str = "n") -> DataFrame:
    """A coarser grain from a finer cell table (counts are additive)."""
    return cells.groupBy(*dims).agg(F.sum(measure).cast("bigint").alias(measure))


def grouping_id_of(grain: Sequence[str], all_dims: Sequence[str]) -> int:
    """Spark's ``grouping_id()`` for one grouping set: a 1 bit per absent column,
    the first column being the most significant bit."""
    n = len(all_dims)
    return sum(1 << (n - 1 - i) for i, d in enumerate(all_dims) if d not in grain)


def count_grains(cells: DataFrame, grains: Mapping[str, Sequence[str]], all_dims: Sequence[str],
                 measure: str = "n", grain_col: str = "grain") -> DataFrame:
    """AGG2: the same count at several grains in one aggregate.

    ``cells`` holds counts at a grain at least as fine as every requested one;
    the result has one row per (grain, cell), dims outside a grain are NULL and
    ``grain_col`` says which grain a row belongs to (a NULL dim value inside a
    grain stays a group of its own).
    """
    sets = [list(g) for g in grains.values()]
    gid = F.grouping_id(*all_dims)
    name: Column = F.lit(None).cast("string")
    for label, g in grains.items():
        name = F.when(gid == grouping_id_of(g, all_dims), F.lit(label)).otherwise(name)
    return (cells.groupingSets(sets, *all_dims)
            .agg(F.sum(measure).cast("bigint").alias(measure), name.alias(grain_col)))


def observed_pass(df: DataFrame, grouped: Callable[[DataFrame], DataFrame], **metrics: Column) -> tuple[DataFrame, dict]:
    """One pass over ``df`` that writes ``grouped(df)`` (a reliable checkpoint) and
    observes ``metrics`` (aggregate columns) over all rows on the way: no second scan, and
    no shuffle for the metrics.  Minima, maxima and "any row" flags are exact; a
    count may hold rows of a task that ran twice."""
    seen = Observation()
    out = materialize(grouped(df.observe(seen, *[c.alias(name) for name, c in metrics.items()])))
    return out, seen.get


def year_bounds(df: DataFrame, col: str, year: str) -> DataFrame:
    """AGG5, AGG8: the distinct values of one column with the first and last year of all rows.

    One pass: the distinct values are an aggregate, the bounds are observed beside it.
    """
    each, found = observed_pass(df, lambda rows: rows.groupBy(col).agg(F.count(F.lit(1)).alias("n")).select(col),
                                lo=F.min(year), hi=F.max(year))
    kind = df.schema[year].dataType
    return each.select(col, F.lit(found["lo"]).cast(kind).alias("jaar_min"), F.lit(found["hi"]).cast(kind).alias("jaar_max"))
