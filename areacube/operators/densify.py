"""Gap filling of a cell table (DEN1-DEN3, JN9, JN10).

The reference expands the full product of dimension values, fills absent
counts with 0, then adds stub rows for (area, year) pairs without data and
expands again with NULL measures.  Without depending on row order that is:

* cell observed                                  -> its count;
* area observed and year observed (zero fill)    -> 0;
* otherwise (new area, or a year with no data)   -> NULL.

Build: the area keys stay distributed (observed areas, plus member areas
without data).  The other dimensions have few values; they are gathered by
one scalar subquery over the cell table (size-checked in the JVM, never
collected to the driver) and generated per area with ``explode``, so the
grid needs no join at all.  Observed cells and grid rows are then unioned
and summed on the full key after one hash exchange on ``cluster``; later
windows partitioned by supersets of ``cluster`` reuse that exchange.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_LEVELS = 100_000


def _checked(arr, what: str, limit: int):
    msg = f"densify: more than {limit} values for {what}; not a categorical dimension"
    return F.when(F.size(arr) > limit, F.raise_error(F.lit(msg))).otherwise(arr)


def dimension_levels(cells: DataFrame, dims: Sequence[str], year: str,
                     max_levels: int = MAX_LEVELS) -> DataFrame:
    """One row, column ``lv``: the observed values of each dimension (NULL
    included, as ``struct(v)``), the observed years and their bounds.

    The sizes are checked first with HyperLogLog counts (constant memory), so
    a non-categorical column stops the job before any value set is gathered
    into one task.  Grains rolled up from one cell table can share this row.
    """
    dims = list(dims)
    ndv = cells.agg(F.struct(*[F.approx_count_distinct(c).alias(c) for c in dims + [year]])).scalar()
    widest = ndv.getField(year)
    for d in dims:
        widest = F.greatest(widest, ndv.getField(d))
    guarded = cells.where(F.when(widest > max_levels, F.raise_error(F.lit(
        f"densify: more than {max_levels} values in a dimension; not a categorical dimension")))
        .otherwise(F.lit(True)))
    return guarded.agg(F.struct(
        *[_checked(F.collect_set(F.struct(F.col(d).alias("v"))), d, max_levels).alias(d) for d in dims],
        _checked(F.collect_set(F.col(year)), year, max_levels).alias("__years"),
        F.min(year).alias("__lo"), F.max(year).alias("__hi")).alias("lv"))


def with_dictionary_levels(levels: DataFrame, dictionary: DataFrame, variables: Mapping[str, str]) -> DataFrame:
    """DEN1, FCT1: the row of ``dimension_levels`` with the levels that the value
    dictionary (variable, code, ...) gives its factor dims added to the observed ones.

    ``variables`` maps dim -> variable.  A level that nobody has thus enters the
    grid; a dim whose variable has no entries keeps its observed values.  The
    dictionary is one row of level sets too (a scalar subquery), never collected.
    """
    kinds = {f.name: f.dataType.elementType["v"].dataType for f in levels.schema["lv"].dataType.fields if f.name in variables}
    entry = {d: F.when((F.col("variable") == var) & F.col("code").isNotNull(), F.struct(F.col("code").cast(kinds[d]).alias("v")))
             for d, var in variables.items()}
    given = dictionary.agg(F.struct(*[F.collect_set(e).alias(d) for d, e in entry.items()])).scalar()
    lv = F.col("lv")
    for d in variables:
        lv = lv.withField(d, F.array_union(F.col("lv").getField(d), given.getField(d)))
    return levels.select(lv.alias("lv"))


def densify(cells: DataFrame, geo: Sequence[str], dims: Sequence[str], year: str,
            measure: str = "n", zero_fill: bool = True, extra_geos: DataFrame | None = None,
            fill_years: bool | Column = False, cluster: Sequence[str] | None = None,
            max_levels: int = MAX_LEVELS, levels: DataFrame | None = None) -> DataFrame:
    """Complete ``cells`` over area x dims x year.

    ``cells`` may be at a finer grain than ``geo + dims + [year]``: the
    measure is summed first, with map-side partial sums, so a region-level grain
    (no area key) shuffles a few rows per task and not the cell table.

    geo:        area key columns (e.g. municipality, or the municipality/district
                pair); the grid holds observed keys plus ``extra_geos``.
    dims:       categorical dimensions expanded to all observed values (NULL too).
    year:       integer year; all observed years, or the whole
                ``min..max`` range when ``fill_years`` (stub years exist);
                ``fill_years`` may be a boolean column decided in the plan.
    zero_fill:  absent cells of an observed area and year get 0, else NULL.
    cluster:    hash-partitioning columns for the result (default ``geo``).
    levels:     the row of ``dimension_levels`` (a superset of ``dims`` is fine),
                when several grains share one cell table.
    """
    geo, dims = list(geo), list(dims)
    keys = geo + dims + [year]
    # partial sums in every map task: what is shuffled is the grain, whatever the cell table's size
    rolled = cells.groupBy(*keys).agg(F.sum(measure).cast("bigint").alias(measure))
    if levels is None:
        levels = dimension_levels(cells, dims, year, max_levels)
    lv = levels.select("lv").scalar()

    if geo:
        geos = cells.select(*geo, F.lit(True).alias("__gobs"))
        if extra_geos is not None:
            geos = geos.unionByName(extra_geos.select(*geo, F.lit(False).alias("__gobs")))
        geos = geos.groupBy(*geo).agg(F.max("__gobs").alias("__gobs"))
    else:
        geos = cells.agg(F.lit(True).alias("__gobs"))

    grid = geos.withColumn("__lv", lv)
    for d in dims:
        grid = (grid.withColumn("__e", F.explode(F.col("__lv").getField(d)))
                .withColumn(d, F.col("__e").getField("v")).drop("__e"))
    if fill_years is False:
        years = F.col("__lv.__years")
    else:
        span = F.col("__lv.__hi") - F.col("__lv.__lo")
        full = F.when(span >= max_levels, F.raise_error(F.lit(f"densify: year range over {max_levels}"))) \
                .otherwise(F.sequence(F.col("__lv.__lo"), F.col("__lv.__hi")))
        years = full if fill_years is True else F.when(fill_years, full).otherwise(F.col("__lv.__years"))
    grid = grid.withColumn(year, F.explode(years))
    if zero_fill:
        seen = F.col("__gobs") & F.array_contains(F.col("__lv.__years"), F.col(year))
        fill = F.when(seen, F.lit(0).cast("bigint"))
    else:
        fill = F.lit(None).cast("bigint")
    grid = grid.select(*keys, fill.alias(measure))

    both = rolled.unionByName(grid)
    part = list(cluster) if cluster is not None else geo
    if part:
        both = both.repartition(*part)
    return both.groupBy(*keys).agg(F.sum(measure).cast("bigint").alias(measure))


def missing_geo_years(cells: DataFrame, geo: Sequence[str], year: str,
                      members: DataFrame | None = None) -> DataFrame:
    """JN9/AGG9: (area, year) pairs of the ``min..max`` range without any row.

    Areas are the observed ones plus ``members``.  The reference's nested loops
    with a row-count test become one aggregate: the spine (every area x every
    year) and the observed pairs are unioned and a pair is missing when no
    observed row joined its group.  ``cells`` may be at any finer grain.
    """
    geo = list(geo)
    bounds = cells.agg(F.struct(F.min(year).alias("lo"), F.max(year).alias("hi"))).scalar()
    areas = cells.select(*geo)
    if members is not None:
        areas = areas.unionByName(members.select(*geo))
    spine = (areas.distinct().withColumn("__b", bounds)
             .select(*geo, F.explode(F.sequence(F.col("__b.lo"), F.col("__b.hi"))).alias(year),
                     F.lit(False).alias("__seen")))
    seen = cells.select(*geo, year, F.lit(True).alias("__seen"))
    return (spine.unionByName(seen).groupBy(*geo, year).agg(F.max("__seen").alias("__seen"))
            .where(~F.col("__seen")).drop("__seen"))
