"""Long <-> wide and level stacking (RSH1-RSH5, SET1, SET2).

Widening always lists its values, so there is no extra job to find them,
and NULL can be asked for as a value of its own (the reference's
``pivot_wider`` makes a ``..._NA`` column for it).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def widen(df: DataFrame, ids: Sequence[str], names_from: str, values_from: str,
          values: Sequence, name: str | Callable[[object], str] = "{}",
          include_null: bool = False, null_name: str = "NA") -> DataFrame:
    """RSH1-RSH4: one column per listed value of ``names_from``.

    ``name`` is a template (``"JG_Gewicht_{}"``) or a function of the value.
    Each (ids, value) cell may occur once; a second row for it stops the job,
    as one of the two would be lost.
    """
    fmt = name if callable(name) else (lambda v, _t=name: _t.format(v))
    cols = []
    wanted = [(F.col(names_from) == F.lit(v), fmt(v)) for v in values]
    if include_null:
        wanted.append((F.col(names_from).isNull(), fmt(null_name)))
    for here, title in wanted:
        twice = F.raise_error(F.lit(f"widen: two rows for one cell of {title}"))
        cols.append(F.when(F.count(F.when(here, F.lit(1))) > 1, twice)
                    .otherwise(F.max(F.when(here, F.col(values_from)))).alias(title))
    return df.groupBy(*ids).agg(*cols)


def lengthen(df: DataFrame, ids: Sequence[str], values: Sequence[str],
             name: str = "var", value: str = "val") -> DataFrame:
    """RSH5: wide -> long over ``values`` (a narrow projection, no shuffle)."""
    return df.unpivot(list(ids), list(values), name, value)


def stack_levels(levels: Mapping[str, DataFrame], level_col: str = "geolevel",
                 allow_missing: bool = False) -> DataFrame:
    """SET1/SET2: union by name of per-level tables, tagged with their level."""
    out = None
    for level, df in levels.items():
        part = df.withColumn(level_col, F.lit(level))
        out = part if out is None else out.unionByName(part, allowMissingColumns=allow_missing)
    return out
