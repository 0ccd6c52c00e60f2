"""Shares within a group and trailing means over years (AGG3, AGG4, WIN1-WIN5).

All measures are NULL where the reference has NA or NaN: ``try_divide`` turns
0/0 into NULL, so no NaN ever reaches an average (``avg`` skips NULL the way
``mean(na.rm = TRUE)`` skips NA and NaN).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def share(cells: DataFrame, within: Sequence[str], measure: str = "n",
          total: str | None = "n_total", pct: str = "perc") -> DataFrame:
    """AGG3/AGG4 (MTH1): group total on every row and the share in percent.

    ``within`` are the group columns (the cell key minus the class column).
    With ``total=None`` the total is not kept (check-table form).
    """
    w = Window.partitionBy(*within)
    tot = F.sum(measure).over(w).cast("bigint")
    out = cells.withColumn("__tot", tot).withColumn(
        pct, F.try_divide(F.col(measure), F.col("__tot")) * F.lit(100.0))
    if total:
        return out.withColumnRenamed("__tot", total)
    return out.drop("__tot")


def trailing_mean(df: DataFrame, cols: Sequence[str], partition: Sequence[str], order: str,
                  width: int = 4, suffix: str = "_ma") -> DataFrame:
    """WIN1-WIN3 (MTH2, SRT2): mean of the current and ``width - 1`` previous rows,
    NULLs skipped; the year order is explicit in the window (the reference got it
    from the sort order of its gap-filled table).

    ``rowsBetween`` reproduces the reference's row-based window.  On a grid
    completed by ``densify`` the years are consecutive, so this equals the
    year-range frame; on a table with holes in the years only a range frame
    is calendar-correct (see ``trailing_mean_by_range``).
    """
    w = Window.partitionBy(*partition).orderBy(order).rowsBetween(-(width - 1), 0)
    return df.withColumns({f"{c}{suffix}": F.avg(c).over(w) for c in cols})


def trailing_mean_by_range(df: DataFrame, cols: Sequence[str], partition: Sequence[str], order: str,
                           width: int = 4, suffix: str = "_ma") -> DataFrame:
    """Calendar form of WIN1-WIN3: the ``width`` years ending at the row's year."""
    w = Window.partitionBy(*partition).orderBy(order).rangeBetween(-(width - 1), 0)
    return df.withColumns({f"{c}{suffix}": F.avg(c).over(w) for c in cols})


def smoothed_count(df: DataFrame, pct_ma: str = "perc_ma", total: str = "n_total",
                   name: str = "n_weighted") -> DataFrame:
    """WIN4: ``perc.ma * n_total / 100``."""
    return df.withColumn(name, F.col(pct_ma) * F.col(total) / F.lit(100.0))
