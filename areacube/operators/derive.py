"""Derived indicators and small-count suppression on a wide cube (MET6, MET7).

The reference only writes the formulas as text for the portal.  Here each
derived indicator is a small structure that yields both the formula text for
the metadata and the Spark column that evaluates it (``try_divide``: an
empty total gives NULL, never an error or NaN).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Derived:
    name: str
    parts: tuple            # summed columns
    over: tuple = ()        # if set: share of sum(parts) in sum(over), in percent

    def _sum(self, cols: Sequence[str]) -> Column:
        out = F.col(cols[0])
        for c in cols[1:]:
            out = out + F.col(c)
        return out

    def column(self) -> Column:
        if not self.over:
            return self._sum(self.parts)
        return F.try_divide(self._sum(self.parts), self._sum(self.over)) * F.lit(100.0)

    def formula(self) -> str:
        top = "+".join(self.parts)
        if not self.over:
            return top
        bottom = "+".join(self.over)
        return f"(({top})/({bottom}))*100" if len(self.parts) > 1 else f"({top}/({bottom}))*100"


def add_derived(df: DataFrame, derived: Sequence[Derived]) -> DataFrame:
    """MET6: evaluate the derived indicators as columns."""
    return df.withColumns({d.name: d.column() for d in derived})


def suppress(df: DataFrame, rules: dict[str, str], threshold: float = 50) -> DataFrame:
    """MET7: hide a value when its threshold indicator is below ``threshold``.

    ``rules`` maps value column -> threshold column.  Which side of the
    threshold the portal hides is our reading (values at or above are shown).
    """
    return df.withColumns({v: F.when(F.col(t) >= threshold, F.col(v)) for v, t in rules.items()})


def weight_class_indicators(prefix: str = "JG_Gewicht_", classes: Sequence[int] = (1, 2, 3, 4),
                            overweight: Sequence[int] = (1, 2)) -> list[Derived]:
    """The derived indicators of the weight cubes: total, class shares,
    overweight count and its share."""
    cls = tuple(f"{prefix}{k}" for k in classes)
    ow = tuple(f"{prefix}{k}" for k in overweight)
    out = [Derived(f"{prefix}totaal", cls)]
    out += [Derived(f"{c}_perc", (c,), cls) for c in cls]
    out += [Derived("JG_Overgewicht", ow), Derived("JG_Overgewicht_perc", ow, cls)]
    return out
