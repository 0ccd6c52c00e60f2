"""Design-based comparison of each municipality with the rest of its region
(RSH5, SVY1-SVY8, FLT7, JN11, SET3).

The reference loops over indicators x municipalities and, in every step,
rebuilds a stratified design on the whole file, tabulates it and runs a
Rao-Scott corrected chi-square test (V x M full passes).  Here the microdata
is read once: it is unpivoted to (indicator, value) and summed per
(by, indicator, stratum, municipality, value) -- count, sum(w), sum(w^2) --
in one hash aggregate with map-side partials.  Everything after that works
on those sums; "rest of the region" is the region total minus the
municipality.

Rao-Scott F for one 2x2 table (values v0 < v1 by municipality yes/no),
following the published first-order correction (Rao & Scott 1984):

* cell sums ``S_k`` (k = value x in/out), ``W = sum S_k``, ``p_k = S_k / W``;
* ``X2 / N = (p00 p11 - p01 p10)^2 / (r0 r1 c0 c1)`` (Pearson on shares);
* contrast ``c = (+1, -1, -1, +1)`` and ``q_k = c_k / S_k`` (0 for empty cells);
* with ``f_h = n_h / (n_h - 1)`` over all design rows ``n_h`` of stratum h,
  ``num = sum_h f_h (A_h - B_h^2 / n_h)``, ``A_h = sum_k q_k^2 sum(w^2)_hk``,
  ``B_h = sum_k q_k sum(w)_hk``;
* ``F = (X2 / N) * W * sum_k (1 / S_k) / num``, ``delta = N num / (W sum 1/S_k)``,
  ``nu = N - H`` (rows minus strata of the design), ``p = P(F(1, nu) > F)``.

The stratum sum would need every (municipality, stratum) pair.  Because the
"out" cells are totals minus "in" cells, it splits exactly into per-indicator
constants over all strata plus a sum over the strata where the municipality
has rows, so no (indicator x municipality x stratum) grid is ever built.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areacube.functions.fdist import f_upper
from areacube.session import materialize


def _c(name: str) -> Column:
    return F.col(name)


def survey_sums(df: DataFrame, indicators: Sequence[str], group: str, strata: str, weight: str,
                by: Sequence[str] = ()) -> DataFrame:
    """RSH5 + SVY1: (by, var, stratum, group, val) -> n, s1 = sum(w), s2 = sum(w^2).

    NULL values and NULL groups stay as groups: they count as design rows of
    their stratum (``n_h``) but never enter a table.
    """
    ids = list(by) + [group, strata, weight]
    long = (df.select(*ids, *[_c(v).cast("double").alias(v) for v in indicators])
            .unpivot(ids, list(indicators), "var", "val"))
    w = _c(weight).cast("double")
    return long.groupBy(*by, "var", strata, group, "val").agg(
        F.count(F.lit(1)).alias("n"), F.sum(w).alias("s1"), F.sum(w * w).alias("s2"))


def _inv(x: Column) -> Column:
    return F.when(x > 0, F.lit(1.0) / x).otherwise(F.lit(0.0))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner equi-join on keys where NULL equals NULL; the keys once."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = reduce(and_, [_c(k).eqNullSafe(_c(f"__r_{k}")) for k in keys])
    return left.join(renamed, on).drop(*[f"__r_{k}" for k in keys])


def answer_values(sums: DataFrame, keys: Sequence[str], group: str) -> DataFrame:
    """Per indicator its two least answer values v0 < v1 and the number of its
    answer values (0 if nobody answered), from the distinct values."""
    seen = F.when(_c(group).isNotNull(), _c("val"))
    values = sums.select(*keys, seen.alias("val")).distinct()
    least = values.groupBy(*keys).agg(F.min("val").alias("v0"), F.count("val").alias("n_levels"))
    above = null_safe_join(values, least.select(*keys, "v0"), keys).where(_c("val") > _c("v0"))
    second = above.groupBy(*keys).agg(F.min("val").alias("v1"))
    renamed = second.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = reduce(and_, [_c(k).eqNullSafe(_c(f"__r_{k}")) for k in keys])
    return least.join(renamed, on, "left").drop(*[f"__r_{k}" for k in keys])


def compare_with_rest(sums: DataFrame, group: str, strata: str, by: Sequence[str] = (),
                      groups: DataFrame | None = None) -> DataFrame:
    """SVY2 + SVY4 for every (by, var, group).

    Result columns: by..., var, group, n_levels, is_dichotomous, perc_gemeente,
    perc_rest (shares of the second answer value), n_design, x2, delta,
    f_stat, nu.  Test columns are NULL unless the indicator has exactly two
    values (D4); an indicator that nobody answered keeps its rows, with 0 levels.
    ``groups`` (one column named ``group``) limits the result
    to the municipalities of the code list (LBL6).

    Physical shape: two levels of decomposable sums, each an aggregate with
    map-side partials: per (by, var, stratum), then per (by, var), and per
    (by, var, municipality); the constants are joined back on these keys.  No
    step gathers the cells of one indicator, so one indicator that holds all rows is
    spread like many.  Sums, cells and stratum totals are written once (reliable checkpoints) and read by every step.
    """
    K = list(by) + ["var"]
    z = F.lit(0.0)
    sums = materialize(sums)
    kv = answer_values(sums, K, group)
    s = null_safe_join(sums, kv, K)
    is0, is1 = _c("val") == _c("v0"), _c("val") == _c("v1")
    hg = materialize(s.groupBy(*K, strata, group).agg(
        F.sum("n").alias("n_all"), F.max("n_levels").alias("n_levels"),
        F.coalesce(F.sum(F.when(is0, _c("s1"))), z).alias("a1"),
        F.coalesce(F.sum(F.when(is1, _c("s1"))), z).alias("b1"),
        F.coalesce(F.sum(F.when(is0, _c("s2"))), z).alias("a2"),
        F.coalesce(F.sum(F.when(is1, _c("s2"))), z).alias("b2"),
        F.coalesce(F.sum(F.when(_c("val").isNotNull(), _c("s1"))), z).alias("t1"),
        F.coalesce(F.sum(F.when(is0, _c("n"))), F.lit(0)).alias("an"),
        F.coalesce(F.sum(F.when(is1, _c("n"))), F.lit(0)).alias("bn"),
        F.coalesce(F.sum(F.when(_c("val").isNotNull(), _c("n"))), F.lit(0)).alias("tn")))

    # per stratum: all design rows (NULL group and NULL value included) and region totals
    known = _c(group).isNotNull()
    st = hg.groupBy(*K, strata).agg(F.sum("n_all").alias("nh"), *[
        F.coalesce(F.sum(F.when(known, _c(c))), z).alias("t" + c) for c in ("a1", "b1", "a2", "b2", "t1", "an", "bn", "tn")])
    nh = _c("nh")
    st = st.withColumn("fh", F.when(nh <= 1, F.raise_error(F.concat(
        F.lit("stratum with a single row: "), _c(strata).cast("string")))).otherwise(nh / (nh - F.lit(1))))
    st = materialize(st)
    # per indicator: sums over strata
    fn = _c("fh") / nh
    constants = st.groupBy(*K).agg(
        F.sum("ta1").alias("W0"), F.sum("tb1").alias("W1"), F.sum("tt1").alias("Wall"),
        F.sum("tan").alias("N0"), F.sum("tbn").alias("N1"), F.sum("ttn").alias("Nall"),
        F.sum(_c("fh") * _c("ta2")).alias("U0"), F.sum(_c("fh") * _c("tb2")).alias("U1"),
        F.sum(fn * _c("ta1") * _c("ta1")).alias("T00"), F.sum(fn * _c("ta1") * _c("tb1")).alias("T01"),
        F.sum(fn * _c("tb1") * _c("tb1")).alias("T11"), F.sum(nh).alias("n_design"), F.count(F.lit(1)).alias("n_strata"))
    # per municipality: its cell sums and the contrast weights q = c / S
    own = hg.where(known)
    if groups is not None:
        own = own.join(groups.select(group).where(_c(group).isNotNull()).distinct(), group, "left_semi")
    gm = own.groupBy(*K, group).agg(F.max("n_levels").alias("n_levels"), *[
        F.sum(c).alias(name) for c, name in (("a1", "M0"), ("b1", "M1"), ("t1", "Mall"), ("an", "K0"), ("bn", "K1"), ("tn", "Kall"))])
    gm = null_safe_join(gm, constants, K)

    def rest(total, own, rows, own_rows):
        # total minus own in floating point: exactly 0 when no row is left
        return F.when(_c(rows) == _c(own_rows), z).otherwise(_c(total) - _c(own))
    gm = gm.withColumns({"R0": rest("W0", "M0", "N0", "K0"), "R1": rest("W1", "M1", "N1", "K1")})
    # the rest's total: the sum of its two cells where there are no others, so that an empty cell gives a share of exactly 0 or 1
    gm = gm.withColumn("Rall", F.when(_c("N0") + _c("N1") == _c("Nall"), _c("R0") + _c("R1")).otherwise(rest("Wall", "Mall", "Nall", "Kall")))
    gm = gm.withColumns({"q0T": -_inv(_c("M0")), "q1T": _inv(_c("M1")), "q0F": _inv(_c("R0")), "q1F": -_inv(_c("R1"))})
    # the part of the stratum sum that depends on the municipality (its strata only)
    cells = null_safe_join(own.select(*K, strata, group, "a1", "b1", "a2", "b2"), st.select(*K, strata, "nh", "fh", "ta1", "tb1"), [*K, strata])
    cells = null_safe_join(cells, gm, [*K, group])
    bh = (_c("q0T") - _c("q0F")) * _c("a1") + (_c("q1T") - _c("q1F")) * _c("b1")
    ah = _c("q0F") * _c("ta1") + _c("q1F") * _c("tb1")
    term = (_c("fh") * ((_c("q0T") ** 2 - _c("q0F") ** 2) * _c("a2") + (_c("q1T") ** 2 - _c("q1F") ** 2) * _c("b2"))
            - _c("fh") / _c("nh") * (F.lit(2.0) * ah * bh + bh * bh))
    const = [c for c in gm.columns if c not in (*K, group)]
    r = cells.groupBy(*K, group).agg(F.sum(term).alias("__part"), *[F.max(c).alias(c) for c in const])

    q0F, q1F = _c("q0F"), _c("q1F")
    num = (q0F * q0F * _c("U0") + q1F * q1F * _c("U1")
           - (q0F * q0F * _c("T00") + F.lit(2.0) * q0F * q1F * _c("T01") + q1F * q1F * _c("T11"))
           + _c("__part"))
    W = _c("W0") + _c("W1")
    def share_of(x):
        return F.try_divide(x, W)
    a, b = share_of(_c("R0")), share_of(_c("M0"))                     # v0 out, v0 in
    c, d = share_of(_c("R1")), share_of(_c("M1"))                     # v1 out, v1 in
    r0, r1 = share_of(_c("W0")), share_of(_c("W1"))
    cin = share_of(_c("M0") + _c("M1"))
    x2n = F.try_divide((a * d - b * c) ** 2, r0 * r1 * (F.lit(1.0) - cin) * cin)
    sinv = _inv(_c("R0")) + _inv(_c("R1")) + _inv(_c("M0")) + _inv(_c("M1"))
    two = _c("n_levels") == 2
    N = _c("n_design").cast("double")
    return r.select(
        *K, group, _c("n_levels").cast("bigint").alias("n_levels"), two.alias("is_dichotomous"),
        F.when(_c("n_levels") >= 2, F.try_divide(_c("M1"), _c("Mall"))).alias("perc_gemeente"),
        F.when(_c("n_levels") >= 2, F.try_divide(_c("R1"), _c("Rall"))).alias("perc_rest"),
        _c("n_design").cast("bigint").alias("n_design"),
        F.when(two, N * x2n).alias("x2"),
        F.when(two, F.try_divide(N * num, W * sinv)).alias("delta"),
        F.when(two, F.try_divide(x2n * W * sinv, num)).alias("f_stat"),
        (_c("n_design") - _c("n_strata")).cast("bigint").alias("nu"))


def p_values(tests: DataFrame) -> DataFrame:
    """SVY4 / UDF4: ``p = P(F(1, nu) > f_stat)`` (NULL where the test is undefined)."""
    return tests.withColumn("p", f_upper(_c("f_stat"), F.lit(1.0), _c("nu").cast("double")))


def significance_group(df: DataFrame, higher_better: str = "hoger_beter", p: str = "p") -> DataFrame:
    """SVY6 + SVY7: favourable flag and group 1-5.

    1/2: unfavourable with p < 0.01 / 0.01 <= p <= 0.05; 3: p > 0.05;
    4/5: favourable with 0.01 <= p <= 0.05 / p < 0.01.  NULL propagates
    (never NaN, which would compare as larger than 0.05).
    """
    fav = (F.when(_c(higher_better), _c("perc_gemeente") > _c("perc_rest"))
           .when(~_c(higher_better), _c("perc_rest") > _c("perc_gemeente")))
    pv = _c(p)
    group = (F.when(pv > 0.05, 3)
             .when(~_c("gunstig") & (pv < 0.01), 1)
             .when(~_c("gunstig") & (pv >= 0.01), 2)
             .when(_c("gunstig") & (pv >= 0.01), 4)
             .when(_c("gunstig") & (pv < 0.01), 5))
    return df.withColumn("gunstig", fav).withColumn("pgroep", group)


# ---------------------------------------------------------------- plan-time helpers

def parse_direction(df: DataFrame, text: str = "richting") -> DataFrame:
    """STR5 + SVY5: ``"Hoger = gunstig"`` -> gunstig, hoger_beter = true.

    Only ``gunstig`` / ``ongunstig`` are accepted (D6); anything else gives a
    NULL flag, which :func:`require_directions` turns into an error.
    """
    code = F.nullif(F.regexp_extract(_c(text), r".*= (\w+)", 1), F.lit(""))
    flag = F.when(code == "gunstig", True).when(code == "ongunstig", False)
    return df.withColumn("richting_code", code).withColumn("hoger_beter", flag)


def require_directions(df: DataFrame, text: str = "richting") -> DataFrame:
    """FLT6: stop the job on an unreadable direction (checked inside the plan)."""
    msg = F.concat(F.lit("invalid value in Richting: "), F.coalesce(_c(text), F.lit("(empty)")),
                   F.lit("; expected 'Hoger = gunstig' or 'Hoger = ongunstig'"))
    return df.withColumn("hoger_beter", F.when(_c("hoger_beter").isNull(), F.raise_error(msg))
                         .otherwise(_c("hoger_beter")))
