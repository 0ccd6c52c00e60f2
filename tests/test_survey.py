"""SVY1-SVY8, UDF4: weighted shares, Rao-Scott test, groups; properties PT6, PT7."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from areacube.functions.fdist import f_upper
from areacube.operators.survey import (compare_with_rest, p_values, parse_direction, require_directions,
                                       significance_group, survey_sums)
from f_tail_numpy import f_upper_tail


def _random_survey(seed=7, n=600, strata=5, groups=6, missing=True):
    rng = np.random.default_rng(seed)
    h = rng.integers(1, strata + 1, n)
    g = rng.integers(1, groups + 1, n)
    w = rng.uniform(0.5, 3.0, n)
    y = (rng.uniform(size=n) < 0.3 + 0.05 * g).astype(float)
    if missing:
        y[rng.uniform(size=n) < 0.1] = np.nan
    return h, g, w, y


def _matrix_form(h, g, w, y, m):
    """General Rao-Scott first-order correction written with matrices (PT7)."""
    ok = ~np.isnan(y)
    ww = np.where(ok, w, 0.0)
    d = g == m
    cells = [(0.0, False), (1.0, False), (0.0, True), (1.0, True)]
    X = np.stack([((y == v) & (d == dd) & ok).astype(float) for v, dd in cells], 1)
    W = ww.sum()
    p = (ww[:, None] * X).sum(0) / W
    z = ww[:, None] * (X - p) / W
    V = np.zeros((4, 4))
    for s in np.unique(h):
        zi = z[h == s]
        zc = zi - zi.mean(0)
        V += len(zi) / (len(zi) - 1) * zc.T @ zc
    N = len(y)
    X1 = np.array([[1, 0, 0], [1, 1, 0], [1, 0, 1], [1, 1, 1]], float)
    X12 = np.array([[0], [0], [0], [1]], float)
    C = X12 - X1 @ np.linalg.lstsq(X1, X12, rcond=None)[0]
    iD = np.diag(np.where(p == 0, 0, 1 / p))
    delta = ((C.T @ iD @ V @ iD @ C) / (C.T @ (iD / N) @ C)).item()
    tab = p.reshape(2, 2).T * N
    e = tab.sum(1, keepdims=True) * tab.sum(0, keepdims=True) / N
    x2 = ((tab - e) ** 2 / e).sum()
    return x2, delta, x2 / delta


def _frame(spark, h, g, w, y):
    data = [(int(a), int(b), float(c), None if np.isnan(d) else int(d)) for a, b, c, d in zip(h, g, w, y)]
    return spark.createDataFrame(data, "h int, g int, w double, y int")


def _tests(spark, df):
    return compare_with_rest(survey_sums(df, ["y"], "g", "h", "w"), "g", "h")


def test_closed_form_equals_matrix_form(spark):
    h, g, w, y = _random_survey()
    got = {r.g: r for r in _tests(spark, _frame(spark, h, g, w, y)).collect()}
    for m in range(1, 7):
        x2, delta, f = _matrix_form(h, g, w, y, m)
        r = got[m]
        assert r.x2 == pytest.approx(x2, rel=1e-9)
        assert r.delta == pytest.approx(delta, rel=1e-9)
        assert r.f_stat == pytest.approx(f, rel=1e-9)
        assert r.nu == len(y) - 5


def test_weight_scale_invariance(spark):
    h, g, w, y = _random_survey(seed=3)
    a = {r.g: r.f_stat for r in _tests(spark, _frame(spark, h, g, w, y)).collect()}
    b = {r.g: r.f_stat for r in _tests(spark, _frame(spark, h, g, w * 7.5, y)).collect()}
    for m in a:
        assert a[m] == pytest.approx(b[m], rel=1e-9)


def test_swap_municipality_and_rest(spark):
    # two groups: "1 against the rest" and "2 against the rest" are the same table transposed
    h, g, w, y = _random_survey(seed=11, groups=2)
    got = {r.g: r for r in _tests(spark, _frame(spark, h, g, w, y)).collect()}
    assert got[1].f_stat == pytest.approx(got[2].f_stat, rel=1e-9)
    assert got[1].perc_gemeente == pytest.approx(got[2].perc_rest, rel=1e-12)


def test_flags_for_other_than_two_values(spark):
    df = spark.createDataFrame([(1, 1, 1.0, 0), (1, 2, 1.0, 1), (2, 1, 1.0, 2), (2, 2, 1.0, 0), (1, 1, 2.0, 1),
                                (2, 2, 2.0, 1)], "h int, g int, w double, y int")
    r = _tests(spark, df).collect()[0]
    assert r.n_levels == 3 and r.is_dichotomous is False and r.f_stat is None and r.perc_gemeente is not None


def test_single_row_stratum_raises(spark):
    df = spark.createDataFrame([(1, 1, 1.0, 0), (1, 2, 1.0, 1), (2, 1, 1.0, 1)], "h int, g int, w double, y int")
    with pytest.raises(Exception, match="single row"):
        _tests(spark, df).collect()


def test_f_tail_known_values():
    p = f_upper_tail([4.9646, 3.8415, 6.6349, 1.0], [1, 1, 1, 1], [10, 1e9, 1e9, 10])
    assert p[0] == pytest.approx(0.05, abs=1e-5)
    assert p[1] == pytest.approx(0.05, abs=1e-5)
    assert p[2] == pytest.approx(0.01, abs=1e-5)
    assert p[3] == pytest.approx(0.3409, abs=1e-4)
    # both branches agree around the switch-over
    a = f_upper_tail([2.0, 9.0], [1, 1], [99_999, 99_999])
    b = f_upper_tail([2.0, 9.0], [1, 1], [100_001, 100_001])
    assert a == pytest.approx(b, rel=1e-6)


def test_p_values_column(spark):
    df = spark.createDataFrame([(4.9646, 10), (None, 10)], "f_stat double, nu long")
    got = [r.p for r in p_values(df).collect()]
    assert got[0] == pytest.approx(0.05, abs=1e-5) and got[1] is None


def test_significance_groups_null_safe(spark):
    df = spark.createDataFrame([
        (True, 0.6, 0.5, 0.001), (True, 0.6, 0.5, 0.03), (True, 0.6, 0.5, 0.2), (True, 0.4, 0.5, 0.03),
        (False, 0.6, 0.5, 0.001), (True, 0.6, 0.5, None), (True, None, 0.5, 0.001)],
        "hoger_beter boolean, perc_gemeente double, perc_rest double, p double")
    assert [r.pgroep for r in significance_group(df).collect()] == [5, 4, 3, 2, 1, None, None]


def test_parse_and_require_direction(spark):
    df = spark.createDataFrame([("Hoger = gunstig",), ("Hoger = ongunstig",), ("Hoger = neutraal",), ("iets",)],
                               "richting string")
    assert [r.hoger_beter for r in parse_direction(df).collect()] == [True, False, None, None]
    with pytest.raises(Exception, match="invalid value in Richting"):
        require_directions(parse_direction(df)).collect()


def test_significance_end_to_end_against_brute_force(spark):
    """Whole job on the small fixture: groups 1-5 from numpy's matrix form."""
    from areacube.plans import registry as R
    from areacube.sources import fixtures as fx
    from conftest import SF_SMALL
    got = {(r.Jaar, r["var"], r.geoitem): (r.pgroep, r.gunstig)
           for r in R.svy_significance(spark, SF_SMALL).collect()}
    raw = R.survey_data(spark, SF_SMALL).toPandas()
    hb = {"vo_ind_a": True, "vo_ind_b": False, "vo_ind_c": False}
    labelled = {r.code for r in fx.survey_municipalities(spark, SF_SMALL).collect()}
    want = {}
    for wave, sub in raw.groupby("vo_wave"):
        h = sub["vo_stratum"].to_numpy()
        g = sub["Gemeentecode"].to_numpy()
        w = sub["vo_weight"].to_numpy(dtype=float)
        for var in hb:
            y = sub[var].to_numpy(dtype=float)
            for m in sorted(set(g) & labelled):
                x2, delta, f = _matrix_form(h, g, w, y, m)
                p = f_upper_tail([f], [1], [len(y) - len(set(h))])[0]
                ok = ~np.isnan(y)
                share_in = np.average(y[ok & (g == m)], weights=w[ok & (g == m)])
                share_out = np.average(y[ok & (g != m)], weights=w[ok & (g != m)])
                fav = share_in > share_out if hb[var] else share_out > share_in
                grp = 3 if p > 0.05 else (1 if p < 0.01 else 2) if not fav else (5 if p < 0.01 else 4)
                want[(int(wave), var, int(m))] = (grp, bool(fav))
    assert got == want


def test_f_tail_columns_against_numpy(spark):
    """The Column form against an independent evaluation, and NULL wherever the tail is undefined."""
    import math
    rng = np.random.default_rng(7)
    values = [(float(f), float(a), float(b)) for f, a, b in zip(rng.exponential(3.0, 150), rng.choice([1, 2, 5, 17, 400], 150),
                                                                rng.choice([1, 2, 3, 10, 99, 5000], 150))]
    odd = [(0.0, 1.0, 10.0), (None, 1.0, 2.0), (math.nan, 1.0, 2.0), (math.inf, 1.0, 2.0), (-1.0, 1.0, 2.0),
           (1.0, 0.0, 2.0), (1.0, 1.0, 0.0), (None, 1.0, 0.0), (1.0, 1.0, -3.0)]
    df = spark.createDataFrame(values + odd, "f double, d1 double, d2 double")
    got = [r.p for r in df.coalesce(1).select(f_upper(F.col("f"), F.col("d1"), F.col("d2")).alias("p")).collect()]
    want = f_upper_tail(*(np.array([v[k] for v in values]) for k in range(3)))
    assert got[:150] == pytest.approx(list(want), abs=1e-10)
    assert got[150] == 1.0 and got[151:] == [None] * 8


def test_f_tail_keeps_its_digits_for_large_nu(spark):
    """F(1, nu) tends to the square of a normal value; the difference is of the order 1 / nu."""
    import math
    df = spark.createDataFrame([(0.5,), (3.8414588,), (25.0,)], "f double")
    for r in df.select("f", f_upper(F.col("f"), F.lit(1.0), F.lit(1e9)).alias("p")).collect():
        assert r.p == pytest.approx(math.erfc(math.sqrt(r.f / 2)), abs=1e-8)


def test_survey_needs_no_python(spark):
    from areacube.plans import registry as R
    from areacube.plans.explain import plan_text
    from conftest import SF_SMALL
    text = plan_text(R.svy_p_value(spark, SF_SMALL))
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text
