"""Weight job: properties PT1-PT4, the pre-flight check (D17), cubes."""

import pytest
from pyspark.sql import functions as F

from areacube.plans import registry as R
from areacube.plans import weight as W
from areacube.sources import fixtures as fx
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def cells(spark):
    return R.weight_cells(spark, SF_SMALL)


@pytest.fixture(scope="module")
def members(spark):
    return fx.region_members(spark, SF_SMALL)


def test_totals_equal_at_every_grain(cells, members):
    # PT3: the number of children is the same at every grain
    total = cells.agg(F.sum("n")).first()[0]
    for name in ("g1", "g2", "g3", "g4", "g13"):
        t = W.grain_table(cells, W.grains()[name], members=members)
        assert t.agg(F.sum("n")).first()[0] == total, name


def test_class_shares_sum_to_100(cells, members):
    # PT2: shares of a non-empty group add up to 100
    g2 = W.grain_table(cells, W.grains()["g2"], members=members)
    sums = (g2.where("n_total > 0").groupBy("gemeentekind", "geslacht", "lftkompas", "eindjaar")
            .agg(F.sum("perc").alias("s")).collect())
    assert sums and all(abs(r.s - 100.0) < 1e-9 for r in sums)


def test_grid_is_full_product(cells, members):
    # PT4: rows = areas x sexes x ages x years x classes
    g2 = W.grain_table(cells, W.grains()["g2"], members=members)
    d = {c: g2.select(c).distinct().count() for c in ("gemeentekind", "geslacht", "lftkompas", "eindjaar", "gewicht5")}
    prod = 1
    for v in d.values():
        prod *= v
    assert g2.count() == prod


def test_overweight_equals_sum_of_two_classes(cells, members):
    # PT1: perc_ma(class 1) + perc_ma(class 2) == perc_ma(overweight yes), zero-filled tables
    g5 = W.grain_table(cells, W.grains()["g5"], members=members, zero_fill=True)
    g14 = W.grain_table(cells, W.grains()["g14"], members=members, zero_fill=True)
    a = (g5.where(F.col("gewicht5").isin(1, 2)).groupBy("gemeentekind", "geslacht", "eindjaar")
         .agg(F.sum("perc_ma").alias("a")))
    b = g14.where(F.col("tezwaar") == "Ja").select("gemeentekind", "geslacht", "eindjaar", F.col("perc_ma").alias("b"))
    j = a.join(b, ["gemeentekind", "geslacht", "eindjaar"], "full").collect()
    assert j
    for r in j:
        if r.a is None or r.b is None:
            assert r.a is None and r.b is None
        else:
            assert abs(r.a - r.b) < 1e-9


def test_unreadable_school_year_stops(spark):
    df = spark.createDataFrame([("20x0-2021", 1, 1, 1, "r", "g", "w", "Ja")],
                               "schooljaar string, geslacht int, lftkompas int, gewicht5 int, regiokind string, "
                               "gemeentekind string, wijkkind string, tezwaar string")
    with pytest.raises(Exception, match="unreadable school year"):
        W.prepare(df).collect()


def test_class_five_merged(spark):
    df = spark.createDataFrame([("2020-2021", 5)], "schooljaar string, gewicht5 int")
    r = W.prepare(df, W.COLS).first()
    assert (r.gewicht5, r.eindjaar) == (4, 2021)


def test_cube_columns(spark):
    cube = R.cube_municipality_q(spark, SF_SMALL)
    assert cube.columns == ["Jaar", "geolevel", "geoitem", "JG_Geslacht", "JG_Lftklasse", "JG_Gewicht_1",
                            "JG_Gewicht_2", "JG_Gewicht_3", "JG_Gewicht_4", "JG_Gewicht_NA"]
    # one row per (year, area, sex, age)
    assert cube.count() == cube.select("Jaar", "geoitem", "JG_Geslacht", "JG_Lftklasse").distinct().count()


def test_stub_years_follow_the_member_list(spark):
    # district grain: years without data are added only if a member municipality has districts
    cells = spark.createDataFrame([("r", "A", "A-1", 1, 1, 2020, 1, "Ja", 2), ("r", "A", "A-1", 1, 1, 2022, 1, "Ja", 1)],
                                  "regiokind string, gemeentekind string, wijkkind string, geslacht int, lftkompas int, "
                                  "eindjaar int, gewicht5 int, tezwaar string, n long")
    g1 = W.grains()["g1"]
    none_observed = spark.createDataFrame([("B",)], "gemeentekind string")
    observed = spark.createDataFrame([("A",)], "gemeentekind string")
    years = lambda m: sorted(r.eindjaar for r in W.grain_table(cells, g1, members=m).select("eindjaar").distinct().collect())
    assert years(none_observed) == [2020, 2022]
    assert years(observed) == [2020, 2021, 2022]
    empty = spark.createDataFrame([], "gemeentekind string")
    g2 = W.grains()["g2"]
    assert sorted(r.eindjaar for r in W.grain_table(cells, g2, members=empty).select("eindjaar").distinct().collect()) == [2020, 2022]


def test_check_grains_in_one_plan_equal_per_grain_tables(spark, cells, members):
    from areacube.plans.explain import exchange_count
    together = W.check_grains(cells, members)
    assert exchange_count(together) == 3
    got = {}
    for r in together.collect():
        got[(r.grain, r.regiokind, r.gemeentekind, r.geslacht, r.lftkompas, r.eindjaar, r.gewicht5)] = \
            (r.n, r.perc, r.n_ma, r.perc_ma)
    want = {}
    for name in ("g5", "g6", "g7", "g8", "g9", "g10", "g11", "g12", "g13"):
        for r in W.grain_table(cells, W.grains()[name], members=members).collect():
            d = r.asDict()
            want[(name, d.get("regiokind"), d.get("gemeentekind"), d.get("geslacht"), d.get("lftkompas"),
                  r.eindjaar, r.gewicht5)] = (r.n, r.perc, r.n_ma, r.perc_ma)
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert all((a is None and b is None) or abs(a - b) < 1e-9 for a, b in zip(v, got[k])), k


def test_unknown_codes_lose_nobody(spark):
    """People with unknown sex, age or class share NULL cells; the cube holds everybody."""
    from areacube.sources import fixtures as fx
    kids = [("1999-2000", sex, age, klass, "R", "A", "A-W0", None)
            for sex in (1, 2, None, 9) for age in (1, None, 8) for klass in (1, 4, 5, None, 6) for _ in range(2)]
    micro = spark.createDataFrame(kids, "schooljaar string, geslacht int, lftkompas int, gewicht5 int, regiokind string, "
                                        "gemeentekind string, wijkkind string, tezwaar string")
    cells = W.known_cells(W.finest_cells(micro), fx.value_dictionary(spark))
    members = spark.createDataFrame([("A",)], "gemeentekind string")
    codes = spark.createDataFrame([("A", 1)], "gemeentenaam string, code int")
    sub = spark.createDataFrame([("R", 1)], "regionaam string, code int")
    cube = W.cube_absolute(cells, members, codes, sub)
    total = sum(F.coalesce(F.sum(c), F.lit(0)) for c in cube.columns if c.startswith("JG_Gewicht_"))
    got = {r.geolevel: r.n for r in cube.groupBy("geolevel").agg(total.alias("n")).collect()}
    assert set(got.values()) == {len(kids)} and len(got) == 3


def test_widen_stops_on_a_second_value(spark):
    import pytest
    from areacube.operators.reshape import widen
    df = spark.createDataFrame([("a", 1, 5), ("a", 1, 6)], "id string, k int, v int")
    with pytest.raises(Exception, match="two rows for one cell"):
        widen(df, ["id"], "k", "v", [1]).collect()
