"""AGG1-AGG2, DEN1-DEN3, JN9: counts and the three gap-fill rules."""

import pytest

from areacube.operators.cells import count_cells, count_grains, grouping_id_of, roll_up
from areacube.operators.densify import densify, missing_geo_years
from conftest import rows


def test_count_keeps_null_group(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("a", None), ("b", 1)], "g string, c int")
    assert rows(count_cells(df, ["g", "c"])) == [("a", 1, 1), ("a", None, 2), ("b", 1, 1)]


def test_roll_up_and_grouping_sets(spark):
    df = spark.createDataFrame([("a", 1, 2), ("a", 2, 3), ("b", 1, 5)], "g string, c int, n long")
    assert rows(roll_up(df, ["g"])) == [("a", 5), ("b", 5)]
    out = count_grains(df, {"by_g": ["g"], "by_c": ["c"], "all": []}, ["g", "c"])
    got = {(r.grain, r.g, r.c): r.n for r in out.collect()}
    assert got == {("by_g", "a", None): 5, ("by_g", "b", None): 5, ("by_c", None, 1): 7,
                   ("by_c", None, 2): 3, ("all", None, None): 10}
    assert grouping_id_of(["g"], ["g", "c"]) == 1 and grouping_id_of([], ["g", "c"]) == 3


def _cells(spark):
    # area A observed in 2020 and 2022; B only in 2020; year 2021 unobserved
    return spark.createDataFrame(
        [("A", 1, 2020, 3), ("A", 2, 2022, 1), ("B", 1, 2020, 2)], "g string, c int, y int, n long")


def test_zero_fill_rules(spark):
    out = densify(_cells(spark), ["g"], ["c"], "y", zero_fill=True,
                  extra_geos=spark.createDataFrame([("A",), ("M",)], "g string"), fill_years=True)
    got = {(r.g, r.c, r.y): r.n for r in out.collect()}
    # product: 3 areas x 2 classes x 3 years
    assert len(got) == 18
    assert got[("A", 1, 2020)] == 3 and got[("A", 2, 2022)] == 1
    assert got[("A", 2, 2020)] == 0 and got[("B", 2, 2022)] == 0       # observed area and year
    assert got[("A", 1, 2021)] is None                                 # year without data
    assert all(got[("M", c, y)] is None for c in (1, 2) for y in (2020, 2021, 2022))  # member without data


def test_no_fill_keeps_nulls_and_observed_years_only(spark):
    out = densify(_cells(spark), ["g"], ["c"], "y", zero_fill=False)
    got = {(r.g, r.c, r.y): r.n for r in out.collect()}
    assert {y for (_, _, y) in got} == {2020, 2022}
    assert got[("A", 2, 2020)] is None and got[("B", 1, 2020)] == 2


def test_null_level_is_expanded(spark):
    cells = spark.createDataFrame([("A", None, 2020, 1), ("B", 1, 2020, 1)], "g string, c int, y int, n long")
    got = {(r.g, r.c): r.n for r in densify(cells, ["g"], ["c"], "y").collect()}
    assert got == {("A", None): 1, ("A", 1): 0, ("B", None): 0, ("B", 1): 1}


def test_finer_cells_are_rolled_up(spark):
    fine = spark.createDataFrame([("A", "x", 1, 2020, 2), ("A", "y", 1, 2020, 3)], "g string, w string, c int, y int, n long")
    out = densify(fine.select("g", "c", "y", "n"), ["g"], ["c"], "y")
    assert rows(out) == [("A", 1, 2020, 5)]


def test_level_limit_raises(spark):
    cells = spark.createDataFrame([("A", i, 2020, 1) for i in range(5)], "g string, c int, y int, n long")
    with pytest.raises(Exception, match="densify"):
        densify(cells, ["g"], ["c"], "y", max_levels=3).collect()


def test_region_grain_without_area(spark):
    cells = spark.createDataFrame([(1, 2020, 2), (2, 2022, 1)], "c int, y int, n long")
    got = {(r.c, r.y): r.n for r in densify(cells, [], ["c"], "y", fill_years=True).collect()}
    assert got == {(1, 2020): 2, (2, 2020): 0, (1, 2021): None, (2, 2021): None, (1, 2022): 0, (2, 2022): 1}


def test_missing_geo_years(spark):
    members = spark.createDataFrame([("M",)], "g string")
    out = missing_geo_years(_cells(spark), ["g"], "y", members)
    assert rows(out) == sorted([("A", 2021), ("B", 2021), ("B", 2022), ("M", 2020), ("M", 2021), ("M", 2022)])


def test_dictionary_levels_enter_the_grid(spark):
    from areacube.operators.densify import densify, dimension_levels, with_dictionary_levels
    from areacube.operators.dictionary import override
    from areacube.sources.labelled import value_labels, with_value_labels
    data = spark.createDataFrame([("a", 1, None, 2000, 5), ("b", 2, 1, 2001, 7)], "g string, s int, k int, y int, n long")
    data = with_value_labels(data, {"s": [(1, "Man"), (2, "Vrouw")], "k": [(1, "x"), (9, "y")]})
    dictionary = override(value_labels(data), "s", {"Man": 1, "Niet": 3})
    levels = with_dictionary_levels(dimension_levels(data, ["s", "k"], "y"), dictionary, {"s": "s", "k": "k"})
    got = rows(densify(data, ["g"], ["s", "k"], "y", levels=levels))
    want = [(g, s, k, y, {("a", 1, None, 2000): 5, ("b", 2, 1, 2001): 7}.get((g, s, k, y), 0))
            for g in "ab" for s in (1, 2, 3) for k in (None, 1, 9) for y in (2000, 2001)]
    assert got == sorted(want, key=lambda t: tuple((x is None, x if x is not None else 0) for x in t))
    plain = dimension_levels(data, ["s", "k"], "y")
    none = with_dictionary_levels(plain, dictionary.where("variable = 'other'"), {"s": "s"})
    assert rows(densify(data, ["g"], ["s", "k"], "y", levels=none)) == rows(densify(data, ["g"], ["s", "k"], "y", levels=plain))


def test_value_labels_survive_parquet(spark, tmp_path):
    from areacube.sources.labelled import value_labels, with_value_labels
    df = with_value_labels(spark.createDataFrame([(1, "x")], "s int, t string"), {"s": [(2, "Vrouw"), (1, "Man")]})
    df.write.parquet(str(tmp_path / "d"))
    assert rows(value_labels(spark.read.parquet(str(tmp_path / "d")))) == [("s", 1, "Man", 2), ("s", 2, "Vrouw", 1)]
    assert value_labels(df.select("t")).collect() == []
