"""Empty inputs give empty results, not errors (scalar subqueries return NULL then)."""

from areacube.operators.densify import densify, missing_geo_years
from areacube.operators.survey import compare_with_rest, p_values, survey_sums
from areacube.plans import vaccination as V
from areacube.plans import weight as W


def test_empty_cells(spark):
    cells = spark.createDataFrame([], "g string, c int, y int, n long")
    assert densify(cells, ["g"], ["c"], "y", fill_years=True).count() == 0
    assert densify(cells, [], ["c"], "y", fill_years=True).count() == 0
    assert missing_geo_years(cells, ["g"], "y").count() == 0


def test_empty_weight_grain(spark):
    cols = ", ".join(f"{c} {t}" for c, t in zip(W.finest_dims(), ["string", "string", "string", "int", "int",
                                                                    "int", "int", "string"]))
    cells = spark.createDataFrame([], cols + ", n long")
    members = spark.createDataFrame([("A",)], "gemeentekind string")
    for g in ("g1", "g2", "g4", "g14"):
        assert W.grain_table(cells, W.grains()[g], members=members).count() == 0


def test_empty_survey(spark):
    df = spark.createDataFrame([], "h int, g int, w double, y int")
    t = p_values(compare_with_rest(survey_sums(df, ["y"], "g", "h", "w"), "g", "h"))
    assert t.count() == 0


def test_empty_vaccination(spark):
    facts = spark.createDataFrame([], "regios string, perioden string, vaccinaties string, populatie_1 double, "
                                      "gevaccineerdenmet_2 double, vaccinatiegraadmet_3 double, "
                                      "gevaccineerdenzonder_4 double, vaccinatiegraadzonder_5 double")
    keys = spark.createDataFrame([], "key string")
    labels = spark.createDataFrame([], "key string, title string")
    assert V.vaccination_cube(facts, keys, "GG0001", "NL01  ", labels).count() == 0
