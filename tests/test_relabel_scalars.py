"""PRJ6-PRJ8, STR*, LBL5, LBL7-LBL8, DAT*, MET6-MET7 (trap T5)."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from areacube.functions import scalars as S
from areacube.operators.derive import add_derived, suppress, weight_class_indicators
from areacube.operators.relabel import (clean_label_col, clean_label_text, clean_field_labels, compose_district,
                                        field_labels, monitor_prefix, pad_district, prefix_columns,
                                        rename_matching, resolve_code_names, resolve_codes, with_labels)
from conftest import rows


def test_clean_label_first_match_only(spark):
    cases = ["BMI (opgeschoond)", "Roken Opgeschoond", "A opgeschoond b opgeschoond c", "geen wijziging", None]
    df = spark.createDataFrame([(c,) for c in cases], "l string")
    got = [r.l for r in df.select(clean_label_col(F.col("l")).alias("l")).collect()]
    assert got == ["BMI", "Roken", "Ab opgeschoond c", "geen wijziging", None]
    assert got == [clean_label_text(c) for c in cases]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="aoO pgeschnd()x", max_size=30), min_size=1, max_size=8))
def test_clean_label_column_matches_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "l string")
    got = [r.l for r in df.select(clean_label_col(F.col("l")).alias("l")).collect()]
    assert got == [clean_label_text(t) for t in texts]


def test_labels_survive_prefix_and_parquet(spark, tmp_path):
    df = with_labels(spark.createDataFrame([(1,)], "x int"), {"x": "Roken (opgeschoond)"})
    df = prefix_columns(clean_field_labels(df), "VO")
    df.write.parquet(str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert field_labels(back) == {"VO_x": "Roken"}


def test_pad_and_compose(spark):
    df = spark.createDataFrame([(1234567, 3, "01"), (None, None, "02"), (12, 42, None), (5, 1, "5")],
                               "NOG_Wijk2020 long, Gemeentecode int, Wijkcode string")
    out = compose_district(pad_district(df))
    assert [tuple(r) for r in out.collect()] == [
        ("1234567", 3, "01", "000301"), (None, None, "02", None), ("000012", 42, None, None), ("000005", 1, "5", None)]
    text = spark.createDataFrame([("0042", "03")], "Gemeentecode string, Wijkcode string")
    assert compose_district(text).first().Wijkcode_volledig == "004203"


def test_rename_and_resolve(spark):
    df = spark.createDataFrame([(1, 2, 3)], "VO_Gemeente int, ind_a int, IND_AB int")
    assert "Gemeentecode" in rename_matching(df, "gemeente", "Gemeentecode").columns
    with pytest.raises(ValueError):
        resolve_code_names(df.columns, ["ind_a"])          # matches ind_a and IND_AB
    assert resolve_code_names(df.columns, ["IND_AB", "none"]) == {"IND_AB": "IND_AB"}
    assert monitor_prefix("/data/Volwassenenmonitor/2024") == "VO"


def test_resolve_codes_equals_brute_force(spark):
    codes = ["ab", "B1", "x", "zz9", "abc"]
    names = ["AB1", "xab", "q_ABC_1", "none", "zz", "ab"]
    c = spark.createDataFrame([(x,) for x in codes], "code string")
    v = spark.createDataFrame([(x,) for x in names], "variable string")
    got = rows(resolve_codes(c, v))
    want = sorted((k, n, sum(k.lower() in m.lower() for m in names)) for k in codes for n in names
                  if k.lower() in n.lower())
    assert got == want


def test_resolve_codes_by_pattern(spark):
    import re
    codes = ["a.1", "^vo_", "x+y", "[ab]cd", "colou?r", "z{2}q", r"\\d9", "Ab", "end$", "é", "same", None, "q.*end"]
    codes = [c and c.replace("\\\\", "\\") for c in codes]
    names = ["VO_a01", "va_1", "xxy", "bcd", "COLOR", "colour", "zzq", "49", "weekend", "CAFÉ", "same", "SAME", None, "", "q_end"]
    c = spark.createDataFrame([(x,) for x in codes], "code string")
    v = spark.createDataFrame([(x,) for x in [*names, "same"]], "variable string")
    want = [(k, n, sum(bool(re.search(k, m, re.I)) for m in names if m is not None))
            for k in codes if k for n in names if n is not None and re.search(k, n, re.I)]
    assert rows(resolve_codes(c, v)) == sorted(want)
    with pytest.raises(Exception, match="code without fixed text"):
        resolve_codes(spark.createDataFrame([("(a|b)",)], "code string"), v).collect()


def test_code_pieces_are_linear_in_the_names(spark):
    """Pieces per name: at most three a character, whatever the codes' lengths."""
    from areacube.operators.relabel import GRAM, _grams
    df = spark.createDataFrame([("abcdefgh" * 40,), ("x" * 500,), ("ab",), ("",)], "v string")
    got = df.select("v", F.size(_grams(F.col("v"), range(1, GRAM + 1))).alias("n")).collect()
    assert all(r.n <= GRAM * len(r.v) for r in got) and [r.n for r in got] == [24, 3, 3, 0]


def test_long_codes_join_on_more_than_half_of_their_text(spark):
    from areacube.operators.relabel import _piece_length, _piece_lengths
    df = spark.createDataFrame([(n,) for n in (1, 2, 3, 4, 7, 8, 15, 16, 31, 32, 33)], "n int")
    got = {r.n: (r.one, r.all) for r in df.select("n", _piece_length(F.col("n")).alias("one"), _piece_lengths(F.col("n")).alias("all")).collect()}
    assert [got[n][0] for n in sorted(got)] == [1, 2, 3, 4, 4, 8, 8, 16, 16, 32, 32]
    assert got[2][1] == [1, 2] and got[4][1] == [1, 2, 3, 4] and got[31][1] == [1, 2, 3, 4, 8, 16]
    # names of many codes' common pieces, codes of every length, one within another
    base = "standardpolishedtin"
    codes, names = [base[:k] + str(i) for k in (1, 4, 9, 19) for i in range(0, 60, 3)], [f"VO_{base.upper()}{i}" for i in range(200)]
    out = rows(resolve_codes(spark.createDataFrame([(c,) for c in codes], "code string"), spark.createDataFrame([(n,) for n in names], "variable string")))
    found = {c: [n for n in names if c in n.lower()] for c in codes}
    assert out == sorted((c, n, len(f)) for c, f in found.items() for n in f)


def test_scalars(spark):
    df = spark.createDataFrame([("2020JJ00", "2020-2021", "GM0042", " 12 ", "Hoger = gunstig")],
                               "p string, sj string, k string, num string, r string")
    r = df.select(S.period_year(F.col("p")).alias("y"), S.period_frequency(F.col("p")).alias("f"),
                  S.period_date(F.col("p")).alias("d"), S.school_end_year(F.col("sj")).alias("e"),
                  S.first_digits(F.col("k")).alias("fd"), S.as_number(F.col("num"), "int").alias("n"),
                  S.capture(F.col("r"), r".*= (\w+)").alias("c"),
                  S.capture(F.col("k"), r"= (\w+)").alias("nc")).first()
    assert (r.y, r.f, str(r.d), r.e, r.fd, r.n, r.c, r.nc) == (2020, "Y", "2020-01-01", 2021, "0042", 12, "gunstig", None)


def test_derived_and_suppression(spark):
    df = spark.createDataFrame([(10.0, 20.0, 30.0, 40.0), (1.0, 1.0, 1.0, 1.0), (0.0, 0.0, 0.0, 0.0)],
                               "JG_Gewicht_1 double, JG_Gewicht_2 double, JG_Gewicht_3 double, JG_Gewicht_4 double")
    out = add_derived(df, weight_class_indicators())
    r = out.collect()
    assert r[0].JG_Gewicht_totaal == 100.0 and r[0].JG_Gewicht_1_perc == 10.0 and r[0].JG_Overgewicht_perc == 30.0
    assert r[2].JG_Gewicht_1_perc is None
    s = suppress(out, {"JG_Gewicht_1_perc": "JG_Gewicht_totaal"}).collect()
    assert s[0].JG_Gewicht_1_perc == 10.0 and s[1].JG_Gewicht_1_perc is None


def test_r_ifelse_null_condition(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "c boolean")
    got = [r.x for r in df.select(S.r_ifelse(F.col("c"), F.lit(1), F.lit(0)).alias("x")).collect()]
    assert got == [1, 0, None]


def test_cube_for_one_indicator(spark):
    from areacube.plans.significance import cube_for
    long = spark.createDataFrame([(2024, "gemeente", 3, "vo_ind_a", 5), (2024, "gemeente", 3, "vo_ind_b", 1)],
                                 "Jaar int, geolevel string, geoitem int, var string, pgroep int")
    out = cube_for(long, "vo_ind_a")
    assert out.columns == ["Jaar", "geolevel", "geoitem", "vo_ind_a_pgroep"]
    assert [tuple(r) for r in out.collect()] == [(2024, "gemeente", 3, 5)]
