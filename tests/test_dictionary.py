"""JN5-JN8, LBL2-LBL4: recode, decode, dictionaries, user-missing codes (T6)."""

from areacube.operators.dictionary import (decode, encode, keep_known_codes, observed_levels, override,
                                           recode, truncate, user_missing_to_null)
from areacube.sources.fixtures import value_dictionary
from conftest import rows


def test_recode_unmatched_null_and_last_duplicate_wins(spark):
    df = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "x string")
    out = recode(df, "x", [("a", 1), ("b", 2), ("a", 3)], out="code")
    assert rows(out) == sorted([("a", 3), ("b", 2), ("z", None), (None, None)],
                               key=lambda t: (t[0] is None, t[0] or ""))



def test_decode_encode_round_trip(spark):
    d = value_dictionary(spark)
    df = spark.createDataFrame([(1, 5), (2, None)], "geslacht int, gewicht5 int")
    dec = decode(df, truncate(d, "gewicht5", 4), {"geslacht": "geslacht", "gewicht5": "gewicht5"})
    assert rows(dec, "geslacht_label", "gewicht5_label") == [("Man", None), ("Vrouw", None)]
    enc = encode(dec.select("geslacht_label"), d, {"geslacht_label": "geslacht"})
    assert rows(enc) == [(1,), (2,)]


def test_keep_known_codes(spark):
    d = value_dictionary(spark)
    df = spark.createDataFrame([(1,), (7,), (None,)], "geslacht int")
    assert rows(keep_known_codes(df, d, {"geslacht": "geslacht"})) == [(1,), (None,), (None,)]


def test_override_and_observed_levels(spark):
    d = override(value_dictionary(spark), "geslacht", {"Man": 1, "Vrouw": 2})
    assert rows(d.where("variable = 'geslacht'"), "code", "label", "ord") == [(1, "Man", 1), (2, "Vrouw", 2)]
    data = spark.createDataFrame([(1,), (1,), (None,)], "g int")
    assert rows(observed_levels(d, data, "geslacht", "g"), "code") == [(1,)]


def test_user_missing_to_null(spark):
    df = spark.createDataFrame([(9, 9), (1, 9), (None, 0)], "a int, b int")
    assert rows(user_missing_to_null(df, {"a": [9]})) == [(1, 9), (None, 0), (None, 9)]


def test_lookup_is_a_join_with_unique_keys(spark):
    import pytest

    from areacube.operators.dictionary import lookup
    t = spark.range(50).selectExpr("cast(id as string) k", "id v").unionByName(spark.createDataFrame([(None, 7)], "k string, v long"))
    df = spark.createDataFrame([("3", 1), ("x", 2), (None, 3)], "k string, out int")
    assert rows(lookup(df, t, {"k": "k"}, "v", "found"), "k", "found") == rows(
        spark.createDataFrame([("3", 3), ("x", None), (None, None)], "k string, found long"))
    dup = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    with pytest.raises(Exception, match="listed twice: a"):
        lookup(spark.createDataFrame([("a",)], "k string"), dup, {"k": "k"}, "v", "found").collect()
