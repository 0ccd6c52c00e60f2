"""SURVEY T1-T8: the Spark behaviours the library is built around, and how it avoids each."""

import pytest
from pyspark.sql import functions as F

from areacube.functions.scalars import capture, first_digits, zero_pad
from areacube.operators.densify import densify
from areacube.operators.dictionary import recode
from areacube.plans.vaccination import padded


def test_t1_division_by_zero(spark):
    df = spark.createDataFrame([(0.0, 0.0)], "a double, b double")
    if spark.conf.get("spark.sql.ansi.enabled") == "true":
        with pytest.raises(Exception):
            df.select(F.col("a") / F.col("b")).collect()
    assert df.select(F.try_divide("a", "b").alias("x")).first().x is None


def test_t2_avg_over_nan_is_nan_but_null_is_skipped(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "v double")
    assert df.agg(F.avg("v")).first()[0] != df.agg(F.avg("v")).first()[0]       # NaN
    assert df.where(~F.isnan("v")).agg(F.avg("v")).first()[0] == 1.0


def test_t3_nan_compares_greater(spark):
    r = spark.range(1).select((F.lit(float("nan")) > 0.05).alias("nan"),
                              (F.lit(None).cast("double") > 0.05).alias("null")).first()
    assert r.nan is True and r.null is None


def test_t4_null_keys_in_gap_fill(spark):
    # a plain equi-join would lose the NULL class; densify keeps it as a level
    cells = spark.createDataFrame([("A", None, 2020, 2), ("A", 1, 2020, 1)], "g string, c int, y int, n long")
    got = {r.c: r.n for r in densify(cells, ["g"], ["c"], "y").collect()}
    assert got == {None: 2, 1: 1}


def test_t5_padding(spark):
    df = spark.createDataFrame([(1234567,), (None,)], "x long")
    raw = df.select(F.lpad(F.col("x").cast("string"), 6, "0").alias("l"),
                    F.format_string("%06d", F.col("x")).alias("f")).collect()
    assert raw[0].l == "123456" and raw[1].f == "  null"        # truncation and text NULL
    assert [r.z for r in df.select(zero_pad(F.col("x"), 6).alias("z")).collect()] == ["1234567", None]


def test_t6_duplicate_map_keys(spark):
    with pytest.raises(Exception):
        spark.range(1).select(F.create_map(F.lit("a"), F.lit(1), F.lit("a"), F.lit(2))).collect()
    df = spark.createDataFrame([("a",)], "x string")
    assert recode(df, "x", [("a", 1), ("a", 2)]).first().x == 2      # deduplicated, last wins


def test_t7_padded_keys(spark):
    assert padded(["NL01  ", "GG0001"]) == ["GG0001", "NL01", "NL01  "]
    df = spark.createDataFrame([("NL01  ",)], "k string")
    assert df.where(F.col("k") == "NL01").count() == 0 and df.where(F.col("k").isin(padded(["NL01"]))).count() == 1


def test_t8_no_match(spark):
    df = spark.createDataFrame([("abc",)], "s string")
    r = df.select(F.regexp_extract("s", r"(\d+)", 1).alias("e"), first_digits(F.col("s")).alias("d"),
                  capture(F.col("s"), r"= (\w+)").alias("c")).first()
    assert r.e == "" and r.d is None and r.c is None
