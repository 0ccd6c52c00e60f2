"""AGG3-AGG4, WIN1-WIN5, RSH1-RSH5, SET1: shares, trailing means, reshape; traps T1-T3."""

from pyspark.sql import functions as F

from areacube.operators.reshape import lengthen, stack_levels, widen
from areacube.operators.smooth import share, smoothed_count, trailing_mean, trailing_mean_by_range
from conftest import rows


def test_share_zero_total_is_null_not_error(spark):
    df = spark.createDataFrame([("a", 1, 0), ("a", 2, 0), ("b", 1, 1), ("b", 2, 3)], "g string, c int, n long")
    got = {(r.g, r.c): (r.n_total, r.perc) for r in share(df, ["g"]).collect()}
    assert got[("a", 1)] == (0, None)             # 0/0 -> NULL (T1), not NaN
    assert got[("b", 2)] == (4, 75.0)


def test_trailing_mean_skips_null_and_is_partial(spark):
    df = spark.createDataFrame([("a", 2000, 1.0), ("a", 2001, None), ("a", 2002, 3.0), ("a", 2003, 5.0),
                                ("a", 2004, 7.0)], "g string, y int, v double")
    got = {r.y: r.v_ma for r in trailing_mean(df, ["v"], ["g"], "y").collect()}
    assert got == {2000: 1.0, 2001: 1.0, 2002: 2.0, 2003: 3.0, 2004: 5.0}


def test_rows_and_range_frames(spark):
    # with a hole in the years only the range frame is calendar-correct (PT5)
    df = spark.createDataFrame([("a", 2000, 1.0), ("a", 2001, 2.0), ("a", 2003, 4.0), ("a", 2005, 8.0)],
                               "g string, y int, v double")
    by_rows = {r.y: r.v_ma for r in trailing_mean(df, ["v"], ["g"], "y").collect()}
    by_range = {r.y: r.v_ma for r in trailing_mean_by_range(df, ["v"], ["g"], "y").collect()}
    assert by_rows[2005] == 15.0 / 4 and by_range[2005] == 6.0
    full = spark.createDataFrame([("a", y, float(y - 1999)) for y in range(2000, 2006)], "g string, y int, v double")
    assert rows(trailing_mean(full, ["v"], ["g"], "y")) == rows(trailing_mean_by_range(full, ["v"], ["g"], "y"))


def test_smoothed_count(spark):
    df = spark.createDataFrame([(50.0, 10)], "perc_ma double, n_total long")
    assert smoothed_count(df).first().n_weighted == 5.0


def test_widen_listed_values_and_null_column(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("a", None, 9.0), ("b", 1, 3.0)],
                               "id string, k int, v double")
    out = widen(df, ["id"], "k", "v", [1, 2, 3], "X_{}", include_null=True)
    assert out.columns == ["id", "X_1", "X_2", "X_3", "X_NA"]
    assert rows(out) == [("a", 1.0, 2.0, None, 9.0), ("b", 3.0, None, None, None)]


def test_lengthen_and_stack(spark):
    df = spark.createDataFrame([(1, 0, 1)], "id int, a int, b int")
    assert rows(lengthen(df, ["id"], ["a", "b"])) == [(1, "a", 0), (1, "b", 1)]
    x = spark.createDataFrame([(1,)], "v int")
    y = spark.createDataFrame([(2,)], "v int")
    assert rows(stack_levels({"l1": x, "l2": y})) == [(1, "l1"), (2, "l2")]


def test_nan_would_break_group_three():
    # T3: a NaN p-value compares as larger than 0.05 in Spark; the build never produces NaN
    from pyspark.sql import SparkSession
    s = SparkSession.getActiveSession()
    assert s.range(1).select((F.lit(float("nan")) > 0.05).alias("x")).first().x is True
