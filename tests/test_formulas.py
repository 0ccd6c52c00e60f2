"""Formula texts of indicators: precedence, references, errors."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from areacube.operators.formulas import FormulaError, evaluate_indicators, formula_levels, read_formulas


@pytest.fixture(scope="module")
def cube(spark):
    return spark.createDataFrame([(1.0, 3.0, 0.0, 2), (None, 3.0, 1.0, 2)], "A_1 double, A_10 double, Z double, `odd-code 1` int")


def values(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_precedence_and_references(cube):
    got = evaluate_indicators(cube, {"share": "((A_1)/(total))*100", "total": "A_1+A_10", "mixed": "A_1 + 2*A_10 - -A_1/4", "odd": "odd-code 1*2", "A_1": None,
                                     "Z": "total*0.5", "chain": "2*(Z+odd)", "zero": "A_10/(A_10-3)"})
    assert got.columns == ["A_1", "A_10", "Z", "odd-code 1", "share", "total", "mixed", "odd", "chain", "zero"]
    assert values(got, "share", "total", "mixed", "odd", "Z", "chain", "zero") == [(25.0, 4.0, 7.25, 4.0, 2.0, 12.0, None), (None, None, None, 4.0, None, None, None)]


def test_levels_follow_references():
    levels = formula_levels(["x"], {"c": "b+a", "b": "a*2", "a": "x", "d": "x"})
    assert [sorted(f.name for f in level) for level in levels] == [["a", "d"], ["b"], ["c"]]


@pytest.mark.parametrize("formulas,message", [
    ({"a": "b", "b": "c", "c": "a"}, "circle"), ({"a": "a+1"}, "circle"), ({"a": "A_1+unknown"}, "unknown"), ({"a": "A_1+"}, "cannot be read"),
    ({"a": "A_1 A_10"}, "cannot be read"), ({"a": "A_1**2"}, "more than arithmetic"), ({"a": "max(A_1)"}, "more than arithmetic"),
    ({"a": "A_1 if Z else 1"}, "more than arithmetic"), ({"a": "'x'"}, "more than arithmetic"), ({"a": "A_1.real"}, "more than arithmetic"),
    ({"base": None}, "lacks"), ({"a": "__0__"}, "__0__")])
def test_errors_name_the_indicator(cube, formulas, message):
    with pytest.raises(FormulaError, match=message):
        evaluate_indicators(cube, formulas)


def test_indicator_table(spark, cube):
    table = spark.createDataFrame([("A_1", None), ("s", "A_1+A_10"), ("t", " ")], "`Indicator code` string, Formula string")
    assert read_formulas(table) == {"A_1": None, "s": "A_1+A_10", "t": None}
    with pytest.raises(FormulaError, match="lacks"):
        evaluate_indicators(cube, table)
    assert values(evaluate_indicators(cube, table.limit(2)), "s") == [(4.0,), (None,)]
    with pytest.raises(FormulaError, match="twice"):
        read_formulas(table.unionByName(table))


numbers = st.sampled_from(["a", "b", "c", "2", "0.5"])
expressions = st.recursive(numbers, lambda x: st.one_of(st.tuples(x, st.sampled_from("+-*/"), x).map("".join), x.map(lambda e: f"({e})"), x.map(lambda e: f"-{e}")), max_leaves=8)


@settings(max_examples=20, deadline=None)
@given(st.lists(expressions, min_size=1, max_size=6))
def test_against_pythons_own_arithmetic(spark, texts):
    df = spark.createDataFrame([(7.0, 3.0, 2.0)], "a double, b double, c double")
    row = evaluate_indicators(df, {f"r{i}": t for i, t in enumerate(texts)}).first()
    for i, t in enumerate(texts):
        try:
            want = eval(t, {}, {"a": 7.0, "b": 3.0, "c": 2.0})
        except ZeroDivisionError:
            assert row[f"r{i}"] is None
        else:
            assert row[f"r{i}"] is None or row[f"r{i}"] == pytest.approx(float(want), rel=1e-12)
