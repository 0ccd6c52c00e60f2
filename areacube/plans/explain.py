"""Plan inspection helpers used by tests and the benchmark."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` would print."""
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def main_plan(df: DataFrame) -> str:
    """The formatted plan without its subquery section."""
    return plan_text(df).split("===== Subqueries =====")[0]


def exchange_count(df: DataFrame) -> int:
    """Shuffle exchanges in the main plan (broadcasts not counted)."""
    return len(re.findall(r"^\(\d+\) Exchange", main_plan(df), flags=re.M))


def has_nested_loop_join(df: DataFrame) -> bool:
    t = plan_text(df)
    return "BroadcastNestedLoopJoin" in t or "CartesianProduct" in t
