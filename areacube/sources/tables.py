"""Parquet table access with explicit column lists (SRC1, SRC3, SRC4).

Every reader names the columns it needs, so the scan's ``ReadSchema`` holds
only those; filters written on the result reach the Parquet reader as
``PushedFilters``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Iterable[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    if columns is not None:
        df = df.select(*columns)
    return df


def local_table(spark: SparkSession, rows, schema) -> DataFrame:
    """A small parameter table (dictionary, indicator list, code list) as an
    inline table.

    ``createDataFrame`` on a Python list gives an RDD scan of unknown size, so
    the planner treats it as large and shuffles both sides of every join with
    it.  An inline table carries its exact size in the plan: joins with it
    are broadcast hash joins without a hint, bounded by the rows given here.
    """
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    rows = list(rows)
    if not rows:
        return spark.createDataFrame([], schema)
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, schema.fields)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
