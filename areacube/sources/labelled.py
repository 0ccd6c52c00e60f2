"""Labelled microdata and parameter tables (SRC1, SRC2, SRC5, SRC7, DM2, DM3, DM5).

The reference reads SPSS files whose columns carry value labels, a variable
label and user-defined missing codes.  Here a labelled dataset is a Parquet
table (labels in ``StructField.metadata``) plus a long value dictionary
``(variable, code, label, ord)`` stored next to it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areacube.operators.dictionary import user_missing_to_null
from areacube.sources.tables import local_table

DICTIONARY_SCHEMA = T.StructType([
    T.StructField("variable", T.StringType()), T.StructField("code", T.IntegerType()),
    T.StructField("label", T.StringType()), T.StructField("ord", T.IntegerType()),
])


def read_labelled(spark: SparkSession, path: str, schema: T.StructType | None = None,
                  user_na: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """SRC1/SRC2: (data, dictionary).  With ``user_na=True`` the codes listed in
    each field's ``metadata["user_na"]`` become NULL (LBL4)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    data = reader.parquet(f"{path}/data")
    dictionary = None                              # a dataset without value labels has no such folder
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/dictionary")
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        dictionary = spark.read.schema(DICTIONARY_SCHEMA).parquet(f"{path}/dictionary")
    if user_na:
        data = user_missing_to_null(data, user_missing_codes(data))
    return data, dictionary


def user_missing_codes(df: DataFrame) -> dict[str, list]:
    """DM5: user-missing codes per column from the field metadata."""
    return {f.name: list(f.metadata["user_na"]) for f in df.schema.fields if f.metadata.get("user_na")}


def with_user_missing(df: DataFrame, codes: Mapping[str, Sequence]) -> DataFrame:
    """Attach user-missing codes to fields (what a labelled reader records)."""
    return df.select(*[F.col(c).alias(c, metadata={**df.schema[c].metadata, "user_na": list(codes[c])})
                       if c in codes else F.col(c) for c in df.columns])


def write_labelled(data: DataFrame, dictionary: DataFrame | None, path: str,
                   partition_by: Sequence[str] = ()) -> None:
    """Stage a labelled dataset.  ``partition_by`` (e.g. the survey wave) lets a
    run that filters on it read only the matching folders (partition pruning)."""
    w = data.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{path}/data")
    if dictionary is not None:
        dictionary.coalesce(1).write.mode("overwrite").parquet(f"{path}/dictionary")


def read_indicator_list(spark: SparkSession, path: str) -> DataFrame:
    """SRC5: the indicator list (Code, Richting) exported as CSV with a header."""
    return (spark.read.option("header", True).schema("Code string, Richting string").csv(path)
            .select(F.col("Code").alias("code"), F.col("Richting").alias("richting")))


def with_value_labels(df: DataFrame, labels: Mapping[str, Sequence[tuple[int, str]]]) -> DataFrame:
    """DM2 in the data itself: value labels (code, label), in order, as field metadata; they survive a Parquet round trip."""
    def marked(c: str) -> dict:
        return {**df.schema[c].metadata, "value_codes": [int(k) for k, _ in labels[c]], "value_labels": [v for _, v in labels[c]]}
    return df.select(*[F.col(c).alias(c, metadata=marked(c)) if c in labels else F.col(c) for c in df.columns])


def value_labels(df: DataFrame) -> DataFrame:
    """LBL1: the value dictionary (variable, code, label, ord) that the fields of ``df`` carry."""
    rows = [(f.name, code, label, k + 1) for f in df.schema.fields
            for k, (code, label) in enumerate(zip(f.metadata.get("value_codes", []), f.metadata.get("value_labels", [])))]
    return local_table(df.sparkSession, rows, "variable string, code int, label string, ord int")


def variable_dictionary(df: DataFrame) -> DataFrame:
    """LBL1 on the schema: (variable, label) of every column."""
    rows = [(f.name, f.metadata.get("label")) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "variable string, label string")
