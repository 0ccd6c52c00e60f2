"""Value dictionaries: recode, decode, code lists (JN5-JN8, LBL1-LBL4, DM2, DM5).

A dictionary is a long DataFrame ``(variable, code, label, ord)``.  A lookup is
a left equi-join on its entries, whose keys are checked to be unique; Spark
chooses the physical join by the table's size.  Small literal mappings given
as Python dicts become a ``map`` literal.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def recode(df: DataFrame, col: str, mapping: Mapping | Iterable[tuple], out: str | None = None) -> DataFrame:
    """JN5/UDF1 with a literal mapping: unmatched -> NULL, NULL -> NULL.

    A later duplicate key wins, as in the reference's loop.
    """
    items = dict(mapping.items() if isinstance(mapping, Mapping) else mapping)
    if not items:
        return df.withColumn(out or col, F.lit(None))
    m = F.create_map(*[F.lit(x) for kv in items.items() for x in kv])
    return df.withColumn(out or col, F.try_element_at(m, F.col(col)))


def _entries(dictionary: DataFrame, variable: str) -> DataFrame:
    return dictionary.where(F.col("variable") == variable)


def lookup(df: DataFrame, table: DataFrame, on: Mapping[str, str], value: str, out: str) -> DataFrame:
    """JN2-JN7: ``df`` with ``out``, the ``value`` of the table row whose keys match; NULL if none does.

    ``on`` maps columns of ``df`` to key columns of ``table``.  A key that the
    table lists twice stops the job instead of duplicating rows (D11).  A
    plain equi-join: Spark broadcasts the table when it is small.
    """
    keys = [f"__key{i}" for i in range(len(on))]
    entries = table.select(*[F.col(k).alias(h) for k, h in zip(on.values(), keys)], F.col(value).alias("__value"))
    for h in keys:
        entries = entries.where(F.col(h).isNotNull())
    message = F.concat(F.lit("listed twice: "), F.concat_ws(", ", *[F.col(h).cast("string") for h in keys]))
    once = F.when(F.count(F.lit(1)) > 1, F.raise_error(message)).otherwise(F.first("__value"))
    entries = entries.groupBy(*keys).agg(once.alias("__value"))
    match = None
    for c, h in zip(on, keys):
        same = F.col(c) == F.col(h)
        match = same if match is None else match & same
    df = df.drop(out)
    return df.join(entries, match, "left").select(*df.columns, F.col("__value").alias(out))


def decode(df: DataFrame, dictionary: DataFrame, columns: Mapping[str, str],
           suffix: str = "_label") -> DataFrame:
    """JN6/JN7: add ``<col><suffix>`` with the label of each coded column.

    ``columns`` maps a data column to its dictionary variable.  Codes without a
    label give NULL.
    """
    for col, var in columns.items():
        df = lookup(df, _entries(dictionary, var), {col: "code"}, "label", col + suffix)
    return df


def encode(df: DataFrame, dictionary: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """JN5 on labels: replace each label column by its code (unmatched -> NULL)."""
    order = df.columns
    for col, var in columns.items():
        df = lookup(df, _entries(dictionary, var), {col: "label"}, "code", "__code").drop(col).withColumnRenamed("__code", col)
    return df.select(*order)


def keep_known_codes(df: DataFrame, dictionary: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """The code form of JN5: codes absent from the dictionary become NULL."""
    order = df.columns
    for col, var in columns.items():
        df = lookup(df, _entries(dictionary, var), {col: "code"}, "code", "__code").drop(col).withColumnRenamed("__code", col)
    return df.select(*order)


def override(dictionary: DataFrame, variable: str, entries: Mapping[str, int]) -> DataFrame:
    """LBL2: replace the entries of one variable (label -> code, order as given)."""
    from areacube.sources.tables import local_table
    new = local_table(dictionary.sparkSession,
                      [(variable, int(code), label, i + 1) for i, (label, code) in enumerate(entries.items())],
                      dictionary.schema)
    return dictionary.where(F.col("variable") != variable).unionByName(new)


def truncate(dictionary: DataFrame, variable: str, keep: int) -> DataFrame:
    """LBL3: keep the first ``keep`` entries of one variable."""
    return dictionary.where((F.col("variable") != variable) | (F.col("ord") <= keep))


def observed_levels(dictionary: DataFrame, data: DataFrame, variable: str, col: str) -> DataFrame:
    """FCT1/JN8/LBL6: the dictionary entries of ``variable`` whose code occurs in ``data``."""
    present = data.select(F.col(col).alias("code")).where(F.col("code").isNotNull()).distinct()
    return _entries(dictionary, variable).join(present, "code", "left_semi")


def user_missing_to_null(df: DataFrame, user_na: Mapping[str, Sequence]) -> DataFrame:
    """LBL4/DM5: user-defined missing codes become NULL, in one projection."""
    exprs: dict[str, Column] = {}
    for col, codes in user_na.items():
        if codes and col in df.columns:
            kept = F.when(~F.col(col).isin(*codes) | F.col(col).isNull(), F.col(col))
            exprs[col] = kept.alias(col, metadata=df.schema[col].metadata)   # labels survive
    if not exprs:
        return df
    return df.select(*[exprs.get(c, F.col(c)) for c in df.columns])


def dimension_items(entries: DataFrame, code: str = "code", label: str = "label",
                    order: str = "ord") -> DataFrame:
    """MET2: ``Itemcode, Naam, Volgnr`` of one dimension."""
    return entries.select(F.col(code).alias("Itemcode"), F.col(label).alias("Naam"),
                          F.col(order).cast("int").alias("Volgnr"))
