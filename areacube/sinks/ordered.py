"""Tables written in order (SRT1).

``write_ordered`` deals the rows to files by ranges of the sort columns and
sorts each file, so file after file is the table in order, and a reader that
filters on the first sort columns skips files and row groups by the minima
and maxima in their footers.  NULL sorts first.  Rows that are equal in the
sort columns may lie in several files: the last range key is a hash of the
row, so a period or area that holds a third of the rows does not become one
task.  An empty table gives files without rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of a row group: small enough that a file of several periods has several groups.
GROUP_BYTES = 32 << 20


def in_order(df: DataFrame, by: Sequence[str], files: int | None = None) -> DataFrame:
    """The rows dealt by ranges of ``by`` and sorted in each partition (one exchange; Spark
    reads ``df`` once more to sample the ranges, so cut a long lineage before)."""
    if not by:
        raise ValueError("no sort columns")
    keys = [*[F.col(c) for c in by], F.xxhash64(*df.columns)]
    dealt = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    return dealt.sortWithinPartitions(*by)


def write_ordered(df: DataFrame, path: str, by: Sequence[str], files: int | None = None,
                  group_bytes: int = GROUP_BYTES) -> None:
    """SRT1: ``df`` as Parquet in the order of ``by``."""
    in_order(df, by, files).write.mode("overwrite").option("parquet.block.size", group_bytes).parquet(path)
