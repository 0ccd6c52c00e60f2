"""Facts staged by ranges of their area key (SRC3).

``write_keyed`` puts the rows of one range of keys into one folder (a
partition column made of the key's first characters).  ``of_keys`` reads the
facts of listed keys: a list of keys selects folders while the query is
planned, and reaches the Parquet reader as an ``In`` filter; a table of keys
is a semi-join on the range and the key, for which Spark takes the ranges to
read from the key table while the query runs (dynamic partition pruning), if
it broadcasts that table.  Facts without the range column are read whole and
give the same rows.

NULL keys are in no key table's result; an empty key table gives no rows;
repeated keys count once; keys are compared without the blanks around them,
and an empty key is none.  A column named like the range column must be the
one that ``write_keyed`` made.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The partition column of staged facts.
RANGE = "area_range"
#: Characters of a key that name its range: the kind of area and two digits.
RANGE_WIDTH = 4
#: Width to which the source pads its keys.
KEY_WIDTH = 6


def range_of(key: Column) -> Column:
    """The range of a key; the letter before it keeps a numeric range text when Spark infers the folder's type."""
    return F.concat(F.lit("k"), F.substring(F.trim(key), 1, RANGE_WIDTH))


def write_keyed(facts: DataFrame, path: str, key: str = "regios", order: Sequence[str] = ("perioden",),
                files: int | None = None) -> None:
    """Stage facts in folders by key range, sorted by key and ``order`` in each file.

    The rows are dealt by ranges of (key, order, hash of the row), so a key that
    holds a third of them is spread over many tasks and files, and a folder has
    few files of its own.  One exchange; Spark samples the input to set the ranges.
    """
    by = [F.col(key), *[F.col(c) for c in order], F.xxhash64(*facts.columns)]
    dealt = facts.repartitionByRange(files, *by) if files else facts.repartitionByRange(*by)
    (dealt.withColumn(RANGE, range_of(F.col(key))).sortWithinPartitions(RANGE, key, *order)
     .write.mode("overwrite").partitionBy(RANGE).parquet(path))


def both_spellings(keys: Sequence[str], width: int = KEY_WIDTH) -> list[str]:
    """Each key as it is and padded, so an exact ``In`` filter can be pushed down (T7)."""
    found = set()
    for k in keys:
        bare = k.strip()
        if bare:
            found.update((bare, bare.ljust(width)))
    return sorted(found)


def key_rows(keys: DataFrame, key: str = "regios") -> DataFrame:
    """The first column of a key table in both spellings, once each, with its range."""
    bare = F.trim(F.col(keys.columns[0]))
    spelt = keys.select(F.explode(F.array(bare, F.rpad(bare, KEY_WIDTH, " "))).alias(key))
    spelt = spelt.where(F.length(F.trim(key)) > 0)            # an empty key is none
    return spelt.select(range_of(F.col(key)).alias(RANGE), key).distinct()


def of_keys(facts: DataFrame, keys: DataFrame | Sequence[str], key: str = "regios") -> DataFrame:
    """SRC3: the facts of the listed keys, without the range column."""
    staged = RANGE in facts.columns
    if isinstance(keys, DataFrame):
        wanted = key_rows(keys, key)
        if not staged:
            return facts.join(wanted.drop(RANGE), key, "left_semi")
        found = facts.join(wanted, [RANGE, key], "left_semi")
    else:
        spelt = both_spellings(keys)
        found = facts.where(F.col(key).isin(spelt))
        if staged:
            ranges = sorted({"k" + s.strip()[:RANGE_WIDTH] for s in spelt})
            found = found.where(F.col(RANGE).isin(ranges))
    return found.drop(RANGE)
