"""Dataset standardisation (PRJ6-PRJ8, STR6, STR8, STR11-STR13, LBL5, LBL7, LBL8).

Column names and variable labels are schema, not data: they are handled at
plan time on ``df.schema`` (labels live in ``StructField.metadata["label"]``
and survive renames and a Parquet round trip).  Where a variable dictionary
is itself a table (thousands of variables across many files), the same rules
run as DataFrame operations: ``clean_labels`` and ``resolve_codes``.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areacube.functions.scalars import zero_pad

# The word removed from variable labels, with an optional
# space before it and one optional character on either side.
CLEAN_PATTERN = r"( |).?opgeschoond.?"

# Folder search term -> column prefix of each monitor.
MONITOR_PREFIX = {"E-MOVO": "J", "Kindermonitor": "KM", "Jongvolwassenenmonitor": "JV",
                  "Volwassenenmonitor": "VO"}


def clean_label_text(label: str | None) -> str | None:
    """STR8 on one label: remove the first match only, case-insensitive."""
    if label is None:
        return None
    return re.sub(CLEAN_PATTERN, "", label, count=1, flags=re.IGNORECASE)


def clean_label_col(c: Column) -> Column:
    """STR8 as a column: ``regexp_replace`` replaces every match, so the text
    before the first match is kept by a lazy prefix group instead."""
    return F.regexp_replace(c, r"(?i)^([\s\S]*?)" + CLEAN_PATTERN, "$1")


def clean_labels(varlabels: DataFrame, label: str = "label") -> DataFrame:
    """LBL5 on a variable dictionary table; NULL labels stay NULL."""
    return varlabels.withColumn(label, clean_label_col(F.col(label)))


def with_labels(df: DataFrame, labels: Mapping[str, str | None]) -> DataFrame:
    """DM3: attach variable labels as field metadata."""
    return df.select(*[F.col(c).alias(c, metadata={**df.schema[c].metadata, "label": labels[c]})
                       if labels.get(c) is not None else F.col(c) for c in df.columns])


def field_labels(df: DataFrame) -> dict[str, str | None]:
    return {f.name: f.metadata.get("label") for f in df.schema.fields}


def clean_field_labels(df: DataFrame) -> DataFrame:
    """LBL5 on the schema: columns without a label are skipped."""
    cleaned = {k: clean_label_text(v) for k, v in field_labels(df).items() if v is not None}
    return with_labels(df, cleaned)


def prefix_columns(df: DataFrame, prefix: str, sep: str = "_") -> DataFrame:
    """PRJ6: every column gets ``{prefix}{sep}``; labels are kept."""
    return df.withColumnsRenamed({c: f"{prefix}{sep}{c}" for c in df.columns})


def matching_columns(columns: Sequence[str], code: str) -> list[str]:
    """STR6: columns in whose name the pattern ``code`` is found, ignoring case."""
    pat = re.compile(code, re.IGNORECASE)
    return [c for c in columns if pat.search(c)]


def rename_matching(df: DataFrame, part: str, new: str) -> DataFrame:
    """PRJ8: rename the one column whose name contains ``part`` (any case)."""
    found = matching_columns(df.columns, re.escape(part))
    if len(found) > 1:
        raise ValueError(f"more than one column matches {part!r}: {found}")
    return df.withColumnRenamed(found[0], new) if found else df


def resolve_code_names(columns: Sequence[str], codes: Sequence[str]) -> dict[str, str]:
    """PRJ7 on a schema: code -> the one matching column; no match drops the code."""
    out = {}
    for code in codes:
        found = matching_columns(columns, code)
        if len(found) > 1:
            raise ValueError(f"indicator {code!r} matches several columns: {found}")
        if found:
            out[code] = found[0]
    return out


#: Texts of up to so many characters are joined on as a whole, longer ones on their pieces of the largest power of two that fits.
GRAM = 3

# A pattern without its parts that stand for no fixed text: escapes, classes, a character before an optional quantifier, other signs.
_OPEN = r"\\.|\[\^?\]?[^\]]*\]|[^\\\[\](){}|^$*+?.](?:[*?]|\{[^}]*\})|\{[^}]*\}|[.^$*+?{}]"


def _grams(text: Column, lengths: Sequence[int | Column]) -> Column:
    """All distinct pieces of the given lengths of a text, as an array."""
    def of(n: int | Column) -> Column:
        last = F.char_length(text) - n + 1
        return F.when(last >= 1, F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(text, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(*[of(n) for n in lengths]))


def _power(length: Column) -> Column:
    """The exponent of the largest power of two that is not above a length (above 0)."""
    return F.char_length(F.bin(length.cast("long"))) - 1


def _piece_length(length: Column) -> Column:
    """The length of the pieces that a text of a length (above 0) is joined on."""
    return F.when(length <= GRAM, length).otherwise(F.pow(F.lit(2), _power(length)).cast("int"))


def _piece_lengths(length: Column) -> Column:
    """All lengths of pieces that are not above a length, as an array."""
    powers = F.transform(F.sequence(F.lit(2), _power(length)), lambda k: F.pow(F.lit(2), k).cast("int"))
    return F.when(length <= GRAM, F.sequence(F.lit(1), length)).otherwise(F.concat(F.sequence(F.lit(1), F.lit(GRAM)), powers))


def anchor_text(code: Column) -> Column:
    """The longest fixed text that every match of a pattern holds (lower case; the code itself if it is
    plain text).  Empty for patterns with groups or alternatives."""
    runs = F.split(F.regexp_replace(code, _OPEN, "\u0000"), "\u0000")
    longest = F.array_max(F.transform(runs, lambda r: F.struct(F.char_length(r).alias("n"), r.alias("r"))))["r"]
    return F.lower(F.when(code.rlike(r"[(|]"), F.lit("")).otherwise(longest))


def resolve_codes(codes: DataFrame, variables: DataFrame, code: str = "code", variable: str = "variable") -> DataFrame:
    """PRJ7 as a join: (code, variable) for every variable in whose name the code
    (a pattern, any case) is found, plus ``n_matches`` per code.

    Anchored containment: a code's fixed text is cut into its distinct pieces of one length,
    more than half of that text (all of it up to ``GRAM`` characters); a name is cut likewise,
    for each such length that some code has.  A code is joined on the one of its pieces that
    the fewest names hold (pieces go by their hashes), and the pair is then verified with the pattern.
    Cutting multiplies rows, which size estimates miss, so these joins sort and do not broadcast.
    A pattern without any fixed text (only classes, groups or alternatives) stops the job.
    NULL codes and names match nothing.
    """
    anchor, text, size, piece = F.col("__anchor"), F.col("__text"), F.col("__size"), ["__size", "__piece"]
    message = F.concat(F.lit("code without fixed text: "), F.col(code))

    def cut(df: DataFrame, key: str, of: Column) -> DataFrame:
        grams = df.select(key, "__size", F.explode(_grams(of, [size])).alias("__gram"))
        return grams.select(key, "__size", F.xxhash64("__gram").alias("__piece"))

    own = (codes.select(code).where(F.col(code).isNotNull()).distinct().withColumn("__anchor", anchor_text(F.col(code)))
           .withColumn("__anchor", F.when(F.char_length(anchor) == 0, F.raise_error(message)).otherwise(anchor))
           .withColumn("__size", _piece_length(F.char_length(anchor))))
    sizes = own.select("__size").distinct()                              # at most GRAM + 29 rows
    names = (variables.select(variable).distinct().withColumn("__text", F.lower(F.col(variable))).where(F.char_length(text) > 0)
             .select("*", F.explode(_piece_lengths(F.char_length(text))).alias("__size")).join(F.broadcast(sizes), "__size"))
    held = cut(names, variable, text)
    rarity = held.groupBy(*piece).agg(F.count(F.lit(1)).alias("__names"))
    rarest = (cut(own, code, anchor).hint("merge").join(rarity, piece).groupBy(code, "__size")
              .agg(F.min(F.struct("__names", "__piece"))["__piece"].alias("__piece")))
    found = rarest.join(held.hint("merge"), piece).where(F.expr(f"`{variable}` rlike concat('(?iu)', `{code}`)")).select(code, variable)
    found = found.distinct()                                             # two pieces of one hash
    matches = found.groupBy(code).agg(F.count(F.lit(1)).alias("n_matches"))
    return found.hint("merge").join(matches, code)


def pad_district(df: DataFrame, col: str = "NOG_Wijk2020", width: int = 6) -> DataFrame:
    """LBL7: zero-padded district code, if the column exists."""
    if col not in df.columns:
        return df
    return df.withColumn(col, zero_pad(F.col(col), width))


def compose_district(df: DataFrame, municipality: str = "Gemeentecode", district: str = "Wijkcode",
                     out: str = "Wijkcode_volledig", width: int = 4, min_length: int = 6) -> DataFrame:
    """LBL8: municipality + district code; text municipality is concatenated,
    numeric is padded to ``width``; shorter than ``min_length`` -> NULL.
    NULL parts give NULL (D8)."""
    m = F.col(municipality)
    if isinstance(df.schema[municipality].dataType, T.StringType):
        full = F.concat(m, F.col(district))
    else:
        full = F.concat(zero_pad(m, width), F.col(district))
    return df.withColumn(out, F.when(F.char_length(full) >= min_length, full))


def monitor_prefix(path: str) -> str:
    """SRC6 glue: the column prefix from the folder name (exactly one term must match)."""
    found = [v for k, v in MONITOR_PREFIX.items() if k in path]
    if len(found) != 1:
        raise ValueError(f"cannot tell the monitor from {path!r}; pass the prefix explicitly")
    return found[0]
