"""Job 2: is a municipality's share different from the rest of the region?

Plan: user-missing -> NULL and column resolution at plan time (schema only);
one unpivot + hash aggregate over the microdata (SVY1, the only big shuffle);
the test statistics from those sums (cell-sized joins); the p-value UDF on
the (indicator x municipality) rows; groups 1-5; a long cube that the sink
partitions by indicator (one file set per indicator, one job).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areacube.operators.dictionary import user_missing_to_null
from areacube.plans.portal import LEVEL_MUNICIPALITY
from areacube.sources.tables import local_table
from areacube.operators.relabel import rename_matching, resolve_code_names
from areacube.operators.survey import (compare_with_rest, p_values, parse_direction,
                                       require_directions, significance_group, survey_sums)


MAX_INDICATORS = 10_000


@dataclass(frozen=True)
class SurveyDesign:
    weight: str = "vo_weight"
    strata: str = "vo_stratum"
    wave: str | None = "vo_wave"        # tests per wave; None: the whole file is one design
    group_part: str = "gemeente"        # the municipality column contains this text
    group: str = "Gemeentecode"
    user_na: Mapping[str, Sequence] = field(default_factory=dict)


def prepared(df: DataFrame, d: SurveyDesign, wave_value=None) -> DataFrame:
    """SRC2/LBL4, FLT4, PRJ8: missing codes to NULL, optional wave, municipality column."""
    df = user_missing_to_null(df, d.user_na)
    if wave_value is not None and d.wave:
        df = df.where(F.col(d.wave) == wave_value)
    return rename_matching(df, d.group_part, d.group)


def directions(indicators: DataFrame) -> dict[str, bool]:
    """SVY5/FLT6: code -> higher is favourable; an unreadable direction stops the job.

    The indicator list is a job parameter of a few dozen rows; it is read to
    the driver because it decides which columns the plan selects.
    """
    rows = require_directions(parse_direction(indicators)).select("code", "hoger_beter").take(MAX_INDICATORS + 1)
    if len(rows) > MAX_INDICATORS:
        raise ValueError(f"indicator list longer than {MAX_INDICATORS} entries")
    return {r["code"]: r["hoger_beter"] for r in rows}


def tests(df: DataFrame, indicator_cols: Sequence[str], d: SurveyDesign,
          groups: DataFrame | None = None) -> DataFrame:
    by = [d.wave] if d.wave else []
    sums = survey_sums(df, indicator_cols, d.group, d.strata, d.weight, by)
    return compare_with_rest(sums, d.group, d.strata, by, groups)


def indicator_columns(df: DataFrame, indicators: DataFrame, d: SurveyDesign) -> dict[str, str]:
    """PRJ7 at plan time: indicator code -> data column (schema and indicator list only)."""
    return resolve_code_names(prepared(df, d).columns, list(directions(indicators)))


def significance(df: DataFrame, indicators: DataFrame, d: SurveyDesign,
                 groups: DataFrame | None = None, wave_value=None, year=None) -> DataFrame:
    """The whole job: long result (Jaar, geolevel, geoitem, var, pgroep, ...)."""
    data = prepared(df, d, wave_value)
    dirs = directions(indicators)
    resolved = resolve_code_names(data.columns, list(dirs))       # PRJ7: code -> column
    cols = sorted(set(resolved.values()))
    t = p_values(tests(data, cols, d, groups))
    spark = df.sparkSession
    hb = local_table(spark, [(col, dirs[code]) for code, col in resolved.items()],
                     "var string, hoger_beter boolean")
    t = significance_group(t.join(hb, "var"))
    jaar = F.col(d.wave) if (d.wave and year is None) else F.lit(year)
    return t.select(jaar.cast("int").alias("Jaar"), F.lit(LEVEL_MUNICIPALITY).alias("geolevel"),
                    F.col(d.group).alias("geoitem"), "var", "pgroep", "gunstig", "p",
                    "perc_gemeente", "perc_rest", "hoger_beter", "is_dichotomous")


def cube_for(long: DataFrame, var: str) -> DataFrame:
    """RSH3: the portal form of one indicator: ``Jaar, geolevel, geoitem, {var}_pgroep``."""
    return (long.where(F.col("var") == var)
            .select("Jaar", "geolevel", "geoitem", F.col("pgroep").alias(f"{var}_pgroep")))
