"""Job 3: vaccinated count and population per year x area level x vaccine.

One scan of the fact table serves all three levels: municipalities (the
keys of the region's members), the region and the country (literal keys,
in both padded and unpadded form).  Member keys given as a list reach the
Parquet reader; a key table and the label list are equi-joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areacube.functions.scalars import as_number, from_position, period_year
from areacube.operators.dictionary import lookup, recode
from areacube.plans.portal import LEVEL_COUNTRY, LEVEL_MUNICIPALITY, LEVEL_REGION
from areacube.sources.keyed import both_spellings as padded  # noqa: F401
from areacube.sources.keyed import of_keys
from areacube.sources.tables import local_table

# The vaccine types of the cube; the code of a type is its position.
VACCINE_TYPES = [
    "DKTP basisimmuun (2 jaar)", "Hib volledig (2 jaar)", "BMR basisimmuun (2 jaar)",
    "MenC/ACWY basisimmuun (2 jaar)", "Pneumokokken volledig (2 jaar)", "Hepatitis B volledig (2 jaar)",
    "D(K)TP volledig (10 jaar)", "BMR volledig (10 jaar)", "HPV volledig (14 jaar)",
    "MenACWY volledig (cohorten 2001-2005)", "MenACWY volledig (15 jaar)", "Geen enkele vaccinatie (2 jaar)",
    "HPV volledig meisjes (11 jaar)", "HPV volledig jongens (11 jaar)", "D(K)TP voldoende beschermd (5 jaar)",
]
VACCINE_CODES = {name: i + 1 for i, name in enumerate(VACCINE_TYPES)}

def read_facts(facts: DataFrame, region: str = "regios", keys: DataFrame | None = None,
               literal_keys: Sequence[str] | None = None) -> DataFrame:
    """SRC3: facts of the listed areas only.

    Literal keys become an ``In`` filter on the raw column (pushed to the
    Parquet reader); a key table becomes a semi-join on both spellings of its
    keys.  Facts staged by ``write_keyed`` are read only in the keys' folders, in both forms.
    """
    if keys is not None:
        if literal_keys is not None:
            top = local_table(facts.sparkSession, [(k,) for k in literal_keys], "k string")
            keys = keys.select(F.col(keys.columns[0]).alias("k")).unionByName(top)
        return of_keys(facts, keys, region)
    return facts if literal_keys is None else of_keys(facts, literal_keys, region)


def with_measures(facts: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """JN7, DAT2, STR10, CND3, STR1/MTH3: year, trimmed area, label, merged measures, code."""
    facts = (lookup(facts, labels, {"vaccinaties": "key"}, "title", "__label") if labels is not None
             else facts.withColumn("__label", F.col("vaccinaties")))
    return facts.select(
        period_year(F.col("perioden")).alias("Jaar"),
        F.trim(F.col("regios")).alias("Regio"),
        F.col("__label").alias("vaccinaties_label"),
        F.col("populatie_1").alias("Populatie"),
        F.coalesce("gevaccineerdenzonder_4", "gevaccineerdenmet_2").alias("Gevaccineerden"),
        F.coalesce("vaccinatiegraadzonder_5", "vaccinatiegraadmet_3").alias("Vaccinatiegraad"),
        as_number(from_position(F.col("regios"), 3), "int").alias("gemeentecode"))


def vaccination_cube(facts: DataFrame, municipality_keys: DataFrame | Sequence[str], region_key: str,
                     country_key: str, labels: DataFrame) -> DataFrame:
    """FLT1, FLT3, SET1, JN5, D14: the long cube with RVP_* columns.

    One scan, one filter; the level of a row follows from its key.  Region
    and country rows also need a coverage value (D14), municipality rows not.
    Member keys given as a list join the literal ``In`` filter that reaches
    the Parquet reader; given as a table they are a semi-join on the raw key.
    """
    top = [region_key, country_key]
    if isinstance(municipality_keys, DataFrame):
        f = read_facts(facts, keys=municipality_keys, literal_keys=top)
    else:
        f = read_facts(facts, literal_keys=list(municipality_keys) + top)
    f = with_measures(f, labels)
    level = (F.when(F.col("Regio") == region_key.strip(), F.lit(LEVEL_REGION))
             .when(F.col("Regio") == country_key.strip(), F.lit(LEVEL_COUNTRY))
             .otherwise(F.lit(LEVEL_MUNICIPALITY)))
    f = f.withColumn("geolevel", level)
    keep = (F.col("vaccinaties_label").isin(*VACCINE_TYPES) & F.col("Gevaccineerden").isNotNull()
            & ((F.col("geolevel") == LEVEL_MUNICIPALITY) | F.col("Vaccinatiegraad").isNotNull()))
    out = f.where(keep).select(
        "Jaar", "geolevel",
        F.when(F.col("geolevel") == LEVEL_MUNICIPALITY, F.col("gemeentecode")).otherwise(F.lit(1)).alias("geoitem"),
        F.col("vaccinaties_label").alias("RVP_Vaccinatie"),
        F.col("Gevaccineerden").alias("RVP_Gevaccineerden"), F.col("Populatie").alias("RVP_Populatie"))
    return recode(out, "RVP_Vaccinatie", VACCINE_CODES)
