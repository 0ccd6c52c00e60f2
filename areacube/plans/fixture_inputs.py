"""The jobs' inputs from the test tables, as DataFrames or staged in a folder."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from areacube.plans import jobs as J
from areacube.plans import significance as SG
from areacube.plans import vaccination as V
from areacube.sources import fixtures as fx
from areacube.sources.labelled import with_user_missing, write_labelled
from areacube.sources.tables import read_table

# Area keys of the fixtures' region and country.
REGION_KEY, COUNTRY_KEY = "GG0001", "NL01  "


def fixture_inputs(spark: SparkSession, sf_dir: str, job: str):
    if job == "weight":
        regions = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
        return J.WeightInputs(
            fx.weight_microdata(spark, sf_dir), fx.value_dictionary(spark), fx.area_codes(spark, sf_dir), fx.region_members(spark, sf_dir),
            regions.select(F.col("r_name").alias("regionaam"), (F.col("r_regionkey") + 1).alias("code")))
    if job == "significance":
        return J.SignificanceInputs(fx.survey_microdata(spark, sf_dir), fx.indicator_list(spark), fx.survey_municipalities(spark, sf_dir),
                                    SG.SurveyDesign(user_na=fx.SURVEY_USER_NA))
    if job == "vaccination":
        return J.VaccinationInputs(fx.vaccination_facts(spark, sf_dir), fx.member_area_keys(spark, sf_dir),
                                   fx.vaccine_labels(spark, sf_dir, V.VACCINE_TYPES), REGION_KEY, COUNTRY_KEY)
    data = fx.monitor_file(spark, sf_dir).withColumnsRenamed(
        {"nog_wijk2020": "NOG_Wijk2020", "gemeentecode": "Gemeentecode", "wijkcode": "Wijkcode"})
    return J.RelabelInputs(data, "monitor", "VO")


def stage_fixtures(spark: SparkSession, sf_dir: str, folder: str, job: str) -> None:
    """The same inputs written in the layout that ``jobs.staged_inputs`` reads."""
    i = fixture_inputs(spark, sf_dir, job)

    def parameters(**values) -> None:
        spark.createDataFrame([(json.dumps(values),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/parameters.json")
    if job == "weight":
        write_labelled(i.microdata, i.dictionary, f"{folder}/microdata")
        tables = {"areas": i.areas, "members": i.members, "subregions": i.subregions}
    elif job == "significance":
        write_labelled(with_user_missing(i.survey, fx.SURVEY_USER_NA), None, f"{folder}/survey", partition_by=["vo_wave"])
        i.indicators.withColumnsRenamed({"code": "Code", "richting": "Richting"}).coalesce(1).write.mode("overwrite") \
            .option("header", True).csv(f"{folder}/indicators.csv")
        tables = {"municipalities": i.municipalities}
    elif job == "vaccination":
        tables = {"facts": i.facts, "member_keys": i.member_keys, "labels": i.labels}
        parameters(region_key=i.region_key, country_key=i.country_key)
    else:
        write_labelled(i.data, None, f"{folder}/monitor")
        tables = {}
        parameters(prefix=i.prefix)
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
