"""The four jobs end to end, writing cube bundles.

A job takes its inputs as DataFrames and parameters (one dataclass each), so
it runs on any source.  ``staged_inputs`` reads them from a folder of staged
tables, which is what the command line does; ``plans/fixture_inputs.py``
builds them from the test tables.

Each job reads its inputs once and writes every output from shared,
lineage-cut intermediates:

* weight:        one pass over the microdata -> checkpointed cells -> the
                 grain tables -> three cube bundles, the readable table
                 partitioned by municipality, and the check tables (g5-g13 in
                 one plan);
* significance:  one aggregate over the survey -> tests -> the cubes of all indicators in one write;
* vaccination:   one scan of the facts -> one bundle, its data in order;
* relabel:       one projection -> the relabelled copy.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areacube.operators.derive import weight_class_indicators
from areacube.operators.dictionary import dimension_items, truncate
from areacube.plans import significance as SG
from areacube.plans import vaccination as V
from areacube.plans import weight as W
from areacube.plans.relabel import relabel
from areacube.session import materialize
from areacube.sinks.cube import (CubeSpec, Indicator, IndicatorCube, derived_indicator, write_cube, write_indicator_cubes,
                                 write_relabelled)
from areacube.sinks.ordered import in_order
from areacube.sources.labelled import read_indicator_list, read_labelled, value_labels


@dataclass(frozen=True)
class WeightInputs:
    """microdata and its value dictionary; the area code list; the region's
    municipalities (their name in the microdata's municipality column); the
    subregions (regionaam, code)."""
    microdata: DataFrame
    dictionary: DataFrame
    areas: DataFrame
    members: DataFrame
    subregions: DataFrame
    columns: W.WeightColumns = W.COLS


@dataclass(frozen=True)
class SignificanceInputs:
    """survey microdata, the indicator list (code, richting), the municipalities (code)."""
    survey: DataFrame
    indicators: DataFrame
    municipalities: DataFrame
    design: SG.SurveyDesign = SG.SurveyDesign()


@dataclass(frozen=True)
class VaccinationInputs:
    """facts; the keys of the member municipalities; the labels (key, title) of the vaccine types."""
    facts: DataFrame
    member_keys: DataFrame | list[str]
    labels: DataFrame
    region_key: str
    country_key: str


@dataclass(frozen=True)
class RelabelInputs:
    """a labelled dataset, its name and the monitor's prefix."""
    data: DataFrame
    name: str
    prefix: str


# Portal texts of the weight cubes.
WEIGHT_DIMS = [("JG_Geslacht", "Geslacht"), ("JG_Lftklasse", "Leeftijd in 3 groepen")]
WEIGHT_SOURCE = "Jeugdgezondheid"
# Portal texts of the vaccination cube.
VACC_DIMS = [("RVP_Vaccinatie", "Vaccinatietype")]
VACC_VARS = [("RVP_Gevaccineerden", "Aantal gevaccineerde individuen", "Personen"),
             ("RVP_Populatie", "Aantal individuen in de populatie", "Personen")]
VACC_RATE = ("RVP_Vaccinatiegraad", "Percentage gevaccineerden in de populatie", "RVP_Gevaccineerden/RVP_Populatie*100")
VACC_SOURCE = "RIVM"
# Portal texts of the significance cubes.
SIGNIFICANCE_NAME = "Significantie groep"
SIGNIFICANCE_SOURCE = "Gezondheidsmonitor Volwassenen en Ouderen"


def class_labels(dictionary: DataFrame, c: W.WeightColumns = W.COLS) -> dict[int, str]:
    """LBL1: the labels of the weight classes; they name output columns, so the plan needs them."""
    rows = dictionary.where((F.col("variable") == c.klass) & F.col("code").isin(*c.classes)).select("code", "label").collect()
    return {r["code"]: r["label"] for r in sorted(rows, key=lambda r: r["code"])}


def weight_spec(dictionary: DataFrame, absolute: bool = False, columns: W.WeightColumns = W.COLS) -> CubeSpec:
    """MET1-MET6 of the weight cubes (the names, not the codes, of the classes: D7)."""
    labels = class_labels(dictionary, columns)
    items = {code: dimension_items(dictionary.where(F.col("variable") == var)) for (code, _), var in
             zip(WEIGHT_DIMS, [columns.sex, columns.age])}
    if absolute:
        cls = [f"JG_Gewicht_{k}_abs" for k in labels]
        variables = [(c, f"Aantal personen met {labels[k]}", "Personen") for c, k in zip(cls, labels)]
        ind = [Indicator(c, f"Aantal personen met {labels[k]}", "personen") for c, k in zip(cls, labels)]
        total = "+".join(cls)
        ind += [Indicator(f"{c}_perc", f"Percentage personen met {labels[k]}", "percentage", f"({c}/({total}))*100",
                          "Percentage", 1, 50, c) for c, k in zip(cls, labels)]
        return CubeSpec(dims=WEIGHT_DIMS, variables=variables, indicators=ind, source=WEIGHT_SOURCE, dim_items=items)
    derived = {x.name: x for x in weight_class_indicators(classes=tuple(labels))}
    variables = [(f"JG_Gewicht_{k}", f"Aantal personen met {v}", "Personen") for k, v in labels.items()]
    ind = [Indicator(f"JG_Gewicht_{k}", f"Aantal personen met {v}", "personen") for k, v in labels.items()]
    ind.append(derived_indicator(derived["JG_Gewicht_totaal"], "Totaal aantal personen per jaar", "personen", "Numeric", 0))
    ind += [derived_indicator(derived[f"JG_Gewicht_{k}_perc"], f"Percentage personen met {v}", "percentage",
                              "Percentage", 1, 50, "JG_Gewicht_totaal") for k, v in labels.items()]
    ind.append(derived_indicator(derived["JG_Overgewicht"], "Aantal personen met overgewicht", "personen", "Numeric", 0))
    ind.append(derived_indicator(derived["JG_Overgewicht_perc"], "Percentage personen met overgewicht", "percentage",
                                 "Percentage", 1, 50, "JG_Overgewicht"))
    return CubeSpec(dims=WEIGHT_DIMS, variables=variables, indicators=ind, source=WEIGHT_SOURCE, dim_items=items)


def weight_job(spark: SparkSession, inputs: WeightInputs, out: str) -> dict[str, DataFrame]:
    c, members, areas = inputs.columns, inputs.members, inputs.areas
    dictionary = truncate(inputs.dictionary, c.klass, len(c.classes))
    cells = W.finest_cells(inputs.microdata, c)                          # the only microdata pass
    known = materialize(W.known_cells(cells, dictionary, c))             # what the cubes count
    levels = W.shared_levels(cells, c).persist()                         # one level row for all check grains
    g1, g2 = (W.grain_table(known, W.grains(c)[name], members=members, c=c) for name in ("g1", "g2"))
    g14 = W.grain_table(cells, W.grains(c)["g14"], members=members, c=c, levels=levels)
    g2 = g2.persist()                                                    # feeds three outputs
    codes = W.municipality_codes(areas, members, c.municipality)
    outputs = {
        "wijk": W.cube_district(g1, W.districts(areas), c),
        "gemeente": W.cube_municipality(g2, codes, c),
        "absoluut": W.cube_absolute(known, members, codes, inputs.subregions, c),
    }
    write_cube(weight_spec(inputs.dictionary, columns=c), outputs["wijk"], f"{out}/voortschrijdend_wijk")
    write_cube(weight_spec(inputs.dictionary, columns=c), outputs["gemeente"], f"{out}/voortschrijdend_gemeente")
    write_cube(weight_spec(inputs.dictionary, True, c), outputs["absoluut"], f"{out}/absoluut")
    table = W.readable_table(g2, members, class_labels(inputs.dictionary, c), c)
    table.write.mode("overwrite").partitionBy(c.municipality).parquet(f"{out}/tabel/per_gemeente")
    g2.drop("n_ma").write.mode("overwrite").parquet(f"{out}/tabel/alle_data")   # PRJ2
    # check tables: g5-g13 in one plan, g14 (overweight yes/no) on its own
    W.check_grains(cells, members, c, levels=levels).repartition("grain").write.mode("overwrite") \
        .partitionBy("grain").parquet(f"{out}/controle/klassen")
    g14.write.mode("overwrite").parquet(f"{out}/controle/overgewicht")
    g2.unpersist()
    levels.unpersist()
    return outputs


def significance_job(spark: SparkSession, inputs: SignificanceInputs, out: str) -> DataFrame:
    """RSH3, SNK2: the cubes ``kubus_<indicator>`` of all indicators in one bundle, each data column named as in its metadata."""
    design = inputs.design
    groups = inputs.municipalities.select(F.col("code").alias(design.group))
    long = materialize(SG.significance(inputs.survey, inputs.indicators, design, groups))
    cubes = []
    for v in sorted(set(SG.indicator_columns(inputs.survey, inputs.indicators, design).values())):
        name = f"{v}_pgroep"
        spec = CubeSpec(variables=[(name, SIGNIFICANCE_NAME, "Geen")],
                        indicators=[Indicator(name, SIGNIFICANCE_NAME, "Geen", None, "Numeric", 1)],
                        cube=0, source=SIGNIFICANCE_SOURCE)
        cubes.append(IndicatorCube(f"kubus_{v}", v, {"pgroep": name}, spec))
    write_indicator_cubes(cubes, long.select("Jaar", "geolevel", "geoitem", "var", "pgroep"), out)
    return long


def vaccination_job(spark: SparkSession, inputs: VaccinationInputs, out: str) -> DataFrame:
    cube = V.vaccination_cube(inputs.facts, inputs.member_keys, inputs.region_key, inputs.country_key, inputs.labels)
    items = spark.createDataFrame([(i + 1, t, i + 1) for i, t in enumerate(V.VACCINE_TYPES)],
                                  "Itemcode int, Naam string, Volgnr int")
    ind = [Indicator(c, n, "personen") for c, n, _ in VACC_VARS]
    ind.append(Indicator(VACC_RATE[0], VACC_RATE[1], "percentage", VACC_RATE[2], "Percentage", 1, 50,
                         "RVP_Gevaccineerden"))
    spec = CubeSpec(dims=VACC_DIMS, variables=VACC_VARS, indicators=ind, source=VACC_SOURCE,
                    dim_items={"RVP_Vaccinatie": items})
    write_cube(spec, in_order(materialize(cube), ["Jaar", "geolevel", "geoitem"]), f"{out}/vaccinatiegraad")
    return cube


def relabel_job(spark: SparkSession, inputs: RelabelInputs, out: str) -> DataFrame:
    df = relabel(inputs.data, inputs.prefix)
    write_relabelled(df, out, inputs.name)
    return df


def staged_inputs(spark: SparkSession, folder: str, job: str):
    """A job's inputs from staged tables below ``folder``.

    weight: ``microdata`` (labelled: data + dictionary), ``areas``, ``members``, ``subregions``;
    significance: ``survey`` (labelled), ``indicators.csv`` (Code, Richting), ``municipalities``;
    vaccination: ``facts``, ``member_keys``, ``labels``, ``parameters.json`` (region_key, country_key);
    relabel: ``monitor`` (labelled), ``parameters.json`` (prefix).
    """
    folder = folder.rstrip("/")

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}")

    def parameters() -> dict:
        return json.loads("".join(r[0] for r in spark.read.text(f"{folder}/parameters.json", wholetext=True).collect()))
    if job == "weight":
        microdata, dictionary = read_labelled(spark, f"{folder}/microdata")
        if dictionary is None:                               # labels in the data's own fields
            dictionary = value_labels(microdata)
            if dictionary.isEmpty():
                raise ValueError(f"{folder}/microdata has no value dictionary")
        return WeightInputs(microdata, dictionary, table("areas"), table("members"), table("subregions"))
    if job == "significance":
        survey, _ = read_labelled(spark, f"{folder}/survey", user_na=True)
        return SignificanceInputs(survey, read_indicator_list(spark, f"{folder}/indicators.csv"), table("municipalities"))
    if job == "vaccination":
        return VaccinationInputs(table("facts"), table("member_keys"), table("labels"), **parameters())
    if job == "relabel":
        data, _ = read_labelled(spark, f"{folder}/monitor")
        return RelabelInputs(data, "monitor", **parameters())
    raise ValueError(f"unknown job: {job}")


JOBS: dict[str, Callable] = {
    "weight": weight_job,
    "significance": significance_job,
    "vaccination": vaccination_job,
    "relabel": relabel_job,
}


def main(argv: list[str] | None = None) -> None:
    """``python -m areacube.plans.jobs <input dir> <output dir> [job ...] [--master M]``

    Each job reads the staged tables of ``<input dir>/<job>`` (see ``staged_inputs``).
    Without ``--master`` the submitted configuration is used as is (see
    ``build_session``); ``--master local[8]`` runs locally.
    """
    import argparse

    from areacube.session import build_session
    p = argparse.ArgumentParser(description="run the cube jobs")
    p.add_argument("input_dir")
    p.add_argument("output_dir")
    p.add_argument("jobs", nargs="*", help=f"any of {', '.join(JOBS)} (default: all)")
    p.add_argument("--master", default=None)
    a = p.parse_args(argv)
    spark = build_session(a.master)
    unknown = sorted(set(a.jobs) - set(JOBS))
    if unknown:
        p.error(f"unknown job(s): {', '.join(unknown)}")
    for name in a.jobs or list(JOBS):
        JOBS[name](spark, staged_inputs(spark, f"{a.input_dir.rstrip('/')}/{name}", name), f"{a.output_dir.rstrip('/')}/{name}")


if __name__ == "__main__":
    main()
