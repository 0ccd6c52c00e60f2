"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator group.

Every query reads the driver's tables through the fixture builders, so its
work grows with them.  Doubles are rounded to 4 places at the very end so
the result can be compared with the SQL in ``oracle.py``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areacube.functions import scalars as S
from areacube.operators import cells as cellops
from areacube.operators import relabel as RL
from areacube.operators import survey as svy
from areacube.operators.densify import densify, dimension_levels, missing_geo_years, with_dictionary_levels
from areacube.operators.derive import add_derived, suppress, weight_class_indicators
from areacube.operators.dictionary import decode, observed_levels, override, recode, truncate, user_missing_to_null
from areacube.operators.formulas import evaluate_indicators
from areacube.operators.reshape import lengthen
from areacube.operators.smooth import share
from areacube.plans import jobs as J
from areacube.plans import significance as SG
from areacube.plans import vaccination as V
from areacube.plans import weight as W
from areacube.session import ensure_checkpoint_dir, materialize
from areacube.sinks.cube import indicators
from areacube.sinks.ordered import write_ordered
from areacube.sources import fixtures as fx
from areacube.sources.keyed import write_keyed
from areacube.sources.labelled import value_labels, with_value_labels
from areacube.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def round_half_up(c, places: int = 4):
    """``floor(x * 10^k + 0.5) / 10^k`` in plain IEEE arithmetic.

    Spark's ``round`` works on the shortest decimal form of a double, other
    engines on its binary value, so an exact tie like 6.05125 can round
    differently; this form gives the same bits in any engine.
    """
    k = 10 ** places
    return (F.floor(c * F.lit(k) + F.lit(0.5)) / F.lit(k)).cast("double")


def tidy(df: DataFrame, places: int = 4) -> DataFrame:
    """Round every double column (oracle hygiene)."""
    return df.select(*[round_half_up(F.col(f.name), places).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for a query's staged table, in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/staged-{uuid.uuid4().hex}/{name}"


# ---------------------------------------------------------------- weight job

C = W.COLS


def weight_cells(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    return W.finest_cells(fx.weight_microdata(spark, sf_dir, gaps))


def grain(spark: SparkSession, sf_dir: str, g: str, gaps: bool = False, **kw) -> DataFrame:
    members = kw.pop("members", fx.region_members(spark, sf_dir))
    return W.grain_table(weight_cells(spark, sf_dir, gaps), W.grains()[g], members=members, **kw)


def _keys(g: str) -> list[str]:
    gr = W.grains()[g]
    return list(gr.geo) + list(gr.dims) + [C.year, gr.klass]


@register("count_by_grain")
def count_by_grain(spark, sf_dir):
    """AGG1, PRJ9/FCT2, DAT1, STR2: municipality-grain counts straight from the microdata."""
    m = W.prepare(fx.weight_microdata(spark, sf_dir))
    return cellops.count_cells(m, _keys("g2"))


@register("count_multi_grain")
def count_multi_grain(spark, sf_dir):
    """AGG2: all 14 grains from one cell table, one aggregate with grouping sets."""
    grains = {name: list(g.geo) + list(g.dims) + [C.year, g.klass] for name, g in W.grains().items()}
    return cellops.count_grains(weight_cells(spark, sf_dir), grains, W.finest_dims())


@register("share_in_group")
def share_in_group(spark, sf_dir):
    """AGG3, AGG4, WIN5: observed cells with their group total and share."""
    keys = _keys("g2")
    t = cellops.roll_up(weight_cells(spark, sf_dir), keys)
    return tidy(share(t, keys[:-1]))


@register("missing_geo_years")
def missing_geo_years_q(spark, sf_dir):
    """JN9, AGG9, DAT4: (municipality, year) pairs without any row."""
    t = weight_cells(spark, sf_dir, gaps=True).select(C.municipality, C.year)
    return missing_geo_years(t, [C.municipality], C.year, fx.region_members(spark, sf_dir))


@register("densify_zero")
def densify_zero(spark, sf_dir):
    """DEN1, JN10: zero-filled product of the observed values."""
    t = weight_cells(spark, sf_dir).select(*_keys("g2"), "n")
    return densify(t, [C.municipality], [C.sex, C.age, C.klass], C.year, zero_fill=True)


@register("densify_levels")
def densify_levels(spark, sf_dir):
    """DEN1, FCT1, LBL1, LBL2: the product over the dictionary's levels, read from the data's own
    value labels with one variable overridden; levels that nobody has appear with 0."""
    labels = {v: [(code, label) for var, code, label, _ in fx.VALUE_DICTIONARY if var == v] for v in (C.sex, C.age, C.klass)}
    data = with_value_labels(fx.weight_microdata(spark, sf_dir), labels)
    dictionary = override(value_labels(data), C.sex, {"Man": 1, "Vrouw": 2, "Niet": 3, "Anders": 4})
    t = W.finest_cells(data).select(*_keys("g2"), "n")
    dims = [C.sex, C.age, C.klass]
    levels = with_dictionary_levels(dimension_levels(t, dims, C.year), dictionary, {d: d for d in dims})
    return densify(t, [C.municipality], dims, C.year, zero_fill=True, levels=levels)


@register("densify_years")
def densify_years(spark, sf_dir):
    """DEN2, DEN3, SET2: the grid after stub years and member municipalities."""
    t = weight_cells(spark, sf_dir, gaps=True).select(*_keys("g2"), "n")
    return densify(t, [C.municipality], [C.sex, C.age, C.klass], C.year, zero_fill=True,
                   extra_geos=fx.region_members(spark, sf_dir), fill_years=True)


@register("moving_average")
def moving_average(spark, sf_dir):
    """WIN1-WIN4 on the municipality grain (the base table behind two cubes)."""
    return tidy(grain(spark, sf_dir, "g2", gaps=True))


@register("moving_average_district")
def moving_average_district(spark, sf_dir):
    """g1: district grain on the observed (municipality, district) pair spine (D1)."""
    return tidy(grain(spark, sf_dir, "g1", gaps=True))


@register("moving_average_subregion")
def moving_average_subregion(spark, sf_dir):
    """g3: subregion grain; stub years come from the observed subregions."""
    return tidy(grain(spark, sf_dir, "g3", gaps=True))


@register("moving_average_region")
def moving_average_region(spark, sf_dir):
    """g4: whole region, no area column."""
    return tidy(grain(spark, sf_dir, "g4", gaps=True))


@register("moving_average_no_fill")
def moving_average_no_fill(spark, sf_dir):
    """WIN2, D10: check-table form (g5): absent cells stay NULL, never 0."""
    return tidy(grain(spark, sf_dir, "g5", gaps=True))


@register("check_tables")
def check_tables(spark, sf_dir):
    """g6-g13: the remaining check tables in one plan, stacked with a grain column."""
    cells = weight_cells(spark, sf_dir)
    names = ("g6", "g7", "g8", "g9", "g10", "g11", "g12", "g13")
    return tidy(W.check_grains(cells, fx.region_members(spark, sf_dir), names=names))


@register("smoothed_count")
def smoothed_count_q(spark, sf_dir):
    """WIN4: smoothed count on the subregion grain."""
    t = grain(spark, sf_dir, "g3", gaps=True)
    return tidy(t.select(*_keys("g3"), "n_total", "perc_ma", "n_weighted"))


@register("overweight_by_sex")
def overweight_by_sex(spark, sf_dir):
    """g14: overweight yes/no per sex and municipality, check-table form."""
    return tidy(grain(spark, sf_dir, "g14"))


@register("district_hierarchy")
def district_hierarchy(spark, sf_dir):
    """JN1, FLT5, STR1, STR3, PRJ1, PRJ3: district dimension with municipality names."""
    return W.districts(fx.area_codes(spark, sf_dir))


def _dictionary(spark):
    return truncate(fx.value_dictionary(spark), C.klass, 4)


def known_weight_cells(spark, sf_dir):
    return W.finest_cells(fx.weight_microdata(spark, sf_dir), dictionary=_dictionary(spark))


@register("cube_district")
def cube_district_q(spark, sf_dir):
    """JN2, FLT1-2, JN5, RSH1, PRJ4-5, D1, D13: smoothed counts per district, wide."""
    g1 = W.grain_table(known_weight_cells(spark, sf_dir), W.grains()["g1"], members=fx.region_members(spark, sf_dir))
    return tidy(W.cube_district(g1, W.districts(fx.area_codes(spark, sf_dir))))


def cube_municipality_raw(spark, sf_dir):
    members = fx.region_members(spark, sf_dir)
    g2 = W.grain_table(known_weight_cells(spark, sf_dir), W.grains()["g2"], members=members)
    return W.cube_municipality(g2, W.municipality_codes(fx.area_codes(spark, sf_dir), members))


@register("cube_municipality")
def cube_municipality_q(spark, sf_dir):
    """JN3, RSH1: smoothed counts per municipality, wide."""
    return tidy(cube_municipality_raw(spark, sf_dir))


def subregion_codes(spark, sf_dir):
    """Subregion name -> code (the region table's key stands in for the code list)."""
    return read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"]).select(
        F.col("r_name").alias("regionaam"), (F.col("r_regionkey") + 1).alias("code"))


@register("cube_absolute_levels")
def cube_absolute_levels(spark, sf_dir):
    """JN4, SET1, RSH2, D12: counts at municipality, subregion and region level (one plan)."""
    members = fx.region_members(spark, sf_dir)
    codes = W.municipality_codes(fx.area_codes(spark, sf_dir), members)
    return tidy(W.cube_absolute(known_weight_cells(spark, sf_dir), members, codes, subregion_codes(spark, sf_dir)))


@register("table_by_municipality")
def table_by_municipality(spark, sf_dir):
    """RSH4, FLT4: smoothed shares per member municipality, class labels as columns."""
    members = fx.region_members(spark, sf_dir)
    g2 = grain(spark, sf_dir, "g2", members=members)
    labels = {code: label for var, code, label, _ in fx.VALUE_DICTIONARY if var == C.klass}
    return tidy(W.readable_table(g2, members, labels))


@register("freq_table")
def freq_table(spark, sf_dir):
    """AGG6: class x school year with the share of each class within the year."""
    m = W.prepare(fx.weight_microdata(spark, sf_dir))
    t = cellops.count_cells(m, [C.klass, C.school_year])
    return tidy(share(t, [C.school_year], total="n_total"))


@register("class_year_counts")
def class_year_counts(spark, sf_dir):
    """AGG7: the counts behind the grouped bar chart (year x class)."""
    m = W.prepare(fx.weight_microdata(spark, sf_dir))
    return cellops.count_cells(m, [C.school_year, C.klass])


@register("year_bounds")
def year_bounds_q(spark, sf_dir):
    """AGG5, AGG8: the distinct subregions with the first and last end year."""
    m = W.prepare(fx.weight_microdata(spark, sf_dir))
    return cellops.year_bounds(m, C.subregion, C.year)


def queries() -> dict[str, Query]:
    return dict(REGISTRY)


# ---------------------------------------------------------------- survey job


DESIGN = SG.SurveyDesign(user_na=fx.SURVEY_USER_NA)
ALL_INDICATORS = ["vo_ind_a", "vo_ind_b", "vo_ind_c", "vo_ind_d"]


def survey_data(spark, sf_dir):
    return SG.prepared(fx.survey_microdata(spark, sf_dir), DESIGN)


def survey_groups(spark, sf_dir):
    """LBL6: the labelled municipalities.  Presence in the data needs no extra
    pass: only municipalities with rows get a result row at all."""
    return fx.survey_municipalities(spark, sf_dir).select(F.col("code").alias(DESIGN.group))


def resolved_indicators(spark, sf_dir) -> list[str]:
    dirs = SG.directions(fx.indicator_list(spark))
    return sorted(set(svy_resolve(survey_data(spark, sf_dir).columns, list(dirs)).values()))


def svy_resolve(columns, codes):
    return RL.resolve_code_names(columns, codes)


@register("unpivot_indicators")
def unpivot_indicators(spark, sf_dir):
    """RSH5: wide indicators -> long (respondent, var, val)."""
    s = user_missing_to_null(fx.survey_microdata(spark, sf_dir), fx.SURVEY_USER_NA)
    return lengthen(s.select("row_a", "row_b", *ALL_INDICATORS), ["row_a", "row_b"], ALL_INDICATORS)


@register("svy_weighted_share")
def svy_weighted_share(spark, sf_dir):
    """SVY1-3, SVY8, JN11, SET3, FLT7: weighted share of the second answer in
    each municipality and in the rest of the region, per wave and indicator."""
    t = SG.tests(survey_data(spark, sf_dir), ALL_INDICATORS, DESIGN, survey_groups(spark, sf_dir))
    return tidy(t.select("vo_wave", "var", DESIGN.group, "n_levels", "is_dichotomous",
                         "perc_gemeente", "perc_rest"))


@register("svy_rao_scott")
def svy_rao_scott(spark, sf_dir):
    """SVY4: design-corrected chi-square (N, X2, delta, F, nu) per wave, indicator, municipality."""
    t = SG.tests(survey_data(spark, sf_dir), resolved_indicators(spark, sf_dir), DESIGN,
                 survey_groups(spark, sf_dir))
    return tidy(t.select("vo_wave", "var", DESIGN.group, "n_design", "x2", "delta", "f_stat", "nu"))


@register("svy_significance")
def svy_significance(spark, sf_dir):
    """SVY4-7, UDF4, CND1-2, CND5, MTH3: significance group 1-5 per wave."""
    t = SG.significance(fx.survey_microdata(spark, sf_dir), fx.indicator_list(spark), DESIGN,
                        survey_groups(spark, sf_dir))
    return t.select("Jaar", "geolevel", "geoitem", "var", "gunstig", "pgroep")


@register("svy_p_value")
def svy_p_value(spark, sf_dir):
    """UDF4: the exact F(1, nu) upper tail (the pandas UDF) and the group it gives."""
    t = SG.significance(fx.survey_microdata(spark, sf_dir), fx.indicator_list(spark), DESIGN,
                        survey_groups(spark, sf_dir))
    return tidy(t.select("Jaar", "geoitem", "var", "p", "pgroep"))


@register("parse_direction")
def parse_direction_q(spark, sf_dir):
    """STR5, SVY5, FLT6: direction code and flag (NULL where the job would stop)."""
    return svy.parse_direction(fx.direction_texts(spark, sf_dir))


@register("codes_present")
def codes_present(spark, sf_dir):
    """JN8, LBL6, FLT3: the municipality code list limited to codes in the data."""
    labels = fx.survey_municipalities(spark, sf_dir).withColumn("variable", F.lit("vo_gemeente")) \
        .select("variable", "code", F.col("naam").alias("label"), F.col("code").alias("ord"))
    return observed_levels(labels, fx.survey_microdata(spark, sf_dir), "vo_gemeente", "vo_gemeente") \
        .select("code", F.col("label").alias("naam"))


@register("user_missing_to_null")
def user_missing_q(spark, sf_dir):
    """LBL4, DM5: user-missing codes become NULL."""
    s = fx.survey_microdata(spark, sf_dir).select("row_a", "row_b", "vo_ind_b")
    return user_missing_to_null(s, fx.SURVEY_USER_NA)


# ---------------------------------------------------------------- dictionaries

def _meas_dictionary(spark):
    return truncate(fx.value_dictionary(spark), C.klass, 4)


@register("decode_labels")
def decode_labels(spark, sf_dir):
    """JN6, JN7, LBL3, FCT2: label columns for the coded dimensions (class 5 merged into 4 first)."""
    m = W.prepare(fx.weight_microdata(spark, sf_dir)).select(C.municipality, C.sex, C.age, C.klass)
    return decode(m, _meas_dictionary(spark), {C.sex: "geslacht", C.age: "lftkompas", C.klass: "gewicht5"})


@register("recode_codes")
def recode_codes(spark, sf_dir):
    """JN5, UDF1: label -> code with a literal mapping; unmatched and NULL -> NULL."""
    m = decode(W.prepare(fx.weight_microdata(spark, sf_dir)).select(C.sex, C.klass), _meas_dictionary(spark),
               {C.klass: "gewicht5"})
    mapping = {label: code for var, code, label, ord_ in fx.VALUE_DICTIONARY if var == C.klass and ord_ <= 4}
    return recode(m, C.klass + "_label", mapping, out=C.klass + "_code")


@register("dimension_items")
def dimension_items_q(spark, sf_dir):
    """MET2, SRC7: Itemcode, Naam, Volgnr of the sex and age dimensions and of
    the municipality level (numbered in code order)."""
    d = fx.value_dictionary(spark).where(F.col("variable").isin(C.sex, C.age))
    dims = d.select(F.col("variable").alias("dimensie"), F.col("code").alias("Itemcode"),
                    F.col("label").alias("Naam"), F.col("ord").alias("Volgnr"))
    codes = W.municipality_codes(fx.area_codes(spark, sf_dir), fx.region_members(spark, sf_dir))
    number = F.row_number().over(Window.orderBy("code"))     # one region's code list
    muni = codes.select(F.lit("gemeente").alias("dimensie"), F.col("code").alias("Itemcode"),
                        F.col("gemeentenaam").alias("Naam"),
                        number.alias("Volgnr"))
    return dims.unionByName(muni)


# ---------------------------------------------------------------- vaccination job


@register("vaccination_cube")
def vaccination_cube_q(spark, sf_dir):
    """SRC3, JN7, CND3, DAT2, STR4, STR10, MTH3, FLT1, FLT3, SET1, JN5, D14."""
    facts = fx.vaccination_facts(spark, sf_dir)
    return tidy(V.vaccination_cube(facts, fx.member_area_keys(spark, sf_dir), "GG0001", "NL01  ",
                                   fx.vaccine_labels(spark, sf_dir, V.VACCINE_TYPES)))


@register("vaccination_cube_keyed")
def vaccination_cube_keyed_q(spark, sf_dir):
    """SRC3: the cube from facts staged by key range; the key table names the ranges to read while the query runs."""
    path = scratch(spark, "facts")
    write_keyed(fx.vaccination_facts(spark, sf_dir), path)
    return tidy(V.vaccination_cube(spark.read.parquet(path), fx.member_area_keys(spark, sf_dir), "GG0001", "NL01  ",
                                   fx.vaccine_labels(spark, sf_dir, V.VACCINE_TYPES)))


@register("vaccination_cube_ordered")
def vaccination_cube_ordered_q(spark, sf_dir):
    """SRT1: the cube written in the order of year and area, and read back."""
    facts = fx.vaccination_facts(spark, sf_dir)
    cube = V.vaccination_cube(facts, fx.member_area_keys(spark, sf_dir), "GG0001", "NL01  ",
                              fx.vaccine_labels(spark, sf_dir, V.VACCINE_TYPES))
    path = scratch(spark, "ordered")
    write_ordered(materialize(cube), path, ["Jaar", "geolevel", "geoitem"])
    return tidy(spark.read.parquet(path))


@register("period_to_date")
def period_to_date(spark, sf_dir):
    """DAT3: period code -> first day and frequency letter."""
    f = fx.vaccination_facts(spark, sf_dir).select("regios", "perioden", "vaccinaties")
    return f.select("regios", "perioden", "vaccinaties", S.period_year(F.col("perioden")).alias("jaar"),
                    S.period_date(F.col("perioden")).alias("perioden_date"),
                    S.period_frequency(F.col("perioden")).alias("perioden_freq"))


# ---------------------------------------------------------------- relabel job


@register("pad_and_compose_code")
def pad_and_compose_code(spark, sf_dir):
    """STR11-13, LBL7-8, PRJ9: zero-padded district code and the composed 6-character code."""
    m = fx.monitor_file(spark, sf_dir)
    m = RL.pad_district(m, "nog_wijk2020")
    m = RL.compose_district(m, "gemeentecode", "wijkcode", "wijkcode_volledig")
    return m.select("id", "nog_wijk2020", "wijkcode_volledig")


@register("clean_labels")
def clean_labels_q(spark, sf_dir):
    """STR8, LBL5: first occurrence of the cleaned word removed from each label."""
    return RL.clean_labels(fx.variable_labels(spark, sf_dir))


@register("prefix_columns")
def prefix_columns_q(spark, sf_dir):
    """PRJ6: every column renamed with the monitor prefix."""
    return RL.prefix_columns(fx.monitor_file(spark, sf_dir), "VO")


@register("resolve_columns")
def resolve_columns_q(spark, sf_dir):
    """PRJ7-8, STR6: (code, variable) pairs by case-insensitive containment, with match counts."""
    return RL.resolve_codes(fx.indicator_codes(spark, sf_dir), fx.variable_labels(spark, sf_dir))


# ---------------------------------------------------------------- derived indicators


@register("derived_indicators")
def derived_indicators(spark, sf_dir):
    """MET6: totals and shares of the municipality cube, evaluated."""
    cube = cube_municipality_raw(spark, sf_dir)
    return tidy(add_derived(cube, weight_class_indicators()))


@register("formulas_municipality")
def formulas_municipality(spark, sf_dir):
    """MET5, MET6: the formula texts of the municipality cube's indicator table, evaluated."""
    table = indicators(J.weight_spec(fx.value_dictionary(spark)), spark)
    return tidy(evaluate_indicators(cube_municipality_raw(spark, sf_dir), table.where(F.col("Formula").isNotNull())))


@register("formulas_absolute")
def formulas_absolute(spark, sf_dir):
    """MET5, MET6: the class shares of the absolute cube, from its formula texts."""
    members = fx.region_members(spark, sf_dir)
    codes = W.municipality_codes(fx.area_codes(spark, sf_dir), members)
    cube = W.cube_absolute(known_weight_cells(spark, sf_dir), members, codes, subregion_codes(spark, sf_dir))
    return tidy(evaluate_indicators(cube, indicators(J.weight_spec(fx.value_dictionary(spark), True), spark)))


@register("formulas_vaccination")
def formulas_vaccination(spark, sf_dir):
    """MET6: the vaccination rate from its formula text, and indicators that refer to it."""
    facts = fx.vaccination_facts(spark, sf_dir)
    cube = V.vaccination_cube(facts, fx.member_area_keys(spark, sf_dir), "GG0001", "NL01  ",
                              fx.vaccine_labels(spark, sf_dir, V.VACCINE_TYPES))
    code, _, formula = J.VACC_RATE
    return tidy(evaluate_indicators(cube, {"RVP_Tekort": f"90-{code}", code: formula, "RVP_Niet": "RVP_Populatie-RVP_Gevaccineerden",
                                           "RVP_Niet_perc": f"-({code}-1e2)/1", "RVP_Niet_som": "RVP_Niet+RVP_Niet_perc*0"}))


@register("threshold_suppress")
def threshold_suppress(spark, sf_dir):
    """MET7: shares hidden where their threshold indicator is below 50."""
    cube = add_derived(cube_municipality_raw(spark, sf_dir), weight_class_indicators())
    rules = {f"JG_Gewicht_{k}_perc": "JG_Gewicht_totaal" for k in C.classes}
    rules["JG_Overgewicht_perc"] = "JG_Overgewicht"
    keep = ["Jaar", "geolevel", "geoitem", "JG_Geslacht", "JG_Lftklasse", *rules]
    return tidy(suppress(cube, rules).select(*keep))
