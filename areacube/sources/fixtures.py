"""Representative inputs built from the driver's tables (see FIXTURES.md).

Each builder is the DataFrame form of one fixture view.  They stand in for
the real inputs of the four jobs (weight microdata, area code list, survey
microdata, open vaccination statistics, monitor file), so every query's work
grows with the underlying tables.  Only the value dictionary and the
indicator list are fixed parameters, as they are in a real run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areacube.sources.tables import local_table, read_table


def _year(c: str) -> Column:
    return F.year(F.col(c)).cast("int")


def _gm_code(nationkey: Column) -> Column:
    return F.concat(F.lit("GM"), F.lpad(nationkey.cast("string"), 4, "0"))


def weight_microdata(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    """fx_meas: one row per measured child, one for each order.

    About 1 % of the rows have no weight class, and class 5 occurs (merged into
    4 later).  With ``gaps`` (for the queries about missing years only) year
    1997 is missing everywhere and NATION_3 has no rows in 1998.
    """
    o = read_table(spark, sf_dir, "orders",
                   ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"])
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    t = (o.join(c, o.o_custkey == c.c_custkey)
         .join(n, c.c_nationkey == n.n_nationkey)
         .join(r, n.n_regionkey == r.r_regionkey)
         .withColumn("y", _year("o_orderdate")))
    if gaps:
        t = t.where((F.col("y") != 1997) & ~((F.col("n_name") == "NATION_3") & (F.col("y") == 1998)))
    missing = (F.col("o_orderkey") % 97) == 0
    prio = F.substring("o_orderpriority", 1, 1)
    return t.select(
        F.concat((F.col("y") - 1).cast("string"), F.lit("-"), F.col("y").cast("string")).alias("schooljaar"),
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2)
         .otherwise(3).alias("geslacht"),
        F.when(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING"), 1)
         .when(F.col("c_mktsegment").isin("FURNITURE", "HOUSEHOLD"), 2).otherwise(3).alias("lftkompas"),
        F.when(missing, F.lit(None)).otherwise(prio.cast("int")).alias("gewicht5"),
        F.col("r_name").alias("regiokind"),
        F.col("n_name").alias("gemeentekind"),
        F.concat(F.col("n_name"), F.lit("-W"), (F.col("c_custkey") % 4).cast("string")).alias("wijkkind"),
        F.when(missing, F.lit(None)).when(prio.isin("1", "2"), "Ja").otherwise("Nee").alias("tezwaar"),
    )


def region_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The region's municipality list: every nation name plus one without data."""
    names = read_table(spark, sf_dir, "nation", ["n_name"]).select(F.col("n_name").alias("gemeentekind"))
    return names.unionByName(local_table(spark, [("NATION_NONE",)], "gemeentekind string"))


# The value dictionary of the fixtures (variable, code, label, ord).
# Labels of classes 3-5 and of the age groups are placeholders.
VALUE_DICTIONARY = [
    ("geslacht", 1, "Man", 1), ("geslacht", 2, "Vrouw", 2), ("geslacht", 3, "Niet", 3),
    ("lftkompas", 1, "groep 1", 1), ("lftkompas", 2, "groep 2", 2), ("lftkompas", 3, "groep 3", 3),
    ("gewicht5", 1, "obesitas", 1), ("gewicht5", 2, "overgewicht", 2), ("gewicht5", 3, "klasse 3", 3),
    ("gewicht5", 4, "klasse 4", 4), ("gewicht5", 5, "klasse 5", 5),
]

DICT_SCHEMA = T.StructType([
    T.StructField("variable", T.StringType()), T.StructField("code", T.IntegerType()),
    T.StructField("label", T.StringType()), T.StructField("ord", T.IntegerType()),
])


def value_dictionary(spark: SparkSession) -> DataFrame:
    """fx_dict: long form of the value labels (DM2)."""
    return local_table(spark, VALUE_DICTIONARY, DICT_SCHEMA)


def area_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_areas: municipality (GM) and district (WK) rows of one code list.

    District ``-W3`` of each municipality is absent on purpose.
    """
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    gm = _gm_code(F.col("n_nationkey"))
    municipalities = n.select(gm.alias("area_key"), F.col("n_name").alias("title"),
                              gm.alias("municipality"), gm.alias("detailregioncode"))
    wk = F.concat(F.lit("WK"), F.lpad(F.col("n_nationkey").cast("string"), 4, "0"), F.lit("0"), F.col("w"))
    districts = (n.withColumn("w", F.explode(F.array(F.lit("0"), F.lit("1"), F.lit("2"))))
                 .select(wk.alias("area_key"),
                         F.concat(F.col("n_name"), F.lit("-W"), F.col("w")).alias("title"),
                         gm.alias("municipality"), wk.alias("detailregioncode")))
    return municipalities.unionByName(districts)


def survey_microdata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_survey: one row per respondent, strata 1-7, weights, four indicators.

    ``vo_ind_b`` uses 9 as user-missing; ``vo_ind_c`` has a planted effect by
    municipality; ``vo_ind_d`` has three answer values.
    """
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                     "l_returnflag", "l_linestatus", "l_shipdate"])
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    t = li.join(s, li.l_suppkey == s.s_suppkey)
    planted = (F.col("l_orderkey") * 7 + F.col("l_partkey") * 3) % 50 < (F.lit(15) + F.col("s_nationkey") % 3)
    return t.select(
        F.col("l_orderkey").alias("row_a"), F.col("l_linenumber").alias("row_b"),
        _year("l_shipdate").alias("vo_wave"),
        F.col("s_nationkey").alias("vo_gemeente"), F.col("l_quantity").alias("vo_weight"),
        F.col("l_linenumber").alias("vo_stratum"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("vo_ind_a"),
        F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "N", 0)
         .otherwise(9).alias("vo_ind_b"),
        F.when(planted, 1).otherwise(0).alias("vo_ind_c"),
        (F.col("l_partkey") % 3).cast("int").alias("vo_ind_d"),
    )


# The indicator list of the fixtures (code, direction text).
INDICATORS = [
    ("IND_A", "Hoger = gunstig"), ("ind_b", "Hoger = ongunstig"),
    ("IND_C", "Hoger = ongunstig"), ("IND_X", "Hoger = gunstig"),
]

# User-missing codes per survey column (DM5).
SURVEY_USER_NA = {"vo_ind_b": [9]}


def indicator_list(spark: SparkSession) -> DataFrame:
    """fx_indicators: codes in mixed case; ``IND_X`` matches no column."""
    return local_table(spark, INDICATORS, "code string, richting string")


def vaccination_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_vacc: municipality, region (GG0001) and country ('NL01  ') rows.

    Counts sit in the "met" columns before 1998 and in the "zonder" columns
    from 1998; in 2001 municipalities with an even code have no counts.
    """
    o = read_table(spark, sf_dir, "orders", ["o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"])
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    r = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    o = o.withColumn("y", _year("o_orderdate"))
    oc = o.join(c, o.o_custkey == c.c_custkey)
    measures = [F.count(F.lit(1)).alias("pop"),
                F.sum(F.when(F.col("o_orderstatus") != "P", 1).otherwise(0)).cast("bigint").alias("vac")]
    muni = (oc.groupBy("c_nationkey", "y", "o_orderpriority").agg(*measures)
            .select(_gm_code(F.col("c_nationkey")).alias("regios"), "y",
                    F.col("o_orderpriority").alias("vaccinaties"), "pop", "vac",
                    F.when(F.col("c_nationkey") % 2 == 0, 1).otherwise(0).alias("blank")))
    region = (oc.join(n, oc.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
              .where(F.col("r_name") == "EUROPE")
              .groupBy("y", "o_orderpriority").agg(*measures)
              .select(F.lit("GG0001").alias("regios"), "y", F.col("o_orderpriority").alias("vaccinaties"),
                      "pop", "vac", F.lit(0).alias("blank")))
    country = (o.groupBy("y", "o_orderpriority").agg(*measures)
               .select(F.lit("NL01  ").alias("regios"), "y", F.col("o_orderpriority").alias("vaccinaties"),
                       "pop", "vac", F.lit(0).alias("blank")))
    t = muni.unionByName(region).unionByName(country)
    early = F.col("y") < 1998
    late = (F.col("y") >= 1998) & ~((F.col("y") == 2001) & (F.col("blank") == 1))
    rate = F.lit(100.0) * F.col("vac") / F.col("pop")
    return t.select(
        "regios", F.concat(F.col("y").cast("string"), F.lit("JJ00")).alias("perioden"), "vaccinaties",
        F.col("pop").cast("double").alias("populatie_1"),
        F.when(early, F.col("vac").cast("double")).alias("gevaccineerdenmet_2"),
        F.when(early, rate).alias("vaccinatiegraadmet_3"),
        F.when(late, F.col("vac").cast("double")).alias("gevaccineerdenzonder_4"),
        F.when(late, rate).alias("vaccinatiegraadzonder_5"),
    )


def monitor_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_monitor: codes to pad and compose; NULL districts and municipalities occur."""
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    k = F.col("c_custkey")
    return c.select(
        k.alias("id"),
        (F.col("c_nationkey") * 100 + k % 4).cast("int").alias("nog_wijk2020"),
        F.when(k % 50 == 0, F.lit(None)).otherwise(F.col("c_nationkey")).alias("gemeentecode"),
        F.when(k % 3 == 0, F.lit(None)).when(k % 7 == 0, F.lit("5"))
         .otherwise(F.concat(F.lit("0"), (k % 4).cast("string"))).alias("wijkcode"),
    )


def variable_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variable dictionary (variable, label) of a wide survey file.

    One variable per part; labels carry the word to clean in several forms
    (brackets, capitals, twice, absent, no label at all).
    """
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_type", "p_brand"])
    k = F.col("p_partkey") % 5
    label = (F.when(k == 0, F.concat(F.col("p_name"), F.lit(" (opgeschoond)")))
             .when(k == 1, F.concat(F.col("p_type"), F.lit(" Opgeschoond")))
             .when(k == 2, F.concat(F.col("p_name"), F.lit(" opgeschoond "), F.col("p_brand"),
                                    F.lit(" opgeschoond")))
             .when(k == 3, F.col("p_name")))
    return p.select(
        F.concat(F.lit("VO_"), F.upper(F.regexp_replace(F.col("p_type"), " ", "")),
                 F.col("p_partkey").cast("string")).alias("variable"),
        label.alias("label"))


def vaccine_labels(spark: SparkSession, sf_dir: str, types: list[str]) -> DataFrame:
    """Code list of the ``vaccinaties`` dimension (key, title).

    Priority ``k`` maps to vaccine type ``3k - 2`` of ``types``; priority 5 gets
    a type outside the list, so the type filter has something to drop.
    """
    o = read_table(spark, sf_dir, "orders", ["o_orderpriority"]).select(
        F.col("o_orderpriority").alias("key")).distinct()
    d = F.substring("key", 1, 1).cast("int")
    names = F.array(*[F.lit(t) for t in types])
    return o.select("key", F.when(d == 5, F.lit("Onbekend vaccin"))
                    .otherwise(F.element_at(names, d * 3 - 2)).alias("title"))


def member_area_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the member municipalities in the area code list."""
    a = area_codes(spark, sf_dir).where(F.col("area_key").startswith("GM"))
    m = region_members(spark, sf_dir).select(F.col("gemeentekind").alias("title"))
    return a.join(m, "title", "left_semi").select(F.col("area_key").alias("key"))


def survey_municipalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value labels of the survey's municipality column (code, naam)."""
    return read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"]).select(
        F.col("n_nationkey").alias("code"), F.col("n_name").alias("naam"))


def direction_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A long indicator list with every kind of direction text."""
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand"])
    k = F.col("p_partkey") % 4
    text = (F.when(k == 0, F.lit("Hoger = gunstig")).when(k == 1, F.lit("Hoger = ongunstig"))
            .when(k == 2, F.lit("Hoger = neutraal")).otherwise(F.concat(F.lit("Richting "), F.col("p_brand"))))
    return p.select(F.concat(F.lit("IND_"), F.col("p_partkey").cast("string")).alias("code"), text.alias("richting"))


def indicator_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes to resolve against the variable names of ``variable_labels``:
    some match one name, some several (prefixes of longer names), some none."""
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_type"])
    return p.select(F.concat(F.lower(F.regexp_replace(F.col("p_type"), " ", "")),
                             (F.col("p_partkey") * 3).cast("string")).alias("code"))
