"""Job 1: weight-class cubes of children (counts, shares, 4-year means).

Plan shape, whatever the number of grains:

1. one pass over the microdata: prepare (end year, merged class) and count at
   the finest grain any table needs (a hash aggregate with map-side partials);
2. that cell table is checkpointed (``materialize``): every grain below rolls
   up from it, so the microdata is never scanned twice;
3. per grain: complete the grid (``densify``, whose aggregate also rolls the
   counts up to the grain), share, trailing means, smoothed count -- all on
   cell-sized data; two exchanges (area list, gap fill), the gap fill's
   partitioning reused by both windows; the checked level sets are computed
   once per cell table (``shared_levels``);
4. cubes: filter, attach area codes, recode, widen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areacube.operators.densify import densify, dimension_levels
from areacube.operators.dictionary import keep_known_codes, lookup
from areacube.operators.reshape import widen
from areacube.operators.smooth import share, smoothed_count, trailing_mean
from areacube.plans.portal import LEVEL_DISTRICT, LEVEL_MUNICIPALITY, LEVEL_REGION, LEVEL_SUBREGION
from areacube.session import materialize


@dataclass(frozen=True)
class WeightColumns:
    """Column names of the weight microdata (all parameters)."""
    school_year: str = "schooljaar"
    sex: str = "geslacht"
    age: str = "lftkompas"
    klass: str = "gewicht5"
    subregion: str = "regiokind"
    municipality: str = "gemeentekind"
    district: str = "wijkkind"
    overweight: str = "tezwaar"
    year: str = "eindjaar"
    merge_from: int = 5
    merge_into: int = 4
    classes: tuple = (1, 2, 3, 4)


COLS = WeightColumns()


@dataclass(frozen=True)
class Grain:
    """One output table: area columns, other dims, the class column and its form."""
    geo: tuple
    dims: tuple
    klass: str
    zero_fill: bool
    member_level: bool = False   # stubs come from the region's municipality list
    name: str = ""


def grains(c: WeightColumns = COLS) -> dict[str, Grain]:
    """The 14 grains: g1-g4 feed the cubes, g5-g14 are the check tables."""
    G, W, R, S, A, C, T = c.municipality, c.district, c.subregion, c.sex, c.age, c.klass, c.overweight
    return {
        "g1": Grain((G, W), (S, A), C, True, True, "district"),
        "g2": Grain((G,), (S, A), C, True, True, "municipality"),
        "g3": Grain((R,), (S, A), C, True, False, "subregion"),
        "g4": Grain((), (S, A), C, True, False, "region"),
        "g5": Grain((G,), (S,), C, False, True, "sex x municipality"),
        "g6": Grain((R,), (S,), C, False, False, "sex x subregion"),
        "g7": Grain((), (S,), C, False, False, "sex, region"),
        "g8": Grain((G,), (A,), C, False, True, "age x municipality"),
        "g9": Grain((R,), (A,), C, False, False, "age x subregion"),
        "g10": Grain((), (A,), C, False, False, "age, region"),
        "g11": Grain((G,), (), C, False, True, "total municipality"),
        "g12": Grain((R,), (), C, False, False, "total subregion"),
        "g13": Grain((), (), C, False, False, "total region"),
        "g14": Grain((G,), (S,), T, False, True, "overweight x sex x municipality"),
    }


def prepare(df: DataFrame, c: WeightColumns = COLS) -> DataFrame:
    """DAT1, PRJ9/FCT2, D17: end year of the school year, class 5 merged into 4.

    An unreadable school year stops the job (the reference's year loop would
    fail on NA bounds); the check runs inside the scan, not as a separate pass.
    """
    start = F.substring(F.col(c.school_year), 1, 4).try_cast("int")
    year = F.when(start.isNull(), F.raise_error(F.concat(
        F.lit("unreadable school year: "), F.coalesce(F.col(c.school_year), F.lit("NULL"))))) \
        .otherwise(start + 1)
    klass = F.when(F.col(c.klass) == c.merge_from, F.lit(c.merge_into)).otherwise(F.col(c.klass))
    return df.withColumns({c.year: year, c.klass: klass})


def finest_dims(c: WeightColumns = COLS) -> list[str]:
    return [c.subregion, c.municipality, c.district, c.sex, c.age, c.year, c.klass, c.overweight]


def finest_cells(microdata: DataFrame, c: WeightColumns = COLS, checkpoint: bool = True,
                 dictionary: DataFrame | None = None) -> DataFrame:
    """The single pass over the microdata: counts at the finest grain, with
    unknown codes as NULL (``known_cells``) when a dictionary is given."""
    cells = (prepare(microdata, c).groupBy(*finest_dims(c))
             .agg(F.count(F.lit(1)).alias("n")))
    if dictionary is not None:
        cells = known_cells(cells, dictionary, c)
    return materialize(cells) if checkpoint else cells


def stub_years(cells: DataFrame, g: Grain, members: DataFrame | None, c: WeightColumns = COLS):
    """Does the reference's stub loop add the years without data to this grain?

    It does whenever the list it loops over is non-empty: the member
    municipalities (municipality grains), the member municipalities that have
    districts (district grain), the observed subregions, or -- for the whole
    region -- always.  Returned as a boolean or a scalar-subquery column.
    """
    if not g.member_level:
        return True
    if members is None:
        return False
    m = members.select(c.municipality)
    if g.geo == (c.municipality,):
        return m.agg(F.count(F.lit(1)) > 0).scalar()
    # no subquery nested in this one: Spark may merge it with other scalar
    # subqueries over the same cell table
    seen = cells.select(c.municipality).join(m, c.municipality, "left_semi")
    return seen.agg(F.count(F.lit(1)) > 0).scalar()


def shared_levels(cells: DataFrame, c: WeightColumns = COLS) -> DataFrame:
    """The checked value sets of every dimension of the cell table (one row) for
    all grains.  Within one plan Spark reuses the identical subquery; a job
    with several actions should ``persist`` it."""
    return dimension_levels(cells, [c.sex, c.age, c.klass, c.overweight], c.year)


def grain_table(cells: DataFrame, g: Grain, members: DataFrame | None = None,
                c: WeightColumns = COLS, zero_fill: bool | None = None,
                levels: DataFrame | None = None) -> DataFrame:
    """Counts, shares and trailing means of one grain (DEN1-3, AGG3-4, WIN1-4).

    Base form (zero fill): n, n_total, perc, n_ma, perc_ma, n_total_ma, n_weighted.
    Check form (no fill):  n, perc, n_ma, perc_ma.
    """
    zf = g.zero_fill if zero_fill is None else zero_fill
    geo, dims = list(g.geo), list(g.dims)
    keys = geo + dims + [c.year, g.klass]
    t = cells.select(*keys, "n")   # rolled up inside densify's aggregate
    fill_years = stub_years(cells, g, members, c)
    extra = members if (g.member_level and g.geo == (c.municipality,)) else None
    # clustered by area: the share window, the trailing-mean window and the
    # cube's widen all group by supersets of it (a few hundred cells per area)
    t = densify(t, geo, dims + [g.klass], c.year, zero_fill=zf, extra_geos=extra,
                fill_years=fill_years, cluster=geo or dims, levels=levels)
    t = share(t, geo + dims + [c.year], total="n_total" if zf else None)
    if zf:
        t = trailing_mean(t, ["n", "perc", "n_total"], geo + dims + [g.klass], c.year)
        return smoothed_count(t)
    return trailing_mean(t, ["n", "perc"], geo + dims + [g.klass], c.year)


def check_grains(cells: DataFrame, members: DataFrame | None = None, c: WeightColumns = COLS,
                 levels: DataFrame | None = None, names=("g5", "g6", "g7", "g8", "g9", "g10", "g11", "g12", "g13")
                 ) -> DataFrame:
    """The check tables g5-g13 in one plan (AGG2 + DEN2-3 + AGG4 + WIN1-2, no zero fill).

    No check grain has both sex and age, so one grain-tagged union of the cell
    table carries a single ``area`` (municipality, subregion or none) and a
    single ``dim`` (sex, age or none) column.  The grid takes each grain's
    dimension values from the shared level row with a CASE on the grain, so
    all eight tables share one area list, one gap fill and both windows:
    two exchanges instead of two per grain.  Output: grain, the finest
    columns they use (NULL where not in the grain), n, perc, n_ma, perc_ma.
    """
    G, R, S, A, K, Y = c.municipality, c.subregion, c.sex, c.age, c.klass, c.year
    spec = {name: grains(c)[name] for name in names}
    for name, g in spec.items():
        if g.klass != K or len(g.geo) > 1 or len(g.dims) > 1 or g.zero_fill:
            raise ValueError(f"{name} is not a check grain of this form")
    area_of = {name: (g.geo[0] if g.geo else None) for name, g in spec.items()}
    dim_of = {name: (g.dims[0] if g.dims else None) for name, g in spec.items()}

    def tagged(name):
        a, d = area_of[name], dim_of[name]
        return cells.select(F.lit(name).alias("grain"),
                            (F.col(a).cast("string") if a else F.lit(None).cast("string")).alias("area"),
                            (F.col(d).cast("int") if d else F.lit(None).cast("int")).alias("dim"),
                            Y, K, "n")

    t = None
    for name in spec:
        t = tagged(name) if t is None else t.unionByName(tagged(name))

    def among(col: str, wanted: str):
        tags = [n for n in spec if (area_of if col == "area" else dim_of)[n] == wanted]
        return F.col("grain").isin(*tags) if tags else F.lit(False)

    lv = (levels if levels is not None else shared_levels(cells, c)).select("lv").scalar()
    geos = t.select("grain", "area", F.lit(True).alias("__gobs"))
    member_grains = [n for n in spec if area_of[n] == G]
    if members is not None and member_grains:
        m = members.select(F.col(G).cast("string").alias("area"))
        for n in member_grains:
            geos = geos.unionByName(m.select(F.lit(n).alias("grain"), "area", F.lit(False).alias("__gobs")))
    geos = geos.groupBy("grain", "area").agg(F.max("__gobs").alias("__gobs"))

    none = F.array(F.struct(F.lit(None).cast("int").alias("v")))
    dim_values = (F.when(among("dim", S), F.col("__lv").getField(S))
                  .when(among("dim", A), F.col("__lv").getField(A)).otherwise(none))
    full = F.sequence(F.col("__lv.__lo"), F.col("__lv.__hi"))
    has_members = (members.agg(F.count(F.lit(1)) > 0).scalar() if members is not None else F.lit(False))
    years = F.when(among("area", G) & ~has_members, F.col("__lv.__years")).otherwise(full)
    grid = (geos.withColumn("__lv", lv)
            .withColumn("__e", F.explode(dim_values)).withColumn("dim", F.col("__e").getField("v"))
            .withColumn("__k", F.explode(F.col("__lv").getField(K))).withColumn(K, F.col("__k").getField("v"))
            .withColumn(Y, F.explode(years))
            .select("grain", "area", "dim", Y, K, F.lit(None).cast("bigint").alias("n")))
    keys = ["grain", "area", "dim", Y, K]
    rolled = t.groupBy(*keys).agg(F.sum("n").cast("bigint").alias("n"))      # map-side partial sums
    filled = (rolled.unionByName(grid)
              .repartition("grain", "area")
              .groupBy(*keys).agg(F.sum("n").cast("bigint").alias("n")))
    out = share(filled, ["grain", "area", "dim", Y], total=None)
    out = trailing_mean(out, ["n", "perc"], ["grain", "area", "dim", K], Y)
    return out.select(
        "grain",
        F.when(among("area", R), F.col("area")).alias(R),
        F.when(among("area", G), F.col("area")).alias(G),
        F.when(among("dim", S), F.col("dim")).alias(S),
        F.when(among("dim", A), F.col("dim")).alias(A),
        Y, K, "n", "perc", "n_ma", "perc_ma")


# ---------------------------------------------------------------- dimensions

def districts(areas: DataFrame, key: str = "area_key", title: str = "title",
              municipality: str = "municipality", detail: str = "detailregioncode") -> DataFrame:
    """JN1, FLT5, STR1/STR3: district rows with their municipality's name.

    Result: Wijkcode (code without the ``WK`` prefix), Wijknaam, Municipality,
    Gemeentenaam.
    """
    gm = (areas.where(F.col(key).startswith("GM"))
          .select(F.col(title).alias("Gemeentenaam"), F.col(municipality).alias("Municipality")))
    wk = (areas.where(F.col(key).startswith("WK"))
          .select(F.col(detail).alias("Wijkcode"), F.col(title).alias("Wijknaam"),
                  F.col(municipality).alias("Municipality")))
    return (wk.join(gm, "Municipality", "left")
            .select(F.substr(F.col("Wijkcode"), F.lit(3)).alias("Wijkcode"), "Wijknaam",
                    "Municipality", "Gemeentenaam"))


def municipality_codes(areas: DataFrame, members: DataFrame, member_col: str = "gemeentekind",
                       key: str = "area_key", title: str = "title") -> DataFrame:
    """SRC4, STR4, MTH3, FLT3: (gemeentenaam, code) of the member municipalities.

    The code is the first digit run of the key as a number (``GM0003`` -> 3).
    """
    gm = areas.where(F.col(key).startswith("GM"))
    gm = gm.join(members.select(F.col(member_col).alias(title)), title, "left_semi")
    return gm.select(F.col(title).alias("gemeentenaam"),
                     F.regexp_substr(F.col(key), F.lit(r"\d+")).try_cast("int").alias("code"))


# ---------------------------------------------------------------- cubes

CUBE_IDS = ["Jaar", "geolevel", "geoitem", "JG_Geslacht", "JG_Lftklasse"]


def known_cells(cells: DataFrame, dictionary: DataFrame, c: WeightColumns = COLS) -> DataFrame:
    """JN5: codes that the dictionary does not have become NULL, before anything
    is summed: people with an unknown sex, age or class share one NULL cell and
    none of them is lost when the cube is widened."""
    cells = keep_known_codes(cells, dictionary, {c.sex: c.sex, c.age: c.age})
    return cells.withColumn(c.klass, F.when(F.col(c.klass).isin(*c.classes), F.col(c.klass)))


def _wide_cube(t: DataFrame, c: WeightColumns, value: str, name: str, grain_cols: Sequence[str]) -> DataFrame:
    """Widen one level of a cube (RSH1/RSH2).

    The grain's own key columns (area, or the fixed dims of the region level)
    ride along as hidden group keys: the gap fill already partitioned the rows
    by them, so the widen needs no shuffle, and two areas without a code are
    never merged into one cube row.
    """
    hidden = [f"__k{i}" for i in range(len(grain_cols))]
    t = t.select(*[F.col(k).alias(h) for k, h in zip(grain_cols, hidden)],
                 "Jaar", "geolevel", "geoitem", c.sex, c.age, c.klass, value)
    t = t.withColumnsRenamed({c.sex: "JG_Geslacht", c.age: "JG_Lftklasse"})
    return widen(t, hidden + CUBE_IDS, c.klass, value, list(c.classes), name, include_null=True).drop(*hidden)


def cube_municipality(g2: DataFrame, codes: DataFrame, c: WeightColumns = COLS) -> DataFrame:
    """Smoothed counts per municipality (JN3, FLT1-2, CND4, RSH1, PRJ4-5, PRJ10).

    Cells with an empty or missing total are left out; municipalities without
    a code keep a NULL ``geoitem`` (D13).
    """
    t = (g2.where(F.col("n_total").isNotNull() & (F.col("n_total") != 0))
         .withColumns({"Jaar": F.col(c.year), "geolevel": F.lit(LEVEL_MUNICIPALITY)}))
    t = lookup(t, codes, {c.municipality: "gemeentenaam"}, "code", "geoitem")
    return _wide_cube(t, c, "n_weighted", "JG_Gewicht_{}", [c.municipality])


def cube_district(g1: DataFrame, district_dim: DataFrame, c: WeightColumns = COLS) -> DataFrame:
    """Smoothed counts per district (JN2, D1, D13): unmatched districts are dropped."""
    t = (g1.where(F.col("n_total").isNotNull() & (F.col("n_total") != 0))
         .withColumns({"Jaar": F.col(c.year), "geolevel": F.lit(LEVEL_DISTRICT)}))
    t = lookup(t, district_dim, {c.municipality: "Gemeentenaam", c.district: "Wijknaam"}, "Wijkcode", "geoitem")
    return _wide_cube(t.where(F.col("geoitem").isNotNull()), c, "n_weighted", "JG_Gewicht_{}", [c.municipality, c.district])


def cube_absolute(cells: DataFrame, members: DataFrame | None, codes: DataFrame,
                  subregion_codes: DataFrame, c: WeightColumns = COLS, levels: DataFrame | None = None) -> DataFrame:
    """Counts at three levels in one cube (JN4, SET1, RSH2, D12: empty cells kept).

    The three levels (municipality, subregion, region: g2, g3, g4) share their
    dimensions, so they are built in one plan from a level-tagged union of the
    cell table: one area list, one gap fill, both windows and the widen on
    that partitioning (two exchanges for the whole cube).
    """
    G, R, S, A, K, Y = c.municipality, c.subregion, c.sex, c.age, c.klass, c.year
    area_of = {LEVEL_MUNICIPALITY: G, LEVEL_SUBREGION: R, LEVEL_REGION: None}
    t = None
    for level, area in area_of.items():
        part = cells.select(F.lit(level).alias("geolevel"),
                            (F.col(area).cast("string") if area else F.lit(None).cast("string")).alias("area"),
                            S, A, Y, K, "n")
        t = part if t is None else t.unionByName(part)
    extra = None
    has_members = F.lit(False)
    if members is not None:
        extra = members.select(F.lit(LEVEL_MUNICIPALITY).alias("geolevel"), F.col(G).cast("string").alias("area"))
        has_members = members.agg(F.count(F.lit(1)) > 0).scalar()
    # stub years: member list for municipalities, always for subregions and region
    fill = F.when(F.col("geolevel") == LEVEL_MUNICIPALITY, has_members).otherwise(F.lit(True))
    geo = ["geolevel", "area"]
    t = densify(t, geo, [S, A, K], Y, zero_fill=True, extra_geos=extra, fill_years=fill,
                cluster=geo, levels=levels)
    t = share(t, geo + [S, A, Y], total="n_total")
    names = (codes.select(F.lit(LEVEL_MUNICIPALITY).alias("level"), F.col("gemeentenaam").alias("name"), F.col("code").cast("int").alias("code"))
             .unionByName(subregion_codes.select(F.lit(LEVEL_SUBREGION).alias("level"), F.col("regionaam").alias("name"),
                                                 F.col("code").cast("int").alias("code"))))
    t = lookup(t.withColumn("Jaar", F.col(Y)), names, {"geolevel": "level", "area": "name"}, "code", "geoitem")
    t = t.withColumn("geoitem", F.when(F.col("geolevel") == LEVEL_REGION, F.lit(1)).otherwise(F.col("geoitem")))
    return _wide_cube(t, c, "n", "JG_Gewicht_{}_abs", geo)


def readable_table(g2: DataFrame, members: DataFrame, class_labels: Mapping[int, str],
                   c: WeightColumns = COLS) -> DataFrame:
    """RSH4/SNK3: smoothed shares per member municipality, one column per class label.

    One widen over all municipalities; the sink partitions it by municipality.
    """
    t = g2.join(members.select(c.municipality), c.municipality, "left_semi")
    labels = {k: v for k, v in class_labels.items() if k in c.classes}
    return widen(t, [c.municipality, c.sex, c.age, c.year], c.klass, "perc_ma",
                 list(labels), lambda v: labels.get(v, str(v)), include_null=True)
