"""Independent SQL for each registered query (the driver's DuckDB check).

Written directly in SQL over the pre-registered base tables; the fixture
inputs are inlined as CTEs (the same views as FIXTURES.md).  Conventions on
both sides: counts BIGINT, years INT, doubles rounded to 4 places, every
column aliased, no dependence on row order.
"""

from __future__ import annotations

FIXTURE_SQL = {
    "fx_meas": """
SELECT concat(CAST(y - 1 AS VARCHAR), '-', CAST(y AS VARCHAR)) AS schooljaar,
       CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS geslacht,
       CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 1
            WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 2 ELSE 3 END AS lftkompas,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL
            ELSE CAST(substring(o_orderpriority, 1, 1) AS INT) END AS gewicht5,
       r_name AS regiokind, n_name AS gemeentekind,
       concat(n_name, '-W', CAST(c_custkey % 4 AS VARCHAR)) AS wijkkind,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL
            WHEN substring(o_orderpriority, 1, 1) IN ('1', '2') THEN 'Ja' ELSE 'Nee' END AS tezwaar
FROM (SELECT o_orderkey, o_orderstatus, o_orderpriority, c_custkey, c_mktsegment, n_name, r_name,
             CAST(year(o_orderdate) AS INT) AS y
      FROM orders JOIN customer ON o_custkey = c_custkey
                  JOIN nation ON c_nationkey = n_nationkey
                  JOIN region ON n_regionkey = r_regionkey) t
WHERE TRUE""",
    "fx_dict": """
SELECT * FROM (VALUES
  ('geslacht', 1, 'Man', 1), ('geslacht', 2, 'Vrouw', 2), ('geslacht', 3, 'Niet', 3),
  ('lftkompas', 1, 'groep 1', 1), ('lftkompas', 2, 'groep 2', 2), ('lftkompas', 3, 'groep 3', 3),
  ('gewicht5', 1, 'obesitas', 1), ('gewicht5', 2, 'overgewicht', 2), ('gewicht5', 3, 'klasse 3', 3),
  ('gewicht5', 4, 'klasse 4', 4), ('gewicht5', 5, 'klasse 5', 5)) AS t(variable, code, label, ord)""",
    "fx_areas": """
SELECT concat('GM', lpad(CAST(n_nationkey AS VARCHAR), 4, '0')) AS area_key, n_name AS title,
       concat('GM', lpad(CAST(n_nationkey AS VARCHAR), 4, '0')) AS municipality,
       concat('GM', lpad(CAST(n_nationkey AS VARCHAR), 4, '0')) AS detailregioncode
FROM nation
UNION ALL
SELECT concat('WK', lpad(CAST(n_nationkey AS VARCHAR), 4, '0'), '0', w),
       concat(n_name, '-W', w),
       concat('GM', lpad(CAST(n_nationkey AS VARCHAR), 4, '0')),
       concat('WK', lpad(CAST(n_nationkey AS VARCHAR), 4, '0'), '0', w)
FROM nation CROSS JOIN (SELECT * FROM (VALUES ('0'), ('1'), ('2')) AS v(w)) d""",
    "fx_survey": """
SELECT l_orderkey AS row_a, l_linenumber AS row_b, CAST(year(l_shipdate) AS INT) AS vo_wave,
       s_nationkey AS vo_gemeente, l_quantity AS vo_weight, l_linenumber AS vo_stratum,
       CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS vo_ind_a,
       CASE l_returnflag WHEN 'R' THEN 1 WHEN 'N' THEN 0 ELSE 9 END AS vo_ind_b,
       CASE WHEN (l_orderkey * 7 + l_partkey * 3) % 50 < 15 + s_nationkey % 3 THEN 1 ELSE 0 END AS vo_ind_c,
       CAST(l_partkey % 3 AS INT) AS vo_ind_d
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "fx_indicators": """
SELECT * FROM (VALUES ('IND_A', 'Hoger = gunstig'), ('ind_b', 'Hoger = ongunstig'),
  ('IND_C', 'Hoger = ongunstig'), ('IND_X', 'Hoger = gunstig')) AS t(code, richting)""",
    "fx_vacc": """
SELECT regios, concat(CAST(y AS VARCHAR), 'JJ00') AS perioden, vaccinaties,
       CAST(pop AS DOUBLE) AS populatie_1,
       CASE WHEN y < 1998 THEN CAST(vac AS DOUBLE) END AS gevaccineerdenmet_2,
       CASE WHEN y < 1998 THEN CAST(100 AS DOUBLE) * vac / pop END AS vaccinatiegraadmet_3,
       CASE WHEN y >= 1998 AND NOT (y = 2001 AND blank = 1) THEN CAST(vac AS DOUBLE) END AS gevaccineerdenzonder_4,
       CASE WHEN y >= 1998 AND NOT (y = 2001 AND blank = 1) THEN CAST(100 AS DOUBLE) * vac / pop END AS vaccinatiegraadzonder_5
FROM (
  SELECT concat('GM', lpad(CAST(c_nationkey AS VARCHAR), 4, '0')) AS regios, CAST(year(o_orderdate) AS INT) AS y,
         o_orderpriority AS vaccinaties, count(*) AS pop,
         CAST(sum(CASE WHEN o_orderstatus <> 'P' THEN 1 ELSE 0 END) AS BIGINT) AS vac,
         CASE WHEN c_nationkey % 2 = 0 THEN 1 ELSE 0 END AS blank
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey, CAST(year(o_orderdate) AS INT), o_orderpriority
  UNION ALL
  SELECT 'GG0001', CAST(year(o_orderdate) AS INT), o_orderpriority, count(*),
         CAST(sum(CASE WHEN o_orderstatus <> 'P' THEN 1 ELSE 0 END) AS BIGINT), 0
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
              JOIN region ON n_regionkey = r_regionkey
  WHERE r_name = 'EUROPE' GROUP BY CAST(year(o_orderdate) AS INT), o_orderpriority
  UNION ALL
  SELECT 'NL01  ', CAST(year(o_orderdate) AS INT), o_orderpriority, count(*),
         CAST(sum(CASE WHEN o_orderstatus <> 'P' THEN 1 ELSE 0 END) AS BIGINT), 0
  FROM orders GROUP BY CAST(year(o_orderdate) AS INT), o_orderpriority) t""",
    "fx_monitor": """
SELECT c_custkey AS id, CAST(c_nationkey * 100 + c_custkey % 4 AS INT) AS nog_wijk2020,
       CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE c_nationkey END AS gemeentecode,
       CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN '5'
            ELSE concat('0', CAST(c_custkey % 4 AS VARCHAR)) END AS wijkcode
FROM customer""",
    "fx_varlabels": """
SELECT concat('VO_', upper(replace(p_type, ' ', '')), CAST(p_partkey AS VARCHAR)) AS variable,
       CASE p_partkey % 5
            WHEN 0 THEN concat(p_name, ' (opgeschoond)')
            WHEN 1 THEN concat(p_type, ' Opgeschoond')
            WHEN 2 THEN concat(p_name, ' opgeschoond ', p_brand, ' opgeschoond')
            WHEN 3 THEN p_name END AS label
FROM part""",
    # prepared weight microdata: end year, class 5 merged into 4
    "wm": """
SELECT schooljaar, geslacht, lftkompas, CASE WHEN gewicht5 = 5 THEN 4 ELSE gewicht5 END AS gewicht5,
       regiokind, gemeentekind, wijkkind, tezwaar,
       CAST(substring(schooljaar, 1, 4) AS INT) + 1 AS eindjaar
FROM fx_meas""",
    "members": """
SELECT n_name AS gemeentekind FROM nation UNION ALL SELECT 'NATION_NONE'""",
}

DEPENDS = {"wm": ["fx_meas"]}

#: The queries about missing years and averages over them read the fixture with its gaps.
GAPPED = {"missing_geo_years", "densify_years", "moving_average", "moving_average_district", "moving_average_subregion",
          "moving_average_region", "moving_average_no_fill", "smoothed_count"}
GAPS = "WHERE y <> 1997 AND NOT (n_name = 'NATION_3' AND y = 1998)"


def with_ctes(needed: list[str], ctes: list[tuple[str, str]], final: str) -> str:
    """``WITH`` the needed fixture views (dependencies first), then ``ctes``."""
    order: list[str] = []

    def add(name: str) -> None:
        for dep in DEPENDS.get(name, []):
            add(dep)
        if name not in order:
            order.append(name)

    for n in needed:
        add(n)
    parts = [f"{n} AS ({FIXTURE_SQL[n].strip()})" for n in order]
    parts += [f"{n} AS ({sql.strip()})" for n, sql in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + final.strip()


def _on(a: str, b: str, cols: list[str]) -> str:
    return " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in cols)


def r4(x: str) -> str:
    return f"round({x}, 4)"


def _round_to_floor(sql: str) -> str:
    """Rewrite every ``round(expr, 4)`` as ``floor(expr * 10000 + 0.5) / 10000``
    (the same IEEE arithmetic as the Spark side, see ``registry.round_half_up``)."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        k, depth = j + len("round("), 1
        start = k
        comma = None
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        inner, places = sql[start:comma], sql[comma + 1:k - 1].strip()
        n = 10 ** int(places)
        out.append(f"(floor(({_round_to_floor(inner)}) * {n} + 0.5) / {n})")
        i = k


# Grain definitions for SQL: geo columns, other dims, class column.
GRAINS = {
    "g1": (["gemeentekind", "wijkkind"], ["geslacht", "lftkompas"], "gewicht5", True, True),
    "g2": (["gemeentekind"], ["geslacht", "lftkompas"], "gewicht5", True, True),
    "g3": (["regiokind"], ["geslacht", "lftkompas"], "gewicht5", True, False),
    "g4": ([], ["geslacht", "lftkompas"], "gewicht5", True, False),
    "g5": (["gemeentekind"], ["geslacht"], "gewicht5", False, True),
    "g6": (["regiokind"], ["geslacht"], "gewicht5", False, False),
    "g7": ([], ["geslacht"], "gewicht5", False, False),
    "g8": (["gemeentekind"], ["lftkompas"], "gewicht5", False, True),
    "g9": (["regiokind"], ["lftkompas"], "gewicht5", False, False),
    "g10": ([], ["lftkompas"], "gewicht5", False, False),
    "g11": (["gemeentekind"], [], "gewicht5", False, True),
    "g12": (["regiokind"], [], "gewicht5", False, False),
    "g13": ([], [], "gewicht5", False, False),
    "g14": (["gemeentekind"], ["geslacht"], "tezwaar", False, True),
}


def grain_ctes(g: str, prefix: str, zero_fill: bool | None = None, members: bool = True,
               fill_years: bool | None = None, moving: bool = True) -> tuple[list[tuple[str, str]], list[str]]:
    """CTEs computing one grain table; returns (ctes, output columns).

    The last CTE is ``{prefix}_out``.
    """
    geo, dims, k, zf_default, member_level = GRAINS[g]
    zf = zf_default if zero_fill is None else zero_fill
    keys = geo + dims + ["eindjaar", k]
    cat = dims + [k]
    cells = f"{prefix}_cells"
    ctes = [(cells, f"SELECT {', '.join(keys)}, count(*) AS n FROM wm GROUP BY {', '.join(keys)}")]
    # areas with an observed flag
    if geo:
        src = f"SELECT DISTINCT {', '.join(geo)}, true AS o FROM {cells}"
        if member_level and members and geo == ["gemeentekind"]:
            src += " UNION ALL SELECT gemeentekind, false FROM members"
        ctes.append((f"{prefix}_geos", f"SELECT {', '.join(geo)}, bool_or(o) AS gobs FROM ({src}) s GROUP BY {', '.join(geo)}"))
    else:
        ctes.append((f"{prefix}_geos", f"SELECT true AS gobs WHERE EXISTS (SELECT 1 FROM {cells})"))
    if fill_years is None:
        fill_years = members if member_level else True
    if fill_years:
        ctes.append((f"{prefix}_yrs", f"SELECT CAST(unnest(generate_series(min(eindjaar), max(eindjaar))) AS INT) AS eindjaar FROM {cells}"))
    else:
        ctes.append((f"{prefix}_yrs", f"SELECT DISTINCT eindjaar FROM {cells}"))
    froms = [f"{prefix}_geos g", f"{prefix}_yrs y"] + [f"(SELECT DISTINCT {d} FROM {cells}) d{i}" for i, d in enumerate(cat)]
    sel = [f"g.{c}" for c in geo] + [f"d{i}.{d}" for i, d in enumerate(cat)] + ["y.eindjaar"]
    zf_expr = f"g.gobs AND y.eindjaar IN (SELECT eindjaar FROM {cells})" if zf else "false"
    ctes.append((f"{prefix}_grid", f"SELECT {', '.join(sel)}, {zf_expr} AS zf FROM {', '.join(froms)}"))
    ctes.append((f"{prefix}_filled",
                 f"SELECT {', '.join('q.' + c for c in keys)}, "
                 f"CAST(CASE WHEN c.n IS NOT NULL THEN c.n WHEN q.zf THEN 0 END AS BIGINT) AS n "
                 f"FROM {prefix}_grid q LEFT JOIN {cells} c ON {_on('q', 'c', keys)}"))
    within = geo + dims + ["eindjaar"]
    ctes.append((f"{prefix}_share",
                 f"SELECT *, CAST(sum(n) OVER (PARTITION BY {', '.join(within)}) AS BIGINT) AS n_total "
                 f"FROM {prefix}_filled"))
    ctes.append((f"{prefix}_perc",
                 f"SELECT *, CASE WHEN n_total <> 0 THEN CAST(n AS DOUBLE) / n_total * 100.0 END AS perc "
                 f"FROM {prefix}_share"))
    part = geo + dims + [k]
    win = f"(PARTITION BY {', '.join(part)} ORDER BY eindjaar ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"
    if not moving:
        cols = keys + ["n", "n_total", "perc"] if zf else keys + ["n", "perc"]
        ctes.append((f"{prefix}_out", f"SELECT {', '.join(cols)} FROM {prefix}_perc"))
        return ctes, cols
    if zf:
        ctes.append((f"{prefix}_out",
                     f"SELECT {', '.join(keys)}, n, n_total, perc, avg(n) OVER {win} AS n_ma, "
                     f"avg(perc) OVER {win} AS perc_ma, avg(n_total) OVER {win} AS n_total_ma, "
                     f"avg(perc) OVER {win} * n_total / 100.0 AS n_weighted FROM {prefix}_perc"))
        return ctes, keys + ["n", "n_total", "perc", "n_ma", "perc_ma", "n_total_ma", "n_weighted"]
    ctes.append((f"{prefix}_out",
                 f"SELECT {', '.join(keys)}, n, perc, avg(n) OVER {win} AS n_ma, "
                 f"avg(perc) OVER {win} AS perc_ma FROM {prefix}_perc"))
    return ctes, keys + ["n", "perc", "n_ma", "perc_ma"]


DOUBLE_COLS = {"perc", "n_ma", "perc_ma", "n_total_ma", "n_weighted"}


def select_rounded(cols: list[str], src: str, doubles: set[str] = DOUBLE_COLS) -> str:
    return "SELECT " + ", ".join(r4(c) + f" AS {c}" if c in doubles else c for c in cols) + f" FROM {src}"


def grain_sql(g: str, **kw) -> str:
    ctes, cols = grain_ctes(g, g, **kw)
    return with_ctes(["wm", "members"], ctes, select_rounded(cols, f"{g}_out"))


def grid_sql(g: str, **kw) -> str:
    """The gap-filled count grid alone (keys + n)."""
    ctes, _ = grain_ctes(g, g, **kw)
    geo, dims, k, _, _ = GRAINS[g]
    keys = geo + dims + ["eindjaar", k]
    return with_ctes(["wm", "members"], ctes, f"SELECT {', '.join(keys)}, n FROM {g}_filled")


def _types() -> dict[str, str]:
    return {"regiokind": "VARCHAR", "gemeentekind": "VARCHAR", "wijkkind": "VARCHAR", "geslacht": "INT",
            "lftkompas": "INT", "eindjaar": "INT", "gewicht5": "INT", "tezwaar": "VARCHAR"}


FINEST = ["regiokind", "gemeentekind", "wijkkind", "geslacht", "lftkompas", "eindjaar", "gewicht5", "tezwaar"]

CODES_CTE = ("codes", r"""
SELECT title AS gemeentenaam, CAST(regexp_extract(area_key, '\d+') AS INT) AS code
FROM fx_areas WHERE starts_with(area_key, 'GM') AND title IN (SELECT gemeentekind FROM members)""")

DISTRICTS_SQL = """
SELECT substring(wk.Wijkcode, 3) AS Wijkcode, wk.Wijknaam, wk.Municipality, gm.Gemeentenaam
FROM (SELECT detailregioncode AS Wijkcode, title AS Wijknaam, municipality AS Municipality
      FROM fx_areas WHERE starts_with(area_key, 'WK')) wk
LEFT JOIN (SELECT title AS Gemeentenaam, municipality AS Municipality
           FROM fx_areas WHERE starts_with(area_key, 'GM')) gm ON wk.Municipality = gm.Municipality"""

KNOWN = ("CASE WHEN {c} IN (SELECT code FROM fx_dict WHERE variable = '{v}') THEN {c} END")


def _cube_base(src: str, value: str) -> str:
    return (f"SELECT Jaar, geolevel, geoitem, "
            f"{KNOWN.format(c='geslacht', v='geslacht')} AS JG_Geslacht, "
            f"{KNOWN.format(c='lftkompas', v='lftkompas')} AS JG_Lftklasse, "
            f"CASE WHEN gewicht5 IN (1, 2, 3, 4) THEN gewicht5 END AS gewicht5, {value} FROM {src}")


def _widen(src: str, ids: list[str], value: str, names: dict, rnd: bool = True) -> str:
    cols = []
    for v, name in names.items():
        cond = "gewicht5 IS NULL" if v is None else f"gewicht5 = {v}"
        e = f"max(CASE WHEN {cond} THEN {value} END)"
        cols.append(f"{r4(e) if rnd else e} AS \"{name}\"")
    return f"SELECT {', '.join(ids)}, {', '.join(cols)} FROM {src} GROUP BY {', '.join(ids)}"


CUBE_IDS = ["Jaar", "geolevel", "geoitem", "JG_Geslacht", "JG_Lftklasse"]


def weight_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    g2k = "gemeentekind, geslacht, lftkompas, eindjaar, gewicht5"
    q["count_by_grain"] = with_ctes(["wm"], [], f"SELECT {g2k}, count(*) AS n FROM wm GROUP BY {g2k}")

    parts = []
    ty = _types()
    for g, (geo, dims, k, _, _) in GRAINS.items():
        keys = geo + dims + ["eindjaar", k]
        sel = ", ".join(c if c in keys else f"CAST(NULL AS {ty[c]}) AS {c}" for c in FINEST)
        parts.append(f"SELECT '{g}' AS grain, {sel}, count(*) AS n FROM wm GROUP BY {', '.join(keys)}")
    q["count_multi_grain"] = with_ctes(["wm"], [], "\nUNION ALL\n".join(parts))

    q["share_in_group"] = with_ctes(["wm"], [("c", f"SELECT {g2k}, count(*) AS n FROM wm GROUP BY {g2k}")], f"""
SELECT {g2k}, n, CAST(sum(n) OVER w AS BIGINT) AS n_total,
       round(CAST(n AS DOUBLE) / sum(n) OVER w * 100.0, 4) AS perc
FROM c WINDOW w AS (PARTITION BY gemeentekind, geslacht, lftkompas, eindjaar)""")

    q["missing_geo_years"] = with_ctes(["wm", "members"], [
        ("c", "SELECT gemeentekind, eindjaar FROM wm GROUP BY gemeentekind, eindjaar"),
        ("areas", "SELECT DISTINCT gemeentekind FROM (SELECT gemeentekind FROM c UNION ALL SELECT gemeentekind FROM members) u"),
        ("spine", "SELECT a.gemeentekind, CAST(y AS INT) AS eindjaar FROM areas a, "
                  "(SELECT unnest(generate_series(min(eindjaar), max(eindjaar))) AS y FROM c) ys"),
    ], """SELECT s.gemeentekind, s.eindjaar FROM spine s WHERE NOT EXISTS
  (SELECT 1 FROM c WHERE c.gemeentekind IS NOT DISTINCT FROM s.gemeentekind AND c.eindjaar = s.eindjaar)""")

    q["densify_zero"] = grid_sql("g2", members=False, fill_years=False)
    q["densify_years"] = grid_sql("g2", members=True, fill_years=True)
    q["densify_levels"] = with_ctes(["wm"], [
        ("c", f"SELECT {g2k}, count(*) AS n FROM wm GROUP BY {g2k}"),
        ("areas", "SELECT DISTINCT gemeentekind FROM c"), ("years", "SELECT DISTINCT eindjaar FROM c"),
        ("sexes", "SELECT geslacht FROM c UNION SELECT unnest([1, 2, 3, 4])"),
        ("ages", "SELECT lftkompas FROM c UNION SELECT unnest([1, 2, 3])"),
        ("classes", "SELECT gewicht5 FROM c UNION SELECT unnest([1, 2, 3, 4, 5])"),
    ], """SELECT a.gemeentekind, s.geslacht, l.lftkompas, y.eindjaar, k.gewicht5, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM areas a CROSS JOIN sexes s CROSS JOIN ages l CROSS JOIN years y CROSS JOIN classes k
LEFT JOIN c ON c.gemeentekind = a.gemeentekind AND c.geslacht = s.geslacht AND c.lftkompas = l.lftkompas
 AND c.eindjaar = y.eindjaar AND c.gewicht5 IS NOT DISTINCT FROM k.gewicht5""")
    q["moving_average"] = grain_sql("g2")
    q["moving_average_district"] = grain_sql("g1")
    q["moving_average_subregion"] = grain_sql("g3")
    q["moving_average_region"] = grain_sql("g4")
    q["moving_average_no_fill"] = grain_sql("g5")

    ctes, parts = [], []
    shown = [c for c in FINEST if c not in ("wijkkind", "tezwaar")]
    for g in ["g6", "g7", "g8", "g9", "g10", "g11", "g12", "g13"]:
        c, cols = grain_ctes(g, g)
        ctes += c
        sel = ", ".join(x if x in cols else f"CAST(NULL AS {ty[x]}) AS {x}" for x in shown)
        parts.append(f"SELECT '{g}' AS grain, {sel}, n, {r4('perc')} AS perc, {r4('n_ma')} AS n_ma, "
                     f"{r4('perc_ma')} AS perc_ma FROM {g}_out")
    q["check_tables"] = with_ctes(["wm", "members"], ctes, "\nUNION ALL\n".join(parts))

    c3, _ = grain_ctes("g3", "g3")
    q["smoothed_count"] = with_ctes(["wm", "members"], c3,
                                    "SELECT regiokind, geslacht, lftkompas, eindjaar, gewicht5, n_total, "
                                    f"{r4('perc_ma')} AS perc_ma, {r4('n_weighted')} AS n_weighted FROM g3_out")
    q["overweight_by_sex"] = grain_sql("g14")
    q["district_hierarchy"] = with_ctes(["fx_areas"], [], DISTRICTS_SQL)

    names = {1: "JG_Gewicht_1", 2: "JG_Gewicht_2", 3: "JG_Gewicht_3", 4: "JG_Gewicht_4", None: "JG_Gewicht_NA"}
    c1, _ = grain_ctes("g1", "g1")
    q["cube_district"] = with_ctes(["wm", "members", "fx_areas", "fx_dict"], c1 + [
        ("d", DISTRICTS_SQL),
        ("src", "SELECT o.eindjaar AS Jaar, 'wijk23' AS geolevel, d.Wijkcode AS geoitem, o.geslacht, o.lftkompas, "
                "o.gewicht5, o.n_weighted FROM g1_out o LEFT JOIN d ON o.gemeentekind = d.Gemeentenaam "
                "AND o.wijkkind = d.Wijknaam WHERE o.n_total IS NOT NULL AND o.n_total <> 0 AND d.Wijkcode IS NOT NULL"),
        ("base", _cube_base("src", "n_weighted")),
    ], _widen("base", CUBE_IDS, "n_weighted", names))

    c2, _ = grain_ctes("g2", "g2")
    for key, rnd in (("cube_municipality", True), ("cube_municipality_raw", False)):
        q[key] = with_ctes(["wm", "members", "fx_areas", "fx_dict"], c2 + [
            CODES_CTE,
            ("src", "SELECT o.eindjaar AS Jaar, 'gemeente' AS geolevel, c.code AS geoitem, o.geslacht, o.lftkompas, "
                    "o.gewicht5, o.n_weighted FROM g2_out o LEFT JOIN codes c ON o.gemeentekind = c.gemeentenaam "
                    "WHERE o.n_total IS NOT NULL AND o.n_total <> 0"),
            ("base", _cube_base("src", "n_weighted")),
        ], _widen("base", CUBE_IDS, "n_weighted", names, rnd=rnd))

    c3, _ = grain_ctes("g3", "g3")
    c4, _ = grain_ctes("g4", "g4")
    abs_names = {k: (v + "_abs") for k, v in names.items()}
    q["cube_absolute_levels"] = with_ctes(["wm", "members", "fx_areas", "fx_dict"], c2 + c3 + c4 + [
        CODES_CTE,
        ("subcodes", "SELECT r_name AS regionaam, r_regionkey + 1 AS code FROM region"),
        ("src", "SELECT o.eindjaar AS Jaar, 'gemeente' AS geolevel, c.code AS geoitem, o.geslacht, o.lftkompas, "
                "o.gewicht5, o.n FROM g2_out o LEFT JOIN codes c ON o.gemeentekind = c.gemeentenaam "
                "UNION ALL SELECT o.eindjaar, 'subregio', s.code, o.geslacht, o.lftkompas, o.gewicht5, o.n "
                "FROM g3_out o LEFT JOIN subcodes s ON o.regiokind = s.regionaam "
                "UNION ALL SELECT eindjaar, 'ggd', 1, geslacht, lftkompas, gewicht5, n FROM g4_out"),
        ("base", _cube_base("src", "n")),
    ], _widen("base", CUBE_IDS, "n", abs_names, rnd=False))

    labels = {1: "obesitas", 2: "overgewicht", 3: "klasse 3", 4: "klasse 4", None: "NA"}
    q["table_by_municipality"] = with_ctes(["wm", "members"], c2 + [
        ("base", "SELECT * FROM g2_out WHERE gemeentekind IN (SELECT gemeentekind FROM members)"),
    ], _widen("base", ["gemeentekind", "geslacht", "lftkompas", "eindjaar"], "perc_ma", labels))

    q["freq_table"] = with_ctes(["wm"], [
        ("c", "SELECT gewicht5, schooljaar, count(*) AS n FROM wm GROUP BY gewicht5, schooljaar")],
        """SELECT gewicht5, schooljaar, n, CAST(sum(n) OVER w AS BIGINT) AS n_total,
       round(CAST(n AS DOUBLE) / sum(n) OVER w * 100.0, 4) AS perc FROM c WINDOW w AS (PARTITION BY schooljaar)""")
    q["class_year_counts"] = with_ctes(["wm"], [], "SELECT schooljaar, gewicht5, count(*) AS n FROM wm GROUP BY schooljaar, gewicht5")
    q["year_bounds"] = with_ctes(["wm"], [], """
SELECT DISTINCT regiokind, (SELECT min(eindjaar) FROM wm) AS jaar_min, (SELECT max(eindjaar) FROM wm) AS jaar_max FROM wm""")
    return q




# ---------------------------------------------------------------- survey

FIXTURE_SQL["svy"] = """
SELECT vo_wave, vo_gemeente AS g, vo_stratum AS h, vo_weight AS w, var, val FROM (
  SELECT vo_wave, vo_gemeente, vo_stratum, vo_weight, 'vo_ind_a' AS var, CAST(vo_ind_a AS DOUBLE) AS val FROM fx_survey
  UNION ALL SELECT vo_wave, vo_gemeente, vo_stratum, vo_weight, 'vo_ind_b',
         CAST(CASE WHEN vo_ind_b = 9 THEN NULL ELSE vo_ind_b END AS DOUBLE) FROM fx_survey
  UNION ALL SELECT vo_wave, vo_gemeente, vo_stratum, vo_weight, 'vo_ind_c', CAST(vo_ind_c AS DOUBLE) FROM fx_survey
  UNION ALL SELECT vo_wave, vo_gemeente, vo_stratum, vo_weight, 'vo_ind_d', CAST(vo_ind_d AS DOUBLE) FROM fx_survey) u"""
DEPENDS["svy"] = ["fx_survey"]
FIXTURE_SQL["svy_groups"] = """
SELECT n_nationkey AS g FROM nation WHERE n_nationkey IN (SELECT vo_gemeente FROM fx_survey)"""
DEPENDS["svy_groups"] = ["fx_survey"]
FIXTURE_SQL["svy_lv"] = """
SELECT l.vo_wave, l.var, l.n_levels, l.v0,
       (SELECT min(s.val) FROM svy s WHERE s.vo_wave = l.vo_wave AND s.var = l.var AND s.g IS NOT NULL
          AND s.val > l.v0) AS v1
FROM (SELECT vo_wave, var, count(DISTINCT val) AS n_levels, min(val) AS v0 FROM svy
      WHERE val IS NOT NULL AND g IS NOT NULL GROUP BY vo_wave, var) l"""
DEPENDS["svy_lv"] = ["svy"]
FIXTURE_SQL["svy_pairs"] = """
SELECT DISTINCT vo_wave, var, g FROM svy WHERE g IN (SELECT g FROM svy_groups)"""
DEPENDS["svy_pairs"] = ["svy", "svy_groups"]

RS_CTES = [
    ("nh", "SELECT vo_wave, var, h, count(*) AS nh FROM svy GROUP BY vo_wave, var, h"),
    ("design", "SELECT vo_wave, var, CAST(sum(nh) AS BIGINT) AS n_design, count(*) AS n_strata FROM nh GROUP BY vo_wave, var"),
    # per (wave, var, municipality, stratum): the four cells, weights and squared weights
    ("hs", """
SELECT p.vo_wave, p.var, p.g AS m, s.h,
  coalesce(sum(CASE WHEN s.val = l.v0 AND s.g <> p.g THEN s.w END), 0) AS s00,
  coalesce(sum(CASE WHEN s.val = l.v1 AND s.g <> p.g THEN s.w END), 0) AS s10,
  coalesce(sum(CASE WHEN s.val = l.v0 AND s.g = p.g THEN s.w END), 0) AS s01,
  coalesce(sum(CASE WHEN s.val = l.v1 AND s.g = p.g THEN s.w END), 0) AS s11,
  coalesce(sum(CASE WHEN s.val = l.v0 AND s.g <> p.g THEN s.w * s.w END), 0) AS q00,
  coalesce(sum(CASE WHEN s.val = l.v1 AND s.g <> p.g THEN s.w * s.w END), 0) AS q10,
  coalesce(sum(CASE WHEN s.val = l.v0 AND s.g = p.g THEN s.w * s.w END), 0) AS q01,
  coalesce(sum(CASE WHEN s.val = l.v1 AND s.g = p.g THEN s.w * s.w END), 0) AS q11
FROM svy_pairs p JOIN svy s ON s.vo_wave = p.vo_wave AND s.var = p.var
JOIN svy_lv l ON l.vo_wave = p.vo_wave AND l.var = p.var
GROUP BY p.vo_wave, p.var, p.g, s.h"""),
    ("tot", """
SELECT vo_wave, var, m, sum(s00) AS S00, sum(s10) AS S10, sum(s01) AS S01, sum(s11) AS S11
FROM hs GROUP BY vo_wave, var, m"""),
    ("qk", """
SELECT *, CASE WHEN S00 > 0 THEN 1.0 / S00 ELSE 0 END AS c00, CASE WHEN S10 > 0 THEN -1.0 / S10 ELSE 0 END AS c10,
          CASE WHEN S01 > 0 THEN -1.0 / S01 ELSE 0 END AS c01, CASE WHEN S11 > 0 THEN 1.0 / S11 ELSE 0 END AS c11
FROM tot"""),
    # every stratum of the design, also those without rows of the municipality
    ("per_h", """
SELECT q.vo_wave, q.var, q.m, n.h, n.nh,
  coalesce(q.c00 * q.c00 * hs.q00 + q.c10 * q.c10 * hs.q10 + q.c01 * q.c01 * hs.q01 + q.c11 * q.c11 * hs.q11, 0) AS A,
  coalesce(q.c00 * hs.s00 + q.c10 * hs.s10 + q.c01 * hs.s01 + q.c11 * hs.s11, 0) AS B
FROM qk q JOIN nh n ON n.vo_wave = q.vo_wave AND n.var = q.var
LEFT JOIN hs ON hs.vo_wave = q.vo_wave AND hs.var = q.var AND hs.m = q.m AND hs.h = n.h"""),
    ("num", """
SELECT vo_wave, var, m, sum(CAST(nh AS DOUBLE) / (nh - 1) * (A - B * B / nh)) AS num FROM per_h GROUP BY vo_wave, var, m"""),
    ("rs", """
SELECT q.vo_wave, q.var, q.m, d.n_design, d.n_strata, l.n_levels, n.num,
       q.S00 + q.S10 + q.S01 + q.S11 AS W, q.S00, q.S10, q.S01, q.S11,
       (CASE WHEN q.S00 > 0 THEN 1.0 / q.S00 ELSE 0 END + CASE WHEN q.S10 > 0 THEN 1.0 / q.S10 ELSE 0 END
        + CASE WHEN q.S01 > 0 THEN 1.0 / q.S01 ELSE 0 END + CASE WHEN q.S11 > 0 THEN 1.0 / q.S11 ELSE 0 END) AS sinv
FROM qk q JOIN num n ON n.vo_wave = q.vo_wave AND n.var = q.var AND n.m = q.m
JOIN design d ON d.vo_wave = q.vo_wave AND d.var = q.var
JOIN svy_lv l ON l.vo_wave = q.vo_wave AND l.var = q.var"""),
    ("rs2", """
SELECT *, (S00 / W * S11 / W - S01 / W * S10 / W) * (S00 / W * S11 / W - S01 / W * S10 / W)
          / ((S00 + S01) / W * (S10 + S11) / W * (S00 + S10) / W * (S01 + S11) / W) AS x2n
FROM rs"""),
    ("stats", """
SELECT vo_wave, var, m AS Gemeentecode, n_design,
       CASE WHEN n_levels = 2 THEN n_design * x2n END AS x2,
       CASE WHEN n_levels = 2 THEN n_design * num / (W * sinv) END AS delta,
       CASE WHEN n_levels = 2 THEN x2n * W * sinv / num END AS f_stat,
       n_design - n_strata AS nu
FROM rs2"""),
]

RESOLVED = "('vo_ind_a', 'vo_ind_b', 'vo_ind_c')"

# Exact upper tail P(F(1, nu) > f) = I_x(nu/2, 1/2), x = nu / (nu + f): the
# regularized incomplete beta by its continued fraction (modified Lentz), as a
# recursive CTE; the symmetry I_x(a, b) = 1 - I_{1-x}(b, a) picks the side
# where the fraction converges.  Needs ``WITH RECURSIVE``.
_G = "CASE WHEN abs({e}) < 1e-300 THEN 1e-300 ELSE {e} END"
PVAL_CTES = [
    ("pin", f"""
SELECT vo_wave, var, Gemeentecode, CAST(nu AS DOUBLE) / 2 AS a, CAST(0.5 AS DOUBLE) AS b,
       CAST(nu AS DOUBLE) / (CAST(nu AS DOUBLE) + f_stat) AS x0
FROM stats WHERE var IN {RESOLVED} AND f_stat IS NOT NULL"""),
    ("pinit", """
SELECT vo_wave, var, Gemeentecode, flip, A, B, X,
       exp(lgamma(A + B) - lgamma(A) - lgamma(B) + A * ln(X) + B * ln(1 - X)) AS front
FROM (SELECT vo_wave, var, Gemeentecode, x0 >= (a + 1) / (a + b + 2) AS flip,
             CASE WHEN x0 >= (a + 1) / (a + b + 2) THEN b ELSE a END AS A,
             CASE WHEN x0 >= (a + 1) / (a + b + 2) THEN a ELSE b END AS B,
             CASE WHEN x0 >= (a + 1) / (a + b + 2) THEN 1 - x0 ELSE x0 END AS X FROM pin) s"""),
    ("cf(vo_wave, var, Gemeentecode, m, c, d, h, done)", f"""
SELECT vo_wave, var, Gemeentecode, 0, CAST(1 AS DOUBLE), 1 / dd, 1 / dd, false FROM (
  SELECT vo_wave, var, Gemeentecode, {_G.format(e="1 - (A + B) * X / (A + 1)")} AS dd FROM pinit) z
UNION ALL
SELECT vo_wave, var, Gemeentecode, m, c2, d2, h1 * d2 * c2, abs(d2 * c2 - 1) <= 1e-15 FROM (
  SELECT vo_wave, var, Gemeentecode, m, h1, {_G.format(e="1 + aa2 / c1")} AS c2,
         1 / {_G.format(e="1 + aa2 * d1")} AS d2 FROM (
    SELECT vo_wave, var, Gemeentecode, m, d1, c1, h * d1 * c1 AS h1,
           -(A + m) * (A + B + m) * X / ((A + 2 * m) * (A + 1 + 2 * m)) AS aa2 FROM (
      SELECT cf.vo_wave, cf.var, cf.Gemeentecode, cf.m + 1 AS m, cf.h, i.A, i.B, i.X,
             1 / {_G.format(e="1 + l.aa1 * cf.d")} AS d1, {_G.format(e="1 + l.aa1 / cf.c")} AS c1
      FROM cf JOIN pinit i ON i.vo_wave = cf.vo_wave AND i.var = cf.var AND i.Gemeentecode = cf.Gemeentecode,
           LATERAL (SELECT (cf.m + 1) * (i.B - (cf.m + 1)) * i.X
                           / ((i.A - 1 + 2 * (cf.m + 1)) * (i.A + 2 * (cf.m + 1))) AS aa1) l
      WHERE NOT cf.done AND cf.m < 5000) s1) s2) s3"""),
    ("pexact", """
SELECT cf.vo_wave, cf.var, cf.Gemeentecode,
       CASE WHEN i.flip THEN 1 - i.front * cf.h / i.A ELSE i.front * cf.h / i.A END AS p
FROM cf JOIN pinit i ON i.vo_wave = cf.vo_wave AND i.var = cf.var AND i.Gemeentecode = cf.Gemeentecode
WHERE cf.done OR cf.m = 5000"""),
]

def survey_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["unpivot_indicators"] = with_ctes(["fx_survey"], [], """
SELECT row_a, row_b, 'vo_ind_a' AS var, vo_ind_a AS val FROM fx_survey
UNION ALL SELECT row_a, row_b, 'vo_ind_b', CASE WHEN vo_ind_b = 9 THEN NULL ELSE vo_ind_b END FROM fx_survey
UNION ALL SELECT row_a, row_b, 'vo_ind_c', vo_ind_c FROM fx_survey
UNION ALL SELECT row_a, row_b, 'vo_ind_d', vo_ind_d FROM fx_survey""")

    q["svy_weighted_share"] = with_ctes(["svy", "svy_groups", "svy_lv", "svy_pairs"], [
        ("tots", """
SELECT s.vo_wave, s.var, sum(CASE WHEN s.val = l.v1 THEN s.w END) AS W1, sum(CASE WHEN s.val IS NOT NULL THEN s.w END) AS Wall
FROM svy s JOIN svy_lv l ON l.vo_wave = s.vo_wave AND l.var = s.var WHERE s.g IS NOT NULL GROUP BY s.vo_wave, s.var"""),
        ("mine", """
SELECT p.vo_wave, p.var, p.g, coalesce(sum(CASE WHEN s.val = l.v1 THEN s.w END), 0) AS M1,
       coalesce(sum(CASE WHEN s.val IS NOT NULL THEN s.w END), 0) AS Mall
FROM svy_pairs p JOIN svy s ON s.vo_wave = p.vo_wave AND s.var = p.var AND s.g = p.g
JOIN svy_lv l ON l.vo_wave = p.vo_wave AND l.var = p.var GROUP BY p.vo_wave, p.var, p.g"""),
    ], """
SELECT m.vo_wave, m.var, m.g AS Gemeentecode, l.n_levels, l.n_levels = 2 AS is_dichotomous,
  round(CASE WHEN l.n_levels >= 2 AND m.Mall <> 0 THEN m.M1 / m.Mall END, 4) AS perc_gemeente,
  round(CASE WHEN l.n_levels >= 2 AND t.Wall - m.Mall <> 0 THEN (coalesce(t.W1, 0) - m.M1) / (t.Wall - m.Mall) END, 4) AS perc_rest
FROM mine m JOIN svy_lv l ON l.vo_wave = m.vo_wave AND l.var = m.var
JOIN tots t ON t.vo_wave = m.vo_wave AND t.var = m.var""")

    rs_final = """
SELECT vo_wave, var, Gemeentecode, n_design, round(x2, 4) AS x2, round(delta, 4) AS delta,
       round(f_stat, 4) AS f_stat, nu FROM stats WHERE var IN {resolved}""".format(resolved=RESOLVED)
    q["svy_rao_scott"] = with_ctes(["svy", "svy_groups", "svy_lv", "svy_pairs"], RS_CTES, rs_final)

    shares = [
        ("tots", """
SELECT s.vo_wave, s.var, sum(CASE WHEN s.val = l.v1 THEN s.w END) AS W1, sum(CASE WHEN s.val IS NOT NULL THEN s.w END) AS Wall
FROM svy s JOIN svy_lv l ON l.vo_wave = s.vo_wave AND l.var = s.var WHERE s.g IS NOT NULL GROUP BY s.vo_wave, s.var"""),
        ("mine", """
SELECT p.vo_wave, p.var, p.g, coalesce(sum(CASE WHEN s.val = l.v1 THEN s.w END), 0) AS M1,
       coalesce(sum(CASE WHEN s.val IS NOT NULL THEN s.w END), 0) AS Mall
FROM svy_pairs p JOIN svy s ON s.vo_wave = p.vo_wave AND s.var = p.var AND s.g = p.g
JOIN svy_lv l ON l.vo_wave = p.vo_wave AND l.var = p.var GROUP BY p.vo_wave, p.var, p.g"""),
        ("pv3", """
SELECT s.vo_wave, s.var, s.Gemeentecode, e.p FROM stats s LEFT JOIN pexact e
  ON e.vo_wave = s.vo_wave AND e.var = s.var AND e.Gemeentecode = s.Gemeentecode WHERE s.var IN """ + RESOLVED),
        ("dirs", "SELECT * FROM (VALUES ('vo_ind_a', true), ('vo_ind_b', false), ('vo_ind_c', false)) AS d(var, hoger_beter)"),
        ("joined", """
SELECT p.vo_wave, p.var, p.Gemeentecode, p.p, d.hoger_beter,
       CASE WHEN l.n_levels >= 2 AND m.Mall <> 0 THEN m.M1 / m.Mall END AS pg,
       CASE WHEN l.n_levels >= 2 AND t.Wall - m.Mall <> 0 THEN (coalesce(t.W1, 0) - m.M1) / (t.Wall - m.Mall) END AS pr
FROM pv3 p JOIN dirs d ON d.var = p.var
JOIN mine m ON m.vo_wave = p.vo_wave AND m.var = p.var AND m.g = p.Gemeentecode
JOIN svy_lv l ON l.vo_wave = p.vo_wave AND l.var = p.var
JOIN tots t ON t.vo_wave = p.vo_wave AND t.var = p.var"""),
        ("grp", """
SELECT *, CASE WHEN hoger_beter THEN pg > pr ELSE pr > pg END AS gunstig FROM joined"""),
    ]
    groups = """CASE WHEN p > 0.05 THEN 3 WHEN NOT gunstig AND p < 0.01 THEN 1 WHEN NOT gunstig AND p >= 0.01 THEN 2
            WHEN gunstig AND p >= 0.01 THEN 4 WHEN gunstig AND p < 0.01 THEN 5 END"""
    ctes = RS_CTES + PVAL_CTES + shares
    q["svy_significance"] = "WITH RECURSIVE" + with_ctes(["svy", "svy_groups", "svy_lv", "svy_pairs"], ctes, f"""
SELECT CAST(vo_wave AS INT) AS Jaar, 'gemeente' AS geolevel, Gemeentecode AS geoitem, var, gunstig,
       {groups} AS pgroep FROM grp""")[len("WITH"):]
    q["svy_p_value"] = "WITH RECURSIVE" + with_ctes(["svy", "svy_groups", "svy_lv", "svy_pairs"], ctes, f"""
SELECT CAST(vo_wave AS INT) AS Jaar, Gemeentecode AS geoitem, var, round(p, 4) AS p, {groups} AS pgroep
FROM grp""")[len("WITH"):]

    q["parse_direction"] = with_ctes([], [("dt", """
SELECT 'IND_' || CAST(p_partkey AS VARCHAR) AS code,
       CASE p_partkey % 4 WHEN 0 THEN 'Hoger = gunstig' WHEN 1 THEN 'Hoger = ongunstig' WHEN 2 THEN 'Hoger = neutraal'
            ELSE 'Richting ' || p_brand END AS richting FROM part"""),
        ("dc", r"SELECT code, richting, nullif(regexp_extract(richting, '.*= (\w+)', 1), '') AS richting_code FROM dt")], """
SELECT code, richting, richting_code,
       CASE WHEN richting_code = 'gunstig' THEN true WHEN richting_code = 'ongunstig' THEN false END AS hoger_beter FROM dc""")
    q["codes_present"] = with_ctes(["fx_survey"], [], """
SELECT n_nationkey AS code, n_name AS naam FROM nation WHERE n_nationkey IN (SELECT vo_gemeente FROM fx_survey)""")
    q["user_missing_to_null"] = with_ctes(["fx_survey"], [], """
SELECT row_a, row_b, CASE WHEN vo_ind_b = 9 THEN NULL ELSE vo_ind_b END AS vo_ind_b FROM fx_survey""")
    return q


# ---------------------------------------------------------------- dictionaries, vaccination, relabel, derived

# The vaccine types, as in the vaccination job.
VACCINE_TYPES_SQL = [
    "DKTP basisimmuun (2 jaar)", "Hib volledig (2 jaar)", "BMR basisimmuun (2 jaar)",
    "MenC/ACWY basisimmuun (2 jaar)", "Pneumokokken volledig (2 jaar)", "Hepatitis B volledig (2 jaar)",
    "D(K)TP volledig (10 jaar)", "BMR volledig (10 jaar)", "HPV volledig (14 jaar)",
    "MenACWY volledig (cohorten 2001-2005)", "MenACWY volledig (15 jaar)", "Geen enkele vaccinatie (2 jaar)",
    "HPV volledig meisjes (11 jaar)", "HPV volledig jongens (11 jaar)", "D(K)TP voldoende beschermd (5 jaar)",
]


def _sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def other_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    d = "(SELECT code, label FROM fx_dict WHERE variable = '{v}'{extra})"
    q["decode_labels"] = with_ctes(["fx_meas", "fx_dict"], [], f"""
SELECT m.gemeentekind, m.geslacht, m.lftkompas, m.klasse AS gewicht5, s.label AS geslacht_label,
       a.label AS lftkompas_label, k.label AS gewicht5_label
FROM (SELECT *, CASE WHEN gewicht5 = 5 THEN 4 ELSE gewicht5 END AS klasse FROM fx_meas) m
LEFT JOIN {d.format(v='geslacht', extra='')} s ON m.geslacht = s.code
LEFT JOIN {d.format(v='lftkompas', extra='')} a ON m.lftkompas = a.code
LEFT JOIN {d.format(v='gewicht5', extra=' AND ord <= 4')} k ON m.klasse = k.code""")
    q["recode_codes"] = with_ctes(["fx_meas", "fx_dict"], [], f"""
SELECT m.geslacht, m.klasse AS gewicht5, k.label AS gewicht5_label,
       CASE k.label WHEN 'obesitas' THEN 1 WHEN 'overgewicht' THEN 2 WHEN 'klasse 3' THEN 3 WHEN 'klasse 4' THEN 4 END AS gewicht5_code
FROM (SELECT geslacht, CASE WHEN gewicht5 = 5 THEN 4 ELSE gewicht5 END AS klasse FROM fx_meas) m
LEFT JOIN {d.format(v='gewicht5', extra='')} k ON m.klasse = k.code""")
    q["dimension_items"] = with_ctes(["fx_dict", "fx_areas", "members"], [CODES_CTE], """
SELECT variable AS dimensie, code AS Itemcode, label AS Naam, ord AS Volgnr FROM fx_dict WHERE variable IN ('geslacht', 'lftkompas')
UNION ALL
SELECT 'gemeente', code, gemeentenaam, CAST(row_number() OVER (ORDER BY code) AS INT) FROM codes""")

    types = ", ".join(_sq(t) for t in VACCINE_TYPES_SQL)
    recode = "CASE label " + " ".join(f"WHEN {_sq(t)} THEN {i + 1}" for i, t in enumerate(VACCINE_TYPES_SQL)) + " END"
    q["vaccination_cube"] = with_ctes(["fx_vacc", "fx_areas", "members"], [
        ("vl", f"""
SELECT DISTINCT o_orderpriority AS key,
       CASE CAST(substring(o_orderpriority, 1, 1) AS INT) WHEN 1 THEN {_sq(VACCINE_TYPES_SQL[0])}
            WHEN 2 THEN {_sq(VACCINE_TYPES_SQL[3])} WHEN 3 THEN {_sq(VACCINE_TYPES_SQL[6])}
            WHEN 4 THEN {_sq(VACCINE_TYPES_SQL[9])} ELSE 'Onbekend vaccin' END AS title FROM orders"""),
        ("keys", "SELECT area_key AS key FROM fx_areas WHERE starts_with(area_key, 'GM') AND title IN (SELECT gemeentekind FROM members)"),
        ("f", r"""
SELECT regios, vl.title AS label, CAST(regexp_extract(perioden, '\d+') AS INT) AS Jaar, trim(regios) AS Regio,
       coalesce(gevaccineerdenzonder_4, gevaccineerdenmet_2) AS g, coalesce(vaccinatiegraadzonder_5, vaccinatiegraadmet_3) AS graad,
       populatie_1 AS pop, TRY_CAST(trim(substring(regios, 3)) AS INT) AS gemeentecode
FROM fx_vacc LEFT JOIN vl ON fx_vacc.vaccinaties = vl.key"""),
        ("u", f"""
SELECT Jaar, 'gemeente' AS geolevel, gemeentecode AS geoitem, label, g, pop FROM f
WHERE trim(regios) IN (SELECT key FROM keys) AND label IN ({types}) AND g IS NOT NULL
UNION ALL SELECT Jaar, 'ggd', 1, label, g, pop FROM f
WHERE Regio = 'GG0001' AND label IN ({types}) AND g IS NOT NULL AND graad IS NOT NULL
UNION ALL SELECT Jaar, 'nederland', 1, label, g, pop FROM f
WHERE Regio = 'NL01' AND label IN ({types}) AND g IS NOT NULL AND graad IS NOT NULL"""),
    ], f"""
SELECT Jaar, geolevel, geoitem, {recode} AS RVP_Vaccinatie, round(g, 4) AS RVP_Gevaccineerden,
       round(pop, 4) AS RVP_Populatie FROM u""")
    q["vaccination_cube_keyed"] = q["vaccination_cube_ordered"] = q["vaccination_cube"]
    q["period_to_date"] = with_ctes(["fx_vacc"], [], r"""
SELECT regios, perioden, vaccinaties, CAST(regexp_extract(perioden, '\d+') AS INT) AS jaar,
       CASE substring(perioden, 5, 2)
            WHEN 'JJ' THEN make_date(CAST(substring(perioden, 1, 4) AS INT), 1, 1)
            WHEN 'KW' THEN make_date(CAST(substring(perioden, 1, 4) AS INT), (CAST(substring(perioden, 7, 2) AS INT) - 1) * 3 + 1, 1)
            WHEN 'MM' THEN make_date(CAST(substring(perioden, 1, 4) AS INT), CAST(substring(perioden, 7, 2) AS INT), 1) END AS perioden_date,
       CASE substring(perioden, 5, 2) WHEN 'JJ' THEN 'Y' WHEN 'KW' THEN 'Q' WHEN 'MM' THEN 'M' END AS perioden_freq
FROM fx_vacc""")

    q["pad_and_compose_code"] = with_ctes(["fx_monitor"], [("x", """
SELECT id, CASE WHEN nog_wijk2020 IS NOT NULL THEN printf('%06d', nog_wijk2020) END AS nog_wijk2020,
       CASE WHEN gemeentecode IS NOT NULL THEN printf('%04d', gemeentecode) END || wijkcode AS fullcode FROM fx_monitor""")], """
SELECT id, nog_wijk2020, CASE WHEN length(fullcode) >= 6 THEN fullcode END AS wijkcode_volledig FROM x""")
    q["clean_labels"] = with_ctes(["fx_varlabels"], [], """
SELECT variable, regexp_replace(label, '( |).?opgeschoond.?', '', 'i') AS label FROM fx_varlabels""")
    q["prefix_columns"] = with_ctes(["fx_monitor"], [], """
SELECT id AS VO_id, nog_wijk2020 AS VO_nog_wijk2020, gemeentecode AS VO_gemeentecode, wijkcode AS VO_wijkcode FROM fx_monitor""")
    q["resolve_columns"] = with_ctes(["fx_varlabels"], [
        ("codes", "SELECT lower(replace(p_type, ' ', '')) || CAST(p_partkey * 3 AS VARCHAR) AS code FROM part"),
        ("pairs", "SELECT DISTINCT c.code, v.variable FROM codes c JOIN fx_varlabels v ON contains(lower(v.variable), lower(c.code))"),
    ], "SELECT code, variable, count(*) OVER (PARTITION BY code) AS n_matches FROM pairs")

    cube = weight_oracles()["cube_municipality_raw"]
    # reuse the cube SQL as a sub-select
    derived = f"""
SELECT *, g1 + g2 + g3 + g4 AS JG_Gewicht_totaal, g1 + g2 AS JG_Overgewicht FROM (
  SELECT Jaar, geolevel, geoitem, JG_Geslacht, JG_Lftklasse, JG_Gewicht_1 AS g1, JG_Gewicht_2 AS g2,
         JG_Gewicht_3 AS g3, JG_Gewicht_4 AS g4, JG_Gewicht_NA AS gna FROM ({cube}) c) x"""

    def share(num: str) -> str:
        return f"CASE WHEN JG_Gewicht_totaal <> 0 THEN ({num}) / JG_Gewicht_totaal * 100.0 END"

    q["derived_indicators"] = f"""
SELECT Jaar, geolevel, geoitem, JG_Geslacht, JG_Lftklasse, round(g1, 4) AS JG_Gewicht_1, round(g2, 4) AS JG_Gewicht_2,
       round(g3, 4) AS JG_Gewicht_3, round(g4, 4) AS JG_Gewicht_4, round(gna, 4) AS JG_Gewicht_NA, round(JG_Gewicht_totaal, 4) AS JG_Gewicht_totaal,
       round({share('g1')}, 4) AS JG_Gewicht_1_perc, round({share('g2')}, 4) AS JG_Gewicht_2_perc,
       round({share('g3')}, 4) AS JG_Gewicht_3_perc, round({share('g4')}, 4) AS JG_Gewicht_4_perc,
       round(JG_Overgewicht, 4) AS JG_Overgewicht, round({share('g1 + g2')}, 4) AS JG_Overgewicht_perc
FROM ({derived}) d"""

    q["formulas_municipality"] = q["derived_indicators"]
    absolute = "a.JG_Gewicht_1_abs + a.JG_Gewicht_2_abs + a.JG_Gewicht_3_abs + a.JG_Gewicht_4_abs"
    q["formulas_absolute"] = "SELECT a.*, " + ", ".join(
        f"round(CASE WHEN {absolute} <> 0 THEN CAST(a.JG_Gewicht_{k}_abs AS DOUBLE) / ({absolute}) * 100 END, 4) AS JG_Gewicht_{k}_abs_perc"
        for k in (1, 2, 3, 4)) + f" FROM ({weight_oracles()['cube_absolute_levels']}) a"
    q["formulas_vaccination"] = f"""
SELECT v.*, round(90 - rate, 4) AS RVP_Tekort, round(rate, 4) AS RVP_Vaccinatiegraad, round(RVP_Populatie - RVP_Gevaccineerden, 4) AS RVP_Niet,
       round(100 - rate, 4) AS RVP_Niet_perc, round(CASE WHEN rate IS NOT NULL THEN RVP_Populatie - RVP_Gevaccineerden END, 4) AS RVP_Niet_som
FROM (SELECT *, CASE WHEN RVP_Populatie <> 0 THEN RVP_Gevaccineerden / RVP_Populatie * 100 END AS rate FROM ({q['vaccination_cube']}) c) v""".replace("v.*", "v.* EXCLUDE (rate)")

    def sup(num: str, thr: str) -> str:
        return f"round(CASE WHEN {thr} >= 50 THEN {share(num)} END, 4)"

    q["threshold_suppress"] = f"""
SELECT Jaar, geolevel, geoitem, JG_Geslacht, JG_Lftklasse,
       {sup('g1', 'JG_Gewicht_totaal')} AS JG_Gewicht_1_perc, {sup('g2', 'JG_Gewicht_totaal')} AS JG_Gewicht_2_perc,
       {sup('g3', 'JG_Gewicht_totaal')} AS JG_Gewicht_3_perc, {sup('g4', 'JG_Gewicht_totaal')} AS JG_Gewicht_4_perc,
       {sup('g1 + g2', 'JG_Overgewicht')} AS JG_Overgewicht_perc
FROM ({derived}) d"""
    return q


def oracles() -> dict[str, str]:
    q = {}
    q.update({k: v for k, v in weight_oracles().items() if not k.endswith("_raw")})
    q.update(survey_oracles())
    q.update(other_oracles())
    return {k: _round_to_floor(v.replace("WHERE TRUE", GAPS) if k in GAPPED else v) for k, v in q.items()}
