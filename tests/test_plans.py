"""Physical plans: shuffles per step, pushdown, pruning, no nested-loop joins."""

from areacube.plans import registry as R
from areacube.plans import vaccination as V
from areacube.plans import weight as W
from areacube.plans.explain import exchange_count, has_nested_loop_join, plan_text
from areacube.sources import fixtures as fx
from conftest import SF_SMALL


def test_microdata_is_shuffled_once(spark):
    cells = W.finest_cells(fx.weight_microdata(spark, SF_SMALL), checkpoint=False)
    assert exchange_count(cells) == 1
    text = plan_text(cells)
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string," in text


def test_grain_table_exchanges(spark):
    cells = R.weight_cells(spark, SF_SMALL)
    g2 = W.grain_table(cells, W.grains()["g2"], members=fx.region_members(spark, SF_SMALL))
    # the grain's partial sums + gap fill (shared by both windows) + area list
    assert exchange_count(g2) == 3
    assert not has_nested_loop_join(g2)


def test_survey_has_no_grid_join(spark):
    df = R.svy_rao_scott(spark, SF_SMALL)
    assert not has_nested_loop_join(df)


def test_resolve_codes_is_an_equi_join(spark):
    assert not has_nested_loop_join(R.resolve_columns_q(spark, SF_SMALL))


def test_resolve_codes_broadcasts_piece_lengths_only(spark):
    """Size estimates miss the rows that cutting adds: neither codes' nor names' pieces go through the driver."""
    plan = R.resolve_columns_q(spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("BroadcastHashJoin") == plan.count("BroadcastHashJoin [__size") and plan.count("SortMergeJoin [__size") >= 2


def test_region_keys_pushed_to_scan(spark, tmp_path):
    facts = fx.vaccination_facts(spark, SF_SMALL)
    facts.write.parquet(str(tmp_path / "facts"))
    f = spark.read.parquet(str(tmp_path / "facts"))
    text = plan_text(V.read_facts(f, literal_keys=["GG0001", "NL01  "]))
    assert "PushedFilters: [In(regios, [GG0001,NL01,NL01  ])]" in text


def test_survey_exchanges(spark):
    """The microdata is summed once and written; what follows are aggregates and joins of
    cells on keys finer than (wave, indicator), and no window gathers an indicator."""
    t = R.svy_rao_scott(spark, SF_SMALL)
    text = plan_text(t)
    assert exchange_count(t) == 11 and "Window" not in text and "lineitem" not in text and not has_nested_loop_join(t)


def test_one_indicator_with_all_rows_is_spread(spark):
    """One (wave, indicator) that owns every cell: its cells lie in many partitions of the widest join."""
    from pyspark.sql import functions as F

    from areacube.operators import survey as svy
    rows = spark.range(40_000).select((F.col("id") % 400).alias("g"), (F.col("id") % 97).alias("h"), F.lit(1.0).alias("w"),
                                      ((F.col("id") * 7919) % 13 % 2).cast("double").alias("y"))
    sums = svy.survey_sums(rows, ["y"], "g", "h", "w")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        where = sums.groupBy("var", "h", "g").count().groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set(key, before)
    assert len(where) == 8 and max(r["count"] for r in where) < 2 * sum(r["count"] for r in where) / 8
    assert svy.compare_with_rest(sums, "g", "h").count() == 400


def test_year_bounds_are_observed(spark):
    df = spark.createDataFrame([("a", 2001), ("b", 1999), (None, 2004), ("a", None)], "c string, y int")
    from areacube.operators.cells import year_bounds
    out = year_bounds(df, "c", "y")
    assert "Window" not in plan_text(out)
    assert sorted(map(tuple, out.collect()), key=str) == [("a", 1999, 2004), ("b", 1999, 2004), (None, 1999, 2004)]
    assert out.schema["jaar_min"].dataType.simpleString() == "int"
    assert year_bounds(df.limit(0), "c", "y").collect() == []


def test_vaccination_cube_scans_once(spark, tmp_path):
    facts = fx.vaccination_facts(spark, SF_SMALL)
    facts.write.parquet(str(tmp_path / "facts"))
    f = spark.read.parquet(str(tmp_path / "facts"))
    cube = V.vaccination_cube(f, fx.member_area_keys(spark, SF_SMALL), "GG0001", "NL01  ",
                              fx.vaccine_labels(spark, SF_SMALL, V.VACCINE_TYPES))
    assert plan_text(cube).count("/facts]") == 1 and not has_nested_loop_join(cube)


def test_literal_member_keys_reach_the_scan(spark, tmp_path):
    facts = fx.vaccination_facts(spark, SF_SMALL)
    facts.write.parquet(str(tmp_path / "facts"))
    f = spark.read.parquet(str(tmp_path / "facts"))
    labels = fx.vaccine_labels(spark, SF_SMALL, V.VACCINE_TYPES)
    by_list = V.vaccination_cube(f, ["GM0001", "GM0002"], "GG0001", "NL01  ", labels)
    assert "In(regios, [GG0001,GM0001,GM0002,NL01,NL01  ])" in plan_text(by_list)
    keys = spark.createDataFrame([("GM0001",), ("GM0002",)], "key string")
    by_table = V.vaccination_cube(f, keys, "GG0001", "NL01  ", labels)
    assert sorted(map(tuple, by_list.collect())) == sorted(map(tuple, by_table.collect()))


def test_survey_reads_the_microdata_once(spark):
    from areacube.operators.survey import survey_sums
    sums = survey_sums(R.survey_data(spark, SF_SMALL), R.ALL_INDICATORS, "Gemeentecode", "vo_stratum", "vo_weight", ["vo_wave"])
    assert plan_text(sums).count("lineitem.parquet]") == 1
    assert plan_text(R.svy_rao_scott(spark, SF_SMALL)).count("lineitem.parquet]") == 0        # reads the written sums


def test_partial_aggregation_before_raw_shuffles(spark):
    # a key holding a third of all rows is collapsed in each map task before the exchange
    cells = W.finest_cells(fx.weight_microdata(spark, SF_SMALL), checkpoint=False)
    assert "partial_count" in plan_text(cells)
    from areacube.operators.survey import survey_sums
    sums = survey_sums(R.survey_data(spark, SF_SMALL), R.ALL_INDICATORS, "Gemeentecode", "vo_stratum",
                       "vo_weight", ["vo_wave"])
    text = plan_text(sums)
    assert "partial_sum" in text and exchange_count(sums) == 1


def test_materialize_is_a_reliable_checkpoint(spark):
    from pathlib import Path
    from urllib.parse import urlparse

    from areacube.session import ensure_checkpoint_dir, materialize
    folder = Path(urlparse(ensure_checkpoint_dir(spark)).path)
    before = {p for p in folder.rglob("*") if p.is_file()}
    df = materialize(spark.range(100).selectExpr("id % 7 AS k").groupBy("k").count())
    assert "Scan ExistingRDD" in plan_text(df) and df.count() == 7
    assert {p for p in folder.rglob("*") if p.is_file()} - before


def test_cube_reuses_the_gap_fill_partitioning(spark):
    # partial sums, area list, gap fill, code list; the share and trailing-mean windows and the widen add none
    assert exchange_count(R.cube_municipality_q(spark, SF_SMALL)) == 4
    assert exchange_count(R.cube_district_q(spark, SF_SMALL)) == 4


def test_absolute_cube_is_one_plan(spark):
    # three levels from one level-tagged gap fill: partial sums, area list, gap fill, code list
    assert exchange_count(R.cube_absolute_levels(spark, SF_SMALL)) == 4


def test_cells_are_summed_before_the_gap_fill(spark):
    """A region-level grain sends partial sums to its tasks, not the cell table."""
    cells = R.weight_cells(spark, SF_SMALL)
    text = plan_text(W.grain_table(cells, W.grains()["g4"]), "simple").split("Subqueries")[0]
    below = text[text.index("Union"):]
    assert below.index("functions=[partial_sum(n") < below.index("Scan ExistingRDD")


def test_wave_filter_prunes_partitions(spark, tmp_path):
    from areacube.plans import significance as SG
    from areacube.sources.labelled import read_labelled, write_labelled
    write_labelled(fx.survey_microdata(spark, SF_SMALL), None, str(tmp_path / "survey"), partition_by=["vo_wave"])
    data, _ = read_labelled(spark, str(tmp_path / "survey"))
    one_wave = SG.prepared(data, R.DESIGN, wave_value=1996)
    text = plan_text(one_wave)
    assert "PartitionFilters: [isnotnull(vo_wave" in text and "(vo_wave#" in text and "= 1996)" in text
    assert {r.vo_wave for r in one_wave.select("vo_wave").distinct().collect()} == {1996}
