"""Tables staged by key range, in order, and in batches (SRC3, SRT1, SRC6)."""

import pytest
from pyspark.sql import functions as F

from areacube.plans import vaccination as V
from areacube.plans.batch import DONE, FAILED, SKIPPED, BatchError, report, run_batch
from areacube.plans.explain import plan_text
from areacube.plans.relabel import relabel_batch, relabel_files
from areacube.sinks.ordered import write_ordered
from areacube.sources.keyed import of_keys, write_keyed
from areacube.sources.labelled import write_labelled
from conftest import rows


def _facts(spark, areas=40):
    """Areas GM0000, GM0100, ...: each in a range of its own; GM0000 holds a third of the rows; null and numeric keys too."""
    key = F.when(F.col("id") % 3 == 0, F.lit("GM0000")).otherwise(
        F.concat(F.lit("GM"), F.lpad((F.col("id") % areas).cast("string"), 2, "0"), F.lit("00")))
    known = spark.range(6000).select(key.alias("regios"), F.concat((F.col("id") % 7 + 2000).cast("string"), F.lit("JJ00")).alias("perioden"),
                                     F.col("id").alias("n"))
    odd = spark.createDataFrame([(None, "2000JJ00", -1), ("NL01  ", "2001JJ00", -2), ("", "2001JJ00", -3), ("0012", None, -4)],
                                "regios string, perioden string, n long")
    return known.unionByName(odd)


def _scan_metric(df, name):
    """A metric of the query's only fact scan, after it ran."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    scans = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        while "QueryStage" in leaf.getClass().getSimpleName():
            leaf = leaf.plan().collectLeaves().apply(0)
        if leaf.getClass().getSimpleName() == "FileSourceScanExec":
            scans.append(leaf)
    return [int(s.metrics().apply(name).value()) for s in scans]


def test_key_table_prunes_folders_at_run_time(spark, tmp_path):
    facts = _facts(spark)
    write_keyed(facts, str(tmp_path / "facts"), files=6)
    staged = spark.read.parquet(str(tmp_path / "facts"))
    spark.createDataFrame([(" GM0100",), ("GM0200",), ("GM0200",), ("NL01",), (None,), ("",)], "key string").write.parquet(str(tmp_path / "keys"))
    keys = spark.read.parquet(str(tmp_path / "keys"))
    found = of_keys(staged, keys)
    assert "dynamicpruningexpression" in plan_text(found).lower()
    got = [tuple(r) for r in found.collect()]
    want = [tuple(r) for r in facts.where(F.trim("regios").isin("GM0100", "GM0200", "NL01")).collect()]
    assert found.columns == facts.columns and sorted(got) == sorted(want) and got
    read = _scan_metric(found, "numPartitions")
    assert 3 in read, read                                          # three folders of 43
    # the same without staging, and with a list
    assert sorted(tuple(r) for r in of_keys(facts, keys).collect()) == sorted(want)
    by_list = of_keys(staged, ["GM0100", "GM0200", "NL01", ""])
    assert "PartitionFilters: [" in plan_text(by_list) and "k" + "GM01" in plan_text(by_list)
    assert sorted(tuple(r) for r in by_list.collect()) == sorted(want)


def test_keyed_staging_is_whole_and_spreads_a_hot_key(spark, tmp_path):
    facts = _facts(spark)
    write_keyed(facts, str(tmp_path / "facts"), files=6)
    staged = spark.read.parquet(str(tmp_path / "facts"))
    assert rows(staged.select(*facts.columns)) == rows(facts)
    hot = [p for p in (tmp_path / "facts" / "area_range=kGM00").iterdir() if p.suffix == ".parquet"]
    assert len(hot) > 1
    assert of_keys(staged, spark.createDataFrame([], "key string")).count() == 0
    assert of_keys(staged, spark.createDataFrame([("0012",)], "key string")).count() == 1


def test_numeric_ranges_stay_text(spark, tmp_path):
    df = spark.createDataFrame([("001200", "2000JJ00", 1), ("012000", "2000JJ00", 2)], "regios string, perioden string, n int")
    write_keyed(df, str(tmp_path / "f"))
    assert [r.n for r in of_keys(spark.read.parquet(str(tmp_path / "f")), ["001200"]).collect()] == [1]


def test_empty_facts(spark, tmp_path):
    empty = _facts(spark).limit(0)
    assert of_keys(empty, ["GM0100"]).count() == 0
    write_ordered(empty, str(tmp_path / "o"), ["perioden"])
    assert spark.read.schema(empty.schema).parquet(str(tmp_path / "o")).count() == 0


def test_vaccination_cube_of_staged_facts(spark, tmp_path):
    from areacube.sources import fixtures as fx
    from conftest import SF_SMALL
    facts = fx.vaccination_facts(spark, SF_SMALL)
    write_keyed(facts, str(tmp_path / "facts"))
    labels = fx.vaccine_labels(spark, SF_SMALL, V.VACCINE_TYPES)
    keys = fx.member_area_keys(spark, SF_SMALL)
    plain = V.vaccination_cube(facts, keys, "GG0001", "NL01  ", labels)
    staged = V.vaccination_cube(spark.read.parquet(str(tmp_path / "facts")), keys, "GG0001", "NL01  ", labels)
    assert staged.columns == plain.columns
    assert sorted(map(str, staged.collect())) == sorted(map(str, plain.collect()))
    assert "dynamicpruningexpression" in plan_text(staged).lower()


def test_ordered_files_let_a_reader_skip(spark, tmp_path):
    import pyarrow.parquet as pq
    df = spark.range(200_000).select((F.col("id") * 7919 % 11 + 2000).cast("int").alias("Jaar"), (F.col("id") % 300).alias("geoitem"),
                                     F.rand(1).alias("x"))
    write_ordered(df, str(tmp_path / "t"), ["Jaar", "geoitem"], files=8, group_bytes=64 << 10)
    names = sorted(p for p in (tmp_path / "t").iterdir() if p.suffix == ".parquet")
    spans, groups = [], 0
    for name in names:
        f = pq.ParquetFile(name)
        for g in range(f.metadata.num_row_groups):
            s = f.metadata.row_group(g).column(0).statistics
            spans.append((s.min, s.max))
            groups += 1
        years = f.read(["Jaar", "geoitem"]).to_pandas()
        assert years.equals(years.sort_values(["Jaar", "geoitem"], kind="stable"))
    assert spans == sorted(spans) and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))       # in order from file to file
    one = spark.read.parquet(str(tmp_path / "t")).where("Jaar = 2004")
    assert len(one.collect()) == df.where("Jaar = 2004").count()
    read = _scan_metric(one, "numOutputRows")[0]
    assert "EqualTo(Jaar,2004)" in plan_text(one) and groups > 11 and read < 100_000, (groups, read)


def test_hot_period_is_spread_over_files(spark, tmp_path):
    df = spark.range(50_000).select(F.when(F.col("id") % 3 < 2, 2001).otherwise(2002).alias("Jaar"), F.col("id").alias("x"))
    write_ordered(df, str(tmp_path / "t"), ["Jaar"], files=6)
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path / "t")).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 6 and max(sizes) < 2 * 50_000 / 6
    assert spark.read.parquet(str(tmp_path / "t")).count() == 50_000


def test_batch_goes_on_and_restarts(spark, tmp_path):
    folder = tmp_path / "Kindermonitor"
    for name in ("a", "b", "c"):
        write_labelled(spark.createDataFrame([(5,)], "NOG_Wijk2020 int"), None, str(folder / name))
    (folder / "bad" / "data").mkdir(parents=True)
    (folder / "bad" / "data" / "x.parquet").write_bytes(b"not a table")
    paths = [str(folder / n) for n in ("a", "bad", "b", "missing", "c", "a")]
    manifest = str(tmp_path / "manifest")
    first = relabel_batch(spark, paths, manifest=manifest)
    assert [e.status for e in first] == [DONE, FAILED, DONE, FAILED, DONE]
    assert all(spark.read.parquet(e.output).columns == ["KM_NOG_Wijk2020"] for e in first if e.status == DONE)
    assert all(e.error and e.output is None for e in first if e.status == FAILED)
    with pytest.raises(BatchError, match="2 of 5 datasets failed") as raised:
        relabel_files(spark, paths, manifest=manifest)
    assert [e.status for e in raised.value.entries] == [SKIPPED, FAILED, SKIPPED, FAILED, SKIPPED]
    write_labelled(spark.createDataFrame([(6,), (7,)], "NOG_Wijk2020 int"), None, str(folder / "b"))      # a changed source
    again = relabel_batch(spark, paths, manifest=manifest)
    assert [e.status for e in again] == [SKIPPED, FAILED, DONE, FAILED, SKIPPED]
    assert spark.read.parquet(again[2].output).count() == 2
    other = relabel_batch(spark, paths[:1], prefix="XX", manifest=manifest)                                # other parameters
    assert [e.status for e in other] == [DONE] and spark.read.parquet(other[0].output).columns == ["XX_NOG_Wijk2020"]
    assert [tuple(r)[:2] for r in report(spark, again).collect()][1] == (paths[1], FAILED)


def test_empty_batch(spark):
    assert run_batch(spark, [], lambda p: p) == [] and report(spark, []).count() == 0
