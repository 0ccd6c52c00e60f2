"""SRC1-SRC5, SNK1-SNK4, MET1-MET5: write and read back."""

import pytest
from pyspark.sql import functions as F

from areacube.operators.relabel import field_labels, with_labels
from areacube.plans.relabel import relabel
from areacube.sinks.cube import CubeSpec, Indicator, read_cube, write_cube, write_relabelled
from areacube.sources.labelled import (read_indicator_list, read_labelled, user_missing_codes,
                                       variable_dictionary, with_user_missing, write_labelled)
from areacube.sources.fixtures import value_dictionary


def test_labelled_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 9), (2, 1)], "geslacht int, roken int")
    df = with_user_missing(with_labels(df, {"roken": "Rookt (opgeschoond)"}), {"roken": [9]})
    write_labelled(df, value_dictionary(spark), str(tmp_path / "ds"))
    data, dictionary = read_labelled(spark, str(tmp_path / "ds"), user_na=True)
    assert user_missing_codes(data) == {"roken": [9]}
    assert [r.roken for r in data.orderBy("geslacht").collect()] == [None, 1]
    assert dictionary.count() == 11
    assert dict((r.variable, r.label) for r in variable_dictionary(data).collect())["roken"] == "Rookt (opgeschoond)"


def test_indicator_list_csv(spark, tmp_path):
    p = tmp_path / "ind.csv"
    p.write_text("Code,Richting\nIND_A,Hoger = gunstig\n")
    assert [tuple(r) for r in read_indicator_list(spark, str(p)).collect()] == [("IND_A", "Hoger = gunstig")]


def test_cube_bundle(spark, tmp_path):
    data = spark.createDataFrame([(2020, "gemeente", 3, 1, 2.5)], "Jaar int, geolevel string, geoitem int, D int, V double")
    items = spark.createDataFrame([(1, "Man", 1)], "Itemcode int, Naam string, Volgnr int")
    spec = CubeSpec(dims=[("D", "Dim")], variables=[("V", "Aantal", "Personen")],
                    indicators=[Indicator("V", "Aantal", "personen"),
                                Indicator("V_perc", "Percentage", "percentage", "V/V*100", "Percentage", 1, 50, "V")],
                    source="test", dim_items={"D": items})
    write_cube(spec, data, str(tmp_path / "cube"))
    write_cube(spec, data, str(tmp_path / "cube"))          # rerun replaces
    t = read_cube(spark, str(tmp_path / "cube"), ("Data", "Data_def", "Label_var", "Dimensies", "Indicators", "D"))
    assert t["Data"].count() == 1
    assert [tuple(r) for r in t["Data_def"].collect()] == [("Jaar", "period"), ("geolevel", "geolevel"),
                                                           ("geoitem", "geoitem"), ("D", "dim"), ("V", "var")]
    ind = t["Indicators"].where(F.col("Indicator code") == "V_perc").first()
    assert ind["Threshold value"] == 50.0 and ind["Formula"] == "V/V*100"


def test_partitioned_cube(spark, tmp_path):
    data = spark.createDataFrame([(2020, "a", 1), (2020, "b", 2)], "Jaar int, var string, pgroep int")
    write_cube(CubeSpec(), data, str(tmp_path / "c"), partition_by=["var"])
    assert sorted(p.name for p in (tmp_path / "c").glob("v*/Data/var=*")) == ["var=a", "var=b"]


def test_a_stopped_write_leaves_the_old_bundle(spark, tmp_path, monkeypatch):
    from areacube.sinks import cube as C
    path = str(tmp_path / "c")
    def data(n):
        return spark.range(n).select(F.col("id").cast("int").alias("Jaar"))
    with pytest.raises(FileNotFoundError):
        read_cube(spark, path)
    write_cube(CubeSpec(), data(1), path)
    with monkeypatch.context() as m:
        m.setattr(C, "indicators", lambda *_: 1 / 0)                  # stops after Data is written
        with pytest.raises(ZeroDivisionError):
            write_cube(CubeSpec(), data(2), path)
    with monkeypatch.context() as m:
        m.setattr(C.BundleVersion, "commit", lambda *_, **__: 1 / 0)  # stops before the manifest
        with pytest.raises(ZeroDivisionError):
            write_cube(CubeSpec(), data(3), path)
    assert read_cube(spark, path)["Data"].count() == 1
    for n in (4, 5, 6):
        write_cube(CubeSpec(), data(n), path)
        assert read_cube(spark, path)["Data"].count() == n
    assert sorted(p.name for p in (tmp_path / "c").glob("v*")) == ["v00000003", "v00000004"]


def test_indicator_cubes_take_a_fixed_number_of_jobs(spark, tmp_path):
    from areacube.sinks.cube import IndicatorCube, write_indicator_cubes

    def jobs_of(n):
        cubes = [IndicatorCube(f"k{i}", f"v{i}", {"pgroep": f"v{i}_pgroep"}, CubeSpec(variables=[(f"v{i}_pgroep", "x", "Geen")])) for i in range(n)]
        data = spark.range(4 * n).select(F.lit(2024).alias("Jaar"), F.concat(F.lit("v"), (F.col("id") % n).cast("string")).alias("var"), F.col("id").cast("int").alias("pgroep"))
        spark.sparkContext.setJobGroup(f"cubes-{n}", "")
        write_indicator_cubes(cubes, data, str(tmp_path / f"c{n}"))
        spark.sparkContext.setJobGroup("", "")
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"cubes-{n}"))
    assert jobs_of(2) == jobs_of(12)
    one = read_cube(spark, str(tmp_path / "c12"), cube="k7")
    assert one["Data"].columns == ["Jaar", "v7_pgroep"] and sorted(r[1] for r in one["Data"].collect()) == [7, 19, 31, 43]
    assert [r["Onderwerpcode"] for r in one["Label_var"].collect()] == ["v7_pgroep"] and "var#" in one["Data"]._jdf.queryExecution().toString()


def test_relabel_job(spark, tmp_path):
    df = spark.createDataFrame([(5, 3, "01")], "NOG_Wijk2020 int, Gemeentecode int, Wijkcode string")
    df = with_labels(df, {"Wijkcode": "Wijk opgeschoond"})
    out = relabel(df, "VO")
    assert out.columns == ["VO_NOG_Wijk2020", "VO_Gemeentecode", "VO_Wijkcode", "VO_Wijkcode_volledig"]
    path = write_relabelled(out, str(tmp_path), "monitor")
    back = spark.read.parquet(path)
    assert tuple(back.first()) == ("000005", 3, "01", "000301")
    assert field_labels(back)["VO_Wijkcode"] == "Wijk"


def test_relabel_files(spark, tmp_path):
    from areacube.plans.relabel import relabel_files
    folder = tmp_path / "Kindermonitor"
    df = spark.createDataFrame([(5,)], "NOG_Wijk2020 int")
    write_labelled(df, None, str(folder / "wave1"))
    out = relabel_files(spark, [str(folder / "wave1")])
    back = spark.read.parquet(out[0])
    assert back.columns == ["KM_NOG_Wijk2020"] and back.first()[0] == "000005"


def test_nan_to_null(spark):
    from areacube.functions.scalars import nan_to_null
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert [r.x for r in df.select(nan_to_null(F.col("x")).alias("x")).collect()] == [None, 1.0]
