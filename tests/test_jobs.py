"""The four jobs end to end on sf0.001: every bundle is written and readable."""

from areacube.plans import jobs
from areacube.plans.fixture_inputs import fixture_inputs, stage_fixtures
from areacube.sinks.cube import read_cube
from conftest import SF_SMALL


def test_jobs_write_bundles(spark, tmp_path):
    for name, job in jobs.JOBS.items():
        job(spark, fixture_inputs(spark, SF_SMALL, name), str(tmp_path / name))
    w = read_cube(spark, str(tmp_path / "weight" / "voortschrijdend_gemeente"),
                  ("Data", "Data_def", "Label_var", "Dimensies", "Indicators", "JG_Geslacht"))
    assert w["Data"].count() > 0 and w["JG_Geslacht"].count() == 3
    formulas = {r["Indicator code"]: r["Formula"] for r in w["Indicators"].collect()}
    assert formulas["JG_Overgewicht_perc"] == "((JG_Gewicht_1+JG_Gewicht_2)/(JG_Gewicht_1+JG_Gewicht_2+JG_Gewicht_3+JG_Gewicht_4))*100"
    for v in ("vo_ind_a", "vo_ind_b", "vo_ind_c"):
        s = read_cube(spark, str(tmp_path / "significance"), cube=f"kubus_{v}")
        named = {r["col"] for r in s["Data_def"].collect()}
        assert set(s["Data"].columns) == named == {"Jaar", "geolevel", "geoitem", f"{v}_pgroep"}
        assert s["Data"].count() > 0 and [r["Onderwerpcode"] for r in s["Label_var"].collect()] == [f"{v}_pgroep"]
    v = read_cube(spark, str(tmp_path / "vaccination" / "vaccinatiegraad"), ["Data"])["Data"]
    assert set(r.geolevel for r in v.select("geolevel").distinct().collect()) == {"gemeente", "ggd", "nederland"}
    r = spark.read.parquet(str(tmp_path / "relabel" / "portal-monitor"))
    assert r.columns[0].startswith("VO_")
    assert spark.read.parquet(str(tmp_path / "weight" / "tabel" / "per_gemeente")).count() > 0
    checks = spark.read.parquet(str(tmp_path / "weight" / "controle" / "klassen"))
    assert {r.grain for r in checks.select("grain").distinct().collect()} == {f"g{i}" for i in range(5, 14)}
    assert spark.read.parquet(str(tmp_path / "weight" / "controle" / "overgewicht")).count() > 0


def test_jobs_on_staged_inputs_give_the_same_cubes(spark, tmp_path):
    pairs = {"weight": ("absoluut", None), "significance": ("", "kubus_vo_ind_b"), "vaccination": ("vaccinatiegraad", None), "relabel": ("portal-monitor", None)}
    for name, (bundle, cube) in pairs.items():
        stage_fixtures(spark, SF_SMALL, str(tmp_path / "in" / name), name)
        jobs.JOBS[name](spark, jobs.staged_inputs(spark, str(tmp_path / "in" / name), name), str(tmp_path / "staged" / name))
        jobs.JOBS[name](spark, fixture_inputs(spark, SF_SMALL, name), str(tmp_path / "direct" / name))
        at = [str(tmp_path / kind / name / bundle) for kind in ("staged", "direct")]
        a, b = (spark.read.parquet(p) if name == "relabel" else read_cube(spark, p, ["Data"], cube=cube)["Data"] for p in at)
        assert sorted(map(str, a.select(sorted(a.columns)).collect())) == sorted(map(str, b.select(sorted(b.columns)).collect()))
