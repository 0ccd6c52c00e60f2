"""Cube bundles: the data table plus its metadata tables (SNK1-SNK4, MET1-MET5).

A bundle is a folder with one Parquet dataset per table (``Data``,
``Data_def``, one per dimension, ``Label_var``, ``Dimensies``,
``Indicators``) in a version folder; a manifest written last makes the version the
current one, so a rerun replaces the whole bundle or nothing.  The data table is written by the
executors in parallel; the metadata tables are built from the spec (a few
rows each).  ``partition_by`` gives one sub-folder per municipality, and
``write_indicator_cubes`` all indicators' cubes, from a single job (the reference writes one workbook each).
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areacube.operators.derive import Derived
from areacube.plans.portal import RELABELLED_PREFIX

#: Folder of a bundle's manifests, one file per complete version.
MANIFESTS = "_manifests"


@dataclass(frozen=True)
class Indicator:
    code: str
    name: str
    unit: str
    formula: str | None = None
    data_type: str = "Numeric"
    visible: int = 0
    threshold_value: float | None = None
    threshold_indicator: str | None = None


@dataclass(frozen=True)
class CubeSpec:
    period: str = "Jaar"
    geolevel: str = "geolevel"
    geoitem: str = "geoitem"
    dims: Sequence[tuple[str, str]] = ()             # (Dimensiecode, Naam)
    variables: Sequence[tuple[str, str, str]] = ()   # (Onderwerpcode, Naam, Eenheid)
    indicators: Sequence[Indicator] = ()
    cube: int = 1
    source: str = ""
    dim_items: Mapping[str, DataFrame] = field(default_factory=dict)  # Itemcode, Naam, Volgnr


LABEL_SCHEMA = "Onderwerpcode string, Naam string, Eenheid string"
DIMENSION_SCHEMA = "Dimensiecode string, Naam string"


def data_def_rows(spec: CubeSpec) -> list[tuple]:
    rows = [(spec.period, "period"), (spec.geolevel, "geolevel"), (spec.geoitem, "geoitem")]
    return rows + [(c, "dim") for c, _ in spec.dims] + [(c, "var") for c, _, _ in spec.variables]


def label_rows(spec: CubeSpec) -> list[tuple]:
    return list(spec.variables)


def dimension_rows(spec: CubeSpec) -> list[tuple]:
    return list(spec.dims)


def indicator_rows(spec: CubeSpec) -> list[tuple]:
    return [(i.code, i.name, i.unit, None, i.formula, i.data_type, i.visible,
             None if i.threshold_value is None else float(i.threshold_value), i.threshold_indicator,
             spec.cube, spec.source) for i in spec.indicators]


def data_def(spec: CubeSpec, spark: SparkSession) -> DataFrame:
    """MET1: every cube column with its role."""
    return spark.createDataFrame(data_def_rows(spec), "col string, type string")


def label_var(spec: CubeSpec, spark: SparkSession) -> DataFrame:
    """MET3."""
    return spark.createDataFrame(label_rows(spec), LABEL_SCHEMA)


def dimensions(spec: CubeSpec, spark: SparkSession) -> DataFrame:
    """MET4."""
    return spark.createDataFrame(dimension_rows(spec), DIMENSION_SCHEMA)


INDICATOR_SCHEMA = T.StructType([
    T.StructField("Indicator code", T.StringType()), T.StructField("Name", T.StringType()),
    T.StructField("Unit", T.StringType()), T.StructField("Aggregation indicator", T.StringType()),
    T.StructField("Formula", T.StringType()), T.StructField("Data type", T.StringType()),
    T.StructField("Visible", T.IntegerType()), T.StructField("Threshold value", T.DoubleType()),
    T.StructField("Threshold Indicator", T.StringType()), T.StructField("Cube", T.IntegerType()),
    T.StructField("Source", T.StringType()),
])


def indicators(spec: CubeSpec, spark: SparkSession) -> DataFrame:
    """MET5."""
    return spark.createDataFrame(indicator_rows(spec), INDICATOR_SCHEMA)


def derived_indicator(d: Derived, name: str, unit: str, data_type: str, visible: int,
                      threshold_value: float | None = None, threshold_indicator: str | None = None) -> Indicator:
    """MET5/MET6: an indicator row whose formula text comes from the evaluated structure."""
    return Indicator(d.name, name, unit, d.formula(), data_type, visible, threshold_value, threshold_indicator)


# ---- versions of a bundle -------------------------------------------------

def _folder(spark: SparkSession, path: str):
    """The file system of a path, and the path, by Spark's own classes (any store that Spark writes to)."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _versions(spark: SparkSession, path: str) -> list[int]:
    """The complete versions below a bundle's folder, oldest first."""
    fs, at = _folder(spark, f"{path}/{MANIFESTS}")
    if not fs.exists(at):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(at)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


class BundleVersion:
    """One new version of a bundle: tables are written into a folder of its own,
    the manifest last.  Readers follow the newest manifest, so a job that stops
    between two tables leaves the earlier version as it was.  One writer at a
    time; the version before the newest stays for readers under way, older ones go."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.earlier = _versions(spark, self.path)
        self.number = (self.earlier[-1] if self.earlier else 0) + 1
        self.tables: dict[str, str] = {}

    def write(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        w = df.write.mode("overwrite")                      # what a stopped attempt may have left
        if partition_by:
            w = w.partitionBy(*partition_by)
        self.tables[name] = f"v{self.number:08d}/{name}"
        w.parquet(f"{self.path}/{self.tables[name]}")

    def commit(self, **more) -> None:
        text = json.dumps({"version": self.number, "tables": self.tables, **more}, indent=1)
        final = f"{self.path}/{MANIFESTS}/{self.number:08d}.json"
        fs, draft = _folder(self.spark, final + ".draft")
        out = fs.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        if not fs.rename(draft, _folder(self.spark, final)[1]):
            raise OSError(f"cannot publish {final}")
        for old in self.earlier[:-1]:
            for name in (f"{MANIFESTS}/{old:08d}.json", f"v{old:08d}"):
                fs.delete(_folder(self.spark, f"{self.path}/{name}")[1], True)


def bundle_manifest(spark: SparkSession, path: str) -> dict:
    """The newest complete version of a bundle."""
    path = path.rstrip("/")
    versions = _versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no complete bundle in {path}")
    rows = spark.read.text(f"{path}/{MANIFESTS}/{versions[-1]:08d}.json", wholetext=True).collect()       # one row
    return json.loads(rows[0][0])


def _metadata(spec: CubeSpec, spark: SparkSession) -> dict[str, DataFrame]:
    return {"Data_def": data_def(spec, spark), "Label_var": label_var(spec, spark),
            "Dimensies": dimensions(spec, spark), "Indicators": indicators(spec, spark)}


def write_cube(spec: CubeSpec, data: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """SNK1/SNK3: write the bundle as a new version, which replaces an earlier one when it is complete."""
    version = BundleVersion(data.sparkSession, path)
    version.write("Data", data, partition_by)
    for name, df in {**_metadata(spec, data.sparkSession), **spec.dim_items}.items():
        version.write(name, df.coalesce(1))
    version.commit()


@dataclass(frozen=True)
class IndicatorCube:
    """One of many cubes in a long table: its rows have ``value`` in the table's key
    column; ``columns`` gives stored columns the names that its metadata uses."""
    name: str
    value: str
    columns: Mapping[str, str]
    spec: CubeSpec


def write_indicator_cubes(cubes: Sequence[IndicatorCube], data: DataFrame, path: str, key: str = "var") -> None:
    """SNK2: the cubes of all indicators in one bundle: one write of the long table,
    partitioned by indicator, and one of each metadata table, with the cube's name as a
    column.  The manifest holds each cube's partition and column names, so the number
    of Spark jobs does not follow the number of indicators."""
    spark = data.sparkSession
    version = BundleVersion(spark, path)
    version.write("Data", data.repartition(key), [key])
    name = "cube_name"
    for table, schema, rows in (("Data_def", "col string, type string", data_def_rows), ("Label_var", LABEL_SCHEMA, label_rows),
                                ("Dimensies", DIMENSION_SCHEMA, dimension_rows), ("Indicators", INDICATOR_SCHEMA, indicator_rows)):
        fields = T._parse_datatype_string(schema).fields if isinstance(schema, str) else schema.fields
        stacked = [(c.name, *row) for c in cubes for row in rows(c.spec)]
        version.write(table, spark.createDataFrame(stacked, T.StructType([T.StructField(name, T.StringType()), *fields])).coalesce(1))
    version.commit(key=key, cubes={c.name: {"value": c.value, "columns": dict(c.columns)} for c in cubes})


def write_relabelled(df: DataFrame, folder: str, name: str, prefix: str = RELABELLED_PREFIX) -> str:
    """SNK4: the relabelled copy next to the input; labels stay in field metadata."""
    out = f"{folder.rstrip('/')}/{prefix}{name}"
    df.write.mode("overwrite").parquet(out)
    return out


def read_cube(spark: SparkSession, path: str, tables: Sequence[str] = ("Data", "Data_def", "Label_var",
                                                                        "Dimensies", "Indicators"), cube: str | None = None) -> dict:
    """Tables of a bundle's newest complete version; ``cube`` names one of ``write_indicator_cubes``."""
    manifest = bundle_manifest(spark, path)
    found = {t: spark.read.parquet(f"{path.rstrip('/')}/{manifest['tables'][t]}") for t in tables}
    if cube is None:
        return found
    own = manifest["cubes"][cube]
    shown = {t: df.where(F.col("cube_name") == cube).drop("cube_name") for t, df in found.items() if t != "Data"}
    if "Data" in found:
        rows = found["Data"].where(F.col(manifest["key"]) == own["value"])           # one partition is read
        shown["Data"] = rows.drop(manifest["key"]).withColumnsRenamed(own["columns"])
    return shown
