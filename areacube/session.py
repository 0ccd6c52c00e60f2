"""Session construction and lineage cutting.

Everything here is plain Spark configuration.  Cluster settings (shuffle
partitions, checkpoint folder) are read from the session when present and
only filled in when unset, as in tests and local runs.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


# Defaults for a cluster session, applied only where the submitted
# configuration sets nothing.  The big shuffles here are partial aggregates,
# so their output is cell-sized; the initial partition count is high and AQE
# coalesces it to the advisory size at run time.
CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "areacube",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A session for the jobs.

    ``master`` given (local runs, tests, the benchmark): small shuffle
    partition count, UI off.  ``master`` None (a cluster): the submitted
    configuration wins and ``CLUSTER_DEFAULTS`` only fill what is unset.
    Context-level settings cannot change after start-up; a cluster should
    submit ``spark.cleaner.referenceTracking.cleanCheckpoints=true`` so the
    checkpointed cell tables are removed when no longer referenced.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        cpus = os.environ.get("BENCH_CPUS")
        parts = shuffle_partitions or int(cpus or 8)
        builder = builder.master(master)
        local = {**CLUSTER_DEFAULTS,
                 "spark.sql.shuffle.partitions": str(parts),
                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
                 "spark.sql.files.maxPartitionBytes": "128m",
                 "spark.ui.enabled": "false",
                 "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
                 "spark.ui.showConsoleProgress": "false",
                 "spark.driver.memory": os.environ.get("AREACUBE_DRIVER_MEMORY", "8g")}
        for k, v in local.items():
            builder = builder.config(k, v)
        spark = builder.getOrCreate()
    else:
        spark = builder.getOrCreate()
        submitted = spark.sparkContext.getConf()
        for k, v in CLUSTER_DEFAULTS.items():
            if not submitted.contains(k):
                spark.conf.set(k, v)
        if shuffle_partitions:
            spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only when unset.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that value is
    always used.  Only a local/test session without it gets a fresh folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a shared folder on a cluster")
        conf = tempfile.mkdtemp(prefix="areacube-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder.

    Used for cell tables that feed several outputs: the expensive scan and
    shuffle over the microdata runs once, and a lost executor re-reads the
    checkpoint files instead of recomputing the scan.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
