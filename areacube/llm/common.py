"""Helpers shared by the operators: reads, scratch tables, Arrow slices."""

from __future__ import annotations

import contextlib
import ctypes
import sys
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areacube.session import ensure_checkpoint_dir

#: Bytes of text that one numpy step handles at a time.
SLICE_BYTES = 1 << 20
#: Bytes of one Arrow batch on its way to Python, and the setting of Spark that stands for none chosen.
BATCH_BYTES = 4 << 20
DEFAULT_BATCH_BYTES = "67108864b"


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The given columns of one input table (all without names)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``;
    where that is unset, a local session gets one and a cluster stops."""
    return (spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)).rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


class Scratch:
    """Intermediate Parquet tables of one operator call, in the shared folder.

    Writing one cuts the lineage, so a lost executor costs a re-read and not a
    re-run.  A table written under a name again replaces the one before; all
    but the result go when the result is written.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base = spark, new_path(spark, name)
        self.paths: dict[str, str] = {}
        self.number = 0

    def written(self, df: DataFrame, name: str) -> DataFrame:
        self.number += 1
        path = f"{self.base}/{name}-{self.number}"
        df.write.parquet(path)
        self.drop(name)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            if name in self.paths:
                path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def result(self, df: DataFrame) -> DataFrame:
        out = self.written(df, "result")
        self.drop(*[n for n in self.paths if n != "result"])
        return out


def short_batches(df: DataFrame) -> DataFrame:
    """Texts are long: Arrow batches of 1,000 rows instead of Spark's default of 10,000 (another setting is kept), and of few bytes."""
    conf, key, size = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(key) == "10000":
        conf.set(key, "1000")
    if conf.get(size) == DEFAULT_BATCH_BYTES:
        conf.set(size, str(BATCH_BYTES))
    return df


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def total_bytes(docs: DataFrame, column: str) -> int:
    """Bytes of all texts of a column: one aggregate, one number."""
    return docs.agg(F.sum(F.octet_length(column))).first()[0] or 0


def blocks_for(spark: SparkSession, size: int, each: int) -> int:
    """So many blocks that one holds about ``each`` bytes, and every core has some."""
    return max(-(-size // each), min(partitions(spark), 64), 1)


def give_back() -> None:
    """Free memory that the allocators of a Python worker keep goes back to the machine."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        with contextlib.suppress(AttributeError):              # only glibc has it
            ctypes.CDLL(None).malloc_trim(0)


def worker_state(key: str, make, large: str | None = None):
    """What a Python worker keeps from task to task (tables, tokenizers, caches), by key.

    Workers outlive a stage, so large state (of the named owner) goes as soon as
    the worker is asked for any state that is not that owner's; free memory goes
    then too, and when an owner comes."""
    name = "_areacube_llm_worker"
    store = sys.modules.setdefault(name, types.ModuleType(name)).__dict__
    kept = store.setdefault("large", {})
    if large not in kept and (kept or large is not None):
        kept.clear()
        give_back()
    if large is not None:
        store = kept.setdefault(large, {})
    if key not in store:
        store[key] = make()
    return store[key]


def as_strings(column) -> pa.Array:
    """One string array without nulls (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0) if column.num_chunks else pa.array([], pa.string())
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    return pc.fill_null(column, "") if column.null_count else column


def as_bytes(column) -> list[bytes]:
    """The UTF-8 bytes of every text (null: empty)."""
    return as_strings(column).cast(pa.binary()).to_pylist()


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array, and where each text starts (one offset more than texts)."""
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0]: at[-1]], at - at[0]


def slices(batch, column: str, limit: int = SLICE_BYTES) -> Iterator:
    """Row ranges of a batch (or table) whose texts hold about ``limit`` bytes; a longer text comes alone and whole."""
    n = batch.num_rows
    if not n:
        return
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < n:
        done = sizes[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(sizes, done + limit, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def gathered(batches: Iterator, limit: int) -> Iterator:
    """Record batches of up to ``limit`` bytes out of smaller ones; a larger one comes alone."""
    held, size = [], 0
    for batch in batches:
        if held and size + batch.nbytes > limit:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.concat_batches(held)


def lists_of(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A list array with ``counts[i]`` of the values in row i."""
    at = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=at[1:])
    return pa.ListArray.from_arrays(pa.array(at), pa.array(values))
