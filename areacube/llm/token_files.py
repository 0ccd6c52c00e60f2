"""Token ids in ORC files: one row per document, in id order.

The files use ORC's integer run-length encoding for ids and counts, row
indexes every ``STRIDE`` rows and Bloom filters on the document id; stripes
are read in parallel, and a lookup by id skips the stripes and row groups
whose statistics or Bloom filter rule it out.

Plan.  The text (smaller than its ids) is dealt by ranges of the id, sorted
inside each range, encoded there and written: one exchange.  A row carries
its file's number and the ids before it in that file, so readers place a
document without reading its neighbours; the offsets of the files are the
running sum of one number per file.

Cases.  Null or empty text: the end id only.  Repeated ids: one row each, in
order of their text.  Null ids come first.  Extra columns are ignored.  Empty
table: files without rows, read back as an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import blocks_for, gathered, lists_of, new_path, short_batches, slices, total_bytes
from .tokens import spaced_ids

SCHEMA = "doc_id long, file int, before long, n_tokens int, ids array<int>"
STRIDE = 2000
STRIPE_BYTES = 16 << 20
#: Bytes of text that one file holds, about.
FILE_BYTES = 16 << 20
END_ID = 0
#: Bytes of text that are encoded at a time: the more, the fewer look-ups of repeated units.
SLICE_BYTES = 8 << 20


def _encoded(path: str, end: int):
    def run(batches):
        ids_of = spaced_ids(path, np.array([end], "<u4").tobytes())
        file = TaskContext.get().partitionId()
        before = 0
        for batch in gathered(batches, SLICE_BYTES):
            for part in slices(batch, "text", SLICE_BYTES):
                rows = ids_of(part.column("text"))
                n = np.array([len(r) // 4 for r in rows], np.int64)
                total = before + np.cumsum(n)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(np.full(len(n), file, np.int32)), pa.array(total - n),
                    pa.array(n.astype(np.int32)), lists_of(np.frombuffer(b"".join(rows), "<i4"), n),
                ], ["doc_id", "file", "before", "n_tokens", "ids"])
                before = int(total[-1])
    return run


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end: int = END_ID) -> None:
    """Writes the ids of ``docs(doc_id, text)`` as ORC files below ``path``."""
    spark = short_batches(docs).sparkSession
    files = blocks_for(spark, total_bytes(docs, "text"), FILE_BYTES)
    (docs.select("doc_id", "text").repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(_encoded(vocabulary, end), SCHEMA)
     .write.option("compression", "zstd").option("orc.stripe.size", STRIPE_BYTES)
     .option("orc.row.index.stride", STRIDE).option("orc.create.index", "true")
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01").orc(path))


def read_tokens(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """The rows of ``write_tokens`` with ``start``, the ids of all documents before; ``where`` reaches the ORC reader."""
    rows = spark.read.schema(SCHEMA).orc(path)
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    order = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("file", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("offset"))
    if where is not None:
        rows = rows.where(where)
    return rows.join(F.broadcast(offsets), "file").select(          # one row per file
        "doc_id", (F.col("offset") + F.col("before")).alias("start"), "ids")


def _digests(batches):
    for batch in batches:
        ids = batch.column("ids")
        at = ids.offsets.to_numpy()
        data = ids.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), batch.column("start"), pa.array(np.diff(at).astype(np.int64)),
            pa.array([zlib.crc32(data[a:b]) for a, b in zip(at[:-1], at[1:])], pa.int64()),
        ], ["doc_id", "start", "n_tokens", "ids_crc32"])


def digest(rows: DataFrame) -> DataFrame:
    """The contract's columns from ``read_tokens``."""
    return rows.mapInArrow(_digests, "doc_id long, start long, n_tokens long, ids_crc32 long")


def written_and_read(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Files in the shared folder, and their rows."""
    path = new_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, vocabulary or public_tokenizers.path("byte_bpe_50k.json"))
    return read_tokens(docs.sparkSession, path)
