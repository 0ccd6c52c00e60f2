"""Substring removal: passages that occur more than once, anywhere.

Method.  A Rabin-Karp hash of every window of ``width`` words; the hashes are
counted by a shuffle on their leading bits; repeated windows go back to the
texts they are in and merge into maximal removal intervals.

Plan.  Texts are dealt once into blocks by a hash of the id (a few MB of text
each, so a hot source spreads evenly).  A block sends each hash bucket its
own *distinct* sorted hashes as one binary cell: a passage that a third of
all texts share costs a bucket one entry per block, not one per text.  A
bucket returns to each block only those of its hashes that another block has
too.  The block then marks its windows; repeats inside a block need no
shuffle.  The text exchange is used by both passes.

Cases.  Null or empty text: no words, nothing removed, cleaned text empty.
Fewer than ``width`` words: nothing removed.  Equal texts: each loses all its
words if it has a whole window (the contract removes every occurrence).
Rows with equal ids are treated as separate texts.  Other columns of the
input are ignored unless carried.  Empty table: empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from .common import as_strings, blocks_for, short_batches, slices, total_bytes
from .words import Words, covered

WIDTH = 35
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 12 << 20

SPAN = StructType().add("start", IntegerType()).add("end", IntegerType())
RESULT = (StructType().add("n_words", LongType()).add("n_removed", LongType()).add("removed", ArrayType(SPAN)).add("cleaned", StringType()))


def _block_windows(columns, width: int) -> np.ndarray:
    """All window hashes of a block's texts, in text order."""
    found = [w.windows(width, w.hashes())[2] for part in slices(columns, "text") for w in (Words(part.column("text")),)]
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _cells(width: int, buckets: int):
    def run(key, table):
        distinct = np.unique(_block_windows(table, width))
        of = (distinct >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)
        cut = np.searchsorted(of, np.arange(buckets + 1, dtype=np.uint64))
        full = np.flatnonzero(np.diff(cut))
        return pa.table({
            "bucket": pa.array(full.astype(np.int64)),
            "block": pa.array([key[0].as_py()] * len(full), pa.int64()),
            "hashes": pa.array([distinct[cut[b]: cut[b + 1]].tobytes() for b in full], pa.binary()),
        })
    return run


def _shared(key, table):
    """Of one bucket: for each block the hashes that another block has too."""
    cells = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("hashes")]
    every = np.sort(np.concatenate(cells))
    again = np.unique(every[1:][every[1:] == every[:-1]])
    back = []
    for c in cells:
        i = np.searchsorted(again, c)
        i[i == len(again)] = 0
        back.append(c[again[i] == c] if len(again) else c[:0])
    keep = [i for i, b in enumerate(back) if len(b)]
    return pa.table({
        "block": table.column("block").take(pa.array(keep, pa.int64())).combine_chunks() if keep else pa.array([], pa.int64()),
        "hashes": pa.array([back[i].tobytes() for i in keep], pa.binary()),
    })


def _without(w: Words, data: bytes, i: int, gone: np.ndarray) -> tuple[list, str]:
    """Removal intervals (word numbers of the text) and the text without them."""
    lo, hi = int(w.first[i]), int(w.first[i + 1])
    edges = np.flatnonzero(np.diff(np.concatenate(([0], gone[lo:hi].view(np.int8), [0]))))
    spans = edges.reshape(-1, 2)
    at, stop = int(w.at[i]), int(w.at[i + 1])
    kept = []
    for a, b in spans.tolist():
        kept.append(data[at: w.start[lo + a]])
        at = int(w.start[lo + b]) if lo + b < hi else int(w.end[hi - 1])
    kept.append(data[at:stop])
    return [{"start": a, "end": b} for a, b in spans.tolist()], b"".join(kept).decode("utf-8", "replace")


def _cleaned(width: int, carried: bool):
    def run(key, texts, found):
        far = np.unique(np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in found.column("hashes")])) if found.num_rows else np.zeros(0, np.uint64)
        parts = []
        for part in slices(texts, "text"):
            w = Words(part.column("text"))
            at, _, h = w.windows(width, w.hashes())
            parts.append((part, w, at, h))
        own = np.sort(np.concatenate([h for *_, h in parts] or [far[:0]]))
        again = np.union1d(far, own[1:][own[1:] == own[:-1]])
        out: dict[str, list] = {"n_words": [], "n_removed": [], "removed": [], "cleaned": []}
        for part, w, at, h in parts:
            i = np.searchsorted(again, h)
            i[i == len(again)] = 0
            gone = covered(at[again[i] == h] if len(again) else at[:0], width, len(w.start))
            total = np.concatenate(([0], np.cumsum(gone)))
            removed = total[w.first[1:]] - total[w.first[:-1]]
            column = as_strings(part.column("text"))
            data = w.buf.tobytes() if removed.any() else b""
            for k, text in enumerate(column.to_pylist()):
                spans, kept = _without(w, data, k, gone) if removed[k] else ([], text)
                out["removed"].append(spans)
                out["cleaned"].append(kept)
            out["n_words"] += w.counts().tolist()
            out["n_removed"] += removed.tolist()
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return pa.table({
            "doc_id": texts.column("doc_id"), **({"carried": texts.column("carried")} if carried else {}), "n_words": pa.array(out["n_words"], pa.int64()),
            "n_removed": pa.array(out["n_removed"], pa.int64()), "removed": pa.array(out["removed"], kind),
            "cleaned": pa.array(out["cleaned"], pa.string()),
        })
    return run


def remove_repeats(docs: DataFrame, width: int = WIDTH, carry: list[str] = ()) -> DataFrame:
    """doc_id, n_words, n_removed, removed (intervals of word numbers) and cleaned (the text
    without them) for every row of ``docs(doc_id, text)``; with ``carry`` also the struct
    ``carried`` of these columns."""
    spark = short_batches(docs).sparkSession
    size = total_bytes(docs, "text")
    blocks = blocks_for(spark, size, BLOCK_BYTES)
    buckets = blocks_for(spark, 2 * size, BUCKET_BYTES)      # about 8 bytes for each word of 5 or 6
    extra = [F.struct(*carry).alias("carried")] if carry else []
    texts = docs.select("doc_id", "text", *extra, F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).alias("block")).repartition(blocks, "block")
    cells = texts.groupBy("block").applyInArrow(_cells(width, buckets), "bucket long, block long, hashes binary")
    found = cells.groupBy("bucket").applyInArrow(_shared, "block long, hashes binary")
    result = StructType([f for f in texts.schema if f.name in ("doc_id", "carried")] + RESULT.fields)
    return texts.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(_cleaned(width, bool(carry)), result)


def digest(cleaned: DataFrame) -> DataFrame:
    """The contract's columns from ``remove_repeats``."""
    words = F.trim(F.regexp_replace("cleaned", r"[\x20\x09-\x0D]+", " "))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2(words, 256).alias("kept_sha256"), F.size("removed").alias("n_intervals"))
