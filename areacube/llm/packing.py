"""Packing by lexical retrieval: documents that go together share a window.

Documents are dealt by a hash of their id into shards of about
``SHARD_BYTES`` of text.  Each shard has a BM25 inverted index over its
documents' token ids.  A seed document opens a sequence; its unused
neighbours, best first, fill the window; the one that does not fit is cut, and
its rest is the next seed.  Without neighbours the shard's next unused
document follows.  So every sequence of a shard is full but for the last
tokens, which go to sequences whose lengths are powers of two: those need no
padding, and nothing is padded at all.

Plan.  One exchange of the text; a shard is packed by one task and holds a
few MB however large the corpus is.  The shard is a hash, so a hot source is
spread evenly.  A shard's sequence numbers start at shard * 2**32.

Cases.  Null or empty text: the end id only.  A document longer than a window:
full windows of its own, then its rest is a seed.  Repeated ids: each row is
packed; rows of one id follow one another by their text.  Null ids: packed
like others.  Extra columns are ignored.  Empty table: empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks_for, short_batches, slices, total_bytes
from .tokens import word_ids

WINDOW = 4096
END_ID = 2
SHARD_BYTES = 2 << 20
#: Bytes of text whose different words are looked up at a time: mostly those of a whole shard.
LOOKUP_BYTES = 4 << 20
K1, B = 1.2, 0.75
#: Terms of a seed that are looked up: those of the highest weight.
QUERY_TERMS = 32


class Bm25:
    """An inverted index of one shard: per term its documents and their weights."""

    def __init__(self, docs: list[np.ndarray]):
        self.n = len(docs)
        size = np.array([len(d) for d in docs])
        pair, tf = np.unique(np.repeat(np.arange(self.n, dtype=np.int64), size) | np.concatenate(docs).astype(np.int64) << 32, return_counts=True)
        self.doc, term = pair & 0xFFFFFFFF, pair >> 32
        self.terms, self.at, df = np.unique(term, return_index=True, return_counts=True)
        self.at = np.append(self.at, len(pair))
        self.idf = np.log(1 + (self.n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * size / max(1.0, size.mean()))
        self.weight = np.repeat(self.idf, df) * tf * (K1 + 1) / (tf + norm[self.doc])
        order = np.lexsort((-self.weight, self.doc))           # each document's terms, best first
        have = np.bincount(self.doc, minlength=self.n)
        self.own = np.repeat(np.arange(len(df)), df)[order]
        self.own_at = np.concatenate(([0], np.cumsum(have)))

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents that share a query term with the seed, best first (ties: first document first)."""
        terms = self.own[self.own_at[seed]: self.own_at[seed + 1]][:QUERY_TERMS]
        lists = [slice(self.at[t], self.at[t + 1]) for t in terms.tolist()]
        if not lists:
            return np.zeros(0, np.int64)
        score = np.bincount(np.concatenate([self.doc[x] for x in lists]), np.concatenate([self.weight[x] for x in lists]), self.n)
        score[~unused] = 0
        found = np.flatnonzero(score)
        return found[np.argsort(-score[found], kind="stable")]


def powers(n: int) -> list[int]:
    """n as a sum of powers of two, largest first."""
    return [1 << i for i in range(n.bit_length() - 1, -1, -1) if n >> i & 1]


def fill(docs: list[np.ndarray], window: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) that hold every token once."""
    index = Bm25(docs) if docs else None
    unused = np.ones(len(docs), bool)
    pieces: list[tuple[int, int, int, int, int]] = []
    sequence, offset, next_unused = 0, 0, 0
    waiting: list[int] = []                    # neighbours of the open sequence's seed, best last

    def put(doc: int, start: int) -> int:
        nonlocal sequence, offset
        length = min(len(docs[doc]) - start, window - offset)
        pieces.append((doc, start, length, sequence, offset))
        offset += length
        if offset == window:
            sequence, offset = sequence + 1, 0
        return start + length

    while True:
        if offset == 0:
            waiting = []
        while waiting and not unused[waiting[-1]]:
            waiting.pop()
        if waiting:
            doc = waiting.pop()
        else:
            while next_unused < len(docs) and not unused[next_unused]:
                next_unused += 1
            if next_unused == len(docs):
                break
            doc = next_unused
        unused[doc] = False
        opened, start = offset == 0, 0
        while start < len(docs[doc]):
            opened |= offset == 0
            start = put(doc, start)
        if opened and offset:                  # the document (or its rest) is the seed of the open sequence
            waiting = index.neighbours(doc, unused)[::-1].tolist()
    return _last(pieces, sequence, offset, window)


def _last(pieces: list, sequence: int, filled: int, window: int) -> list:
    """The pieces of the open sequence cut into sequences whose lengths are powers of two."""
    if not filled:
        return pieces
    own = [p for p in pieces if p[3] == sequence]
    out = pieces[: len(pieces) - len(own)]
    for size in powers(filled):
        offset = 0
        while offset < size:
            doc, start, length, *_ = own.pop(0)
            take = min(length, size - offset)
            out.append((doc, start, take, sequence, offset))
            offset += take
            if take < length:
                own.insert(0, (doc, start + take, length - take, 0, 0))
        sequence += 1
    return out


PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _packed(path: str, window: int, end: int):
    def run(key, table):
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        ids_of = word_ids(path, np.array([end], "<u4").tobytes())
        raw = [ids for part in slices(table, "text", LOOKUP_BYTES) for ids in ids_of(part.column("text"))]
        pieces = fill([np.frombuffer(r, "<u4") for r in raw], window)
        doc, start, length, sequence, offset = np.array(pieces, np.int64).reshape(-1, 5).T
        size = np.array([len(r) // 4 for r in raw], np.int64)
        return pa.table({
            "doc_id": table.column("doc_id").take(pa.array(doc)), "start": pa.array(start), "length": pa.array(length),
            "ids": pa.array([raw[d][4 * a: 4 * (a + n)] for d, a, n, *_ in pieces], pa.binary()),
            "doc_tokens": pa.array(size[doc]), "sequence_id": pa.array(sequence + (key[0].as_py() << 32)), "offset": pa.array(offset),
        })
    return run


def pack(docs: DataFrame, vocabulary: str | None = None, window: int = WINDOW, end: int = END_ID) -> DataFrame:
    """One row per piece of ``docs(doc_id, text)``, with its ids (little-endian 32-bit)."""
    spark = short_batches(docs).sparkSession
    shards = blocks_for(spark, total_bytes(docs, "text"), SHARD_BYTES)
    path = vocabulary or public_tokenizers.path("word_bpe_49k.json")
    return (docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).alias("shard")).repartition(shards, "shard")
            .groupBy("shard").applyInArrow(_packed(path, window, end), PIECES))


def digest(pieces: DataFrame) -> DataFrame:
    """The contract's columns from ``pack``."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
