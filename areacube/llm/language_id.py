"""Language identification by nearest centroids.

A text's vector holds the sublinear counts of its lower-case character
trigrams (non-letters are one space), hashed into ``DIMS`` places, weighted by
IDF and normalised.  Each language has ``CENTROIDS`` centroids, found by
spherical k-means on a bounded sample of labelled texts.  A text gets the
language of the centroid of highest cosine; it is rejected when that cosine is
below the language's limit, a fraction of what its own sample reaches, and
the text is long enough to tell.

Fit.  At most about ``SAMPLE`` texts per language (chosen by a hash of the id
among rows with a label that are not held out) are turned into vectors by Spark tasks;
every label is learned, each in its own task, and the driver holds the centroids only.  Prediction reads whole texts of all rows; nothing
but the text enters it.

Cases.  Null text or text without a letter: ``und``, score 0, rejected.  Text
of letters that no labelled text has: some learned language, low score,
rejected unless very short.  Without labelled rows every text is ``und`` and rejected.  Ties go
to the first language.  Null id: not held out, never learned from.  Repeated
ids and extra columns: each row is predicted by itself, others are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, as_strings, short_batches, slices, text_buffer, worker_state
from .words import U

DIMS = 4096
#: Labelled texts a language is learned from, about.
SAMPLE = 600
CENTROIDS = 3
#: A text is rejected below this fraction of the lowest cosine but one percent of the sample.
REJECT = 0.25
#: Texts of fewer trigrams are too short to be judged by their distance and are not rejected.
MIN_TRIGRAMS = 60
SEED = 11


def _letters() -> np.ndarray:
    table = np.full(256, 32, np.uint8)
    table[97:123] = np.arange(97, 123)
    table[128:] = np.arange(128, 256)
    return table


def trigram_counts(column) -> np.ndarray:
    """One row of ``DIMS`` counts per text."""
    texts = as_strings(column).to_pylist()
    buf, at = text_buffer(pa.array([f" {t.lower()} " for t in texts], pa.string()))
    b = worker_state("letters", _letters)[buf].astype(np.uint32)
    n = len(b) - 2
    code = b[:-2] << 16 | b[1:-1] << 8 | b[2:]
    row = np.repeat(np.arange(len(texts)), np.diff(at))[:n]
    inside = np.arange(n) + 2 < at[1:][row]
    blank = (b[1:-1] == 32) & ((b[:-2] == 32) | (b[2:] == 32))
    keep = inside & ~blank
    place = (code[keep].astype(U) * U(0x9E3779B97F4A7C15)) >> U(64 - DIMS.bit_length() + 1)
    return np.bincount(row[keep] * DIMS + place.astype(np.int64), minlength=len(texts) * DIMS).reshape(len(texts), DIMS)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts, dtype=np.float64) * idf
    norm = np.sqrt((x * x).sum(1))
    return x / np.where(norm, norm, 1)[:, None]


def _few(batches, rows: int = 256):
    for batch in batches:
        for part in slices(batch, "text"):
            for at in range(0, part.num_rows, rows):
                yield part.slice(at, rows)


def _sampled(batches):
    for part in _few(batches):
        counts = trigram_counts(part.column("text"))
        yield pa.RecordBatch.from_arrays([part.column("lang"), pa.array([np.minimum(c, 65535).astype("<u2").tobytes() for c in counts], pa.binary())], ["lang", "counts"])


def _centroids(x: np.ndarray, k: int, rng) -> np.ndarray:
    """Spherical k-means: unit centroids of unit rows."""
    first = x.mean(0)
    chosen = [int(np.argmax(x @ first))]
    while len(chosen) < min(k, len(x)):                     # far from those chosen
        far = 1 - (x @ x[chosen].T).max(1)
        far[chosen] = 0
        if far.sum() <= 1e-12:
            break
        chosen.append(int(rng.choice(len(x), p=np.maximum(far, 0) / np.maximum(far, 0).sum())))
    c = x[chosen]
    for _ in range(20):
        of = np.argmax(x @ c.T, 1)
        new = np.stack([x[of == j].sum(0) if (of == j).any() else c[j] for j in range(len(c))])
        new /= np.sqrt((new * new).sum(1))[:, None]
        if np.allclose(new, c):
            break
        c = new
    return c


def _texts_with(batches):
    """How many of a task's rows have each place."""
    total = np.zeros(DIMS, np.int64)
    for batch in batches:
        for raw in batch.column("counts"):
            total += np.frombuffer(raw.as_buffer(), "<u2") > 0
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMS, dtype=np.int32)), pa.array(total)], ["place", "texts"])


def _learned(idf: np.ndarray):
    """The rows of one language -> its centroids and least cosine."""
    def run(key, table):
        counts = np.stack([np.frombuffer(c, "<u2") for c in sorted(table.column("counts").to_pylist())])
        own = weighted(counts, idf)
        own = own[own.any(1)]
        c = _centroids(own, CENTROIDS, np.random.default_rng(SEED)) if len(own) else np.zeros((1, DIMS))
        least = REJECT * np.quantile((own @ c.T).max(1), 0.01) if len(own) else 1.0
        return pa.table({"lang": pa.array([key[0].as_py()], pa.string()), "centroids": pa.array([c.astype("<f8").tobytes()], pa.binary()),
                         "least": pa.array([least], pa.float64())})
    return run


class Model:
    """languages, idf, centroids (rows), language of each centroid, least cosine of each language."""

    def __init__(self, idf: np.ndarray, learned: list):
        learned = sorted(learned, key=lambda r: r["lang"])
        own = [np.frombuffer(r["centroids"], "<f8").reshape(-1, DIMS) for r in learned]
        self.idf, self.languages = idf, [r["lang"] for r in learned]
        self.centroids = np.concatenate(own) if own else np.zeros((0, DIMS))
        self.of, self.least = np.repeat(np.arange(len(own)), [len(c) for c in own]), np.array([r["least"] for r in learned])


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, may_learn: Column) -> Model:
    """Learns from rows of ``docs(doc_id, text, lang)`` with a label, a text and ``may_learn``."""
    known = short_batches(docs).where(may_learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    share = known.groupBy("lang").agg(F.greatest(F.lit(1), (F.least(F.lit(1.0), F.lit(SAMPLE) / F.count("*")) * 1_000_000).cast("long")).alias("share"))
    scratch = Scratch(docs.sparkSession, "language-id")
    rows = known.join(F.broadcast(share), "lang").where(place < F.col("share")).select("text", "lang")       # a number per language
    rows = scratch.written(rows.mapInArrow(_sampled, "lang string, counts binary"), "sample")
    texts = np.zeros(DIMS)
    for r in rows.mapInArrow(_texts_with, "place int, texts long").groupBy("place").agg(F.sum("texts").alias("texts")).collect():
        texts[r["place"]] = r["texts"]
    idf = np.log((1 + rows.count()) / (1 + texts)) + 1
    learned = rows.groupBy("lang").applyInArrow(_learned(idf), "lang string, centroids binary, least double").collect()
    scratch.drop("sample")
    return Model(idf, learned)


def _predicted(model: Model):
    def run(batches):
        for part in _few(batches):
            texts = as_strings(part.column("text")).to_pylist()
            lang, score, rejected = ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
            some = [i for i, t in enumerate(texts) if any(map(str.isalpha, t))]
            if some and len(model.centroids):
                counts = trigram_counts(pa.array([texts[i] for i in some], pa.string()))
                like = weighted(counts, model.idf) @ model.centroids.T
                best = np.argmax(like, 1)
                score[some] = np.clip(like[np.arange(len(some)), best], 0, 1)
                for i, k, n in zip(some, model.of[best].tolist(), counts.sum(1).tolist()):
                    lang[i] = model.languages[k]
                    rejected[i] = n >= MIN_TRIGRAMS and score[i] < model.least[k]
            others = [part.column(n) for n in part.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*others, pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)],
                                             [n for n in part.schema.names if n != "text"] + ["lang_pred", "score", "rejected"])
    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, rejected for every row of ``docs(doc_id, text)``."""
    return docs.select("doc_id", "text").mapInArrow(_predicted(model), "doc_id long, lang_pred string, score double, rejected boolean")


def identify(docs: DataFrame) -> DataFrame:
    """The contract's columns: learned from four fifths of the labelled rows, predicted for all."""
    model = fit(docs, ~held_out())
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is recognised, with all their columns."""
    model = fit(docs, ~held_out())
    kind = docs.select("text", *[c for c in docs.columns if c != "text"]).schema

    def run(batches):
        judge = _predicted(model)
        for part in _few(batches):
            rejected = next(judge(iter([part.select(["text"])]))).column("rejected")
            yield part.filter(pa.compute.invert(rejected))
    return docs.select(*kind.fieldNames()).mapInArrow(run, kind).select(*docs.columns)
