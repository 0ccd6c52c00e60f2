"""A corpus pipeline of five stages over ``documents``: language ID, n-gram
Jaccard join, substring removal, secret redaction, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes it as Parquet in the shared folder and hands the table to the next
one.  All but the last return the columns of ``documents``.

Odd rows.  Null texts, empty texts and texts without a letter are rejected by
the language stage; it keeps rows with a null id, lang or source.  Rows with a null id cannot be
named as copies and stay; of rows with one id and one set of shingles, one stays;
rows of one id with different sets are judged each by its own set.
A text that loses all its words stays as an empty one (its end token is packed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areacube.llm import language_id, packing, secret_scan, shingle_join, substring_dedup
from areacube.llm.common import new_path


def recognised_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the others go."""
    return language_id.accepted(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of every group linked by 4-word shingles at 0.85."""
    named = shingle_join.link_components(docs, by_text=True).where("doc_id = component_id")
    of_set = F.struct("node", F.when(F.col("node").isNull(), F.col("text_hash")))       # a text without shingles is its own
    least = named.groupBy("doc_id", of_set.alias("set")).agg(F.min("text_hash").alias("text_hash")).select("doc_id", "text_hash")
    key = ["doc_id", "text_hash"]
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", shingle_join.text_hash()).join(least, key, "left_semi")
    kept = rows.groupBy(*key).agg(F.min("row").alias("row")).select("row.*")             # equal texts: the least row
    return kept.unionByName(docs.where("doc_id is null"))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 35-word windows that occur elsewhere too."""
    cleaned = substring_dedup.remove_repeats(docs, carry=[c for c in docs.columns if c not in ("doc_id", "text")])
    new = {"doc_id": F.col("doc_id"), "text": F.col("cleaned")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("cleaned").cast(docs.schema["n_chars"].dataType)
    return cleaned.select(*[new.get(c, F.col("carried")[c]).alias(c) for c in docs.columns])


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with their secrets masked."""
    return secret_scan.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return packing.digest(packing.pack(docs))


STAGES = [
    ("language_id", recognised_language),
    ("shingle_join", one_of_near_copies),
    ("substring_dedup", without_repeats),
    ("secret_scan", without_secrets),
    ("packing", packed),
]

#: Learned stages cannot be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = new_path(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
