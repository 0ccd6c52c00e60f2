"""The queries of the training-data operators: ``opN_<name>(spark, sf_dir)``.

Each applies one operator, with its production parameters, to the whole of
its table and derives the digest columns of its result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, hard_negatives, html_text, kd_shards, language_id, packing, quality_rules, secret_scan, shingle_join
from . import token_files, vector_dedup
from . import substring_dedup as substring
from .common import read


def op1_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of one label at cosine 0.98 or more, by sorted projection passes."""
    return vector_dedup.near_duplicates(read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text, learned from the labelled rows that are not held out."""
    return language_id.identify(read(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 tokens, each filled with its seed's lexical neighbours."""
    return packing.digest(packing.pack(read(spark, sf_dir, "documents", "doc_id", "text")))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """35-word windows that repeat anywhere, removed from every text."""
    return substring.digest(substring.remove_repeats(read(spark, sf_dir, "documents", "doc_id", "text")))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every text, written as ORC in id order and read back."""
    return token_files.digest(token_files.written_and_read(read(spark, sf_dir, "documents", "doc_id", "text")))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, by minimum cut."""
    return html_text.extract(read(spark, sf_dir, "pages", "page_id", "url", "html"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text statistics, the base rule and a decision list learned from the quality labels."""
    return quality_rules.judged(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "labels", "doc_id", "quality"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate secrets of every whole text, judged by a random forest."""
    return secret_scan.findings(read(spark, sf_dir, "documents", "doc_id", "text"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded by ranks with a segment tree per piece, and decoded again."""
    return bpe.digest(bpe.encode_decode(read(spark, sf_dir, "documents", "doc_id", "text")))


def op10_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """4-word shingle sets with Jaccard similarity of 0.85 or more, and their components."""
    return shingle_join.link_components(read(spark, sf_dir, "documents", "doc_id", "text"))


def op11_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes, by a k-d tree over language, source and length."""
    return kd_shards.digest(kd_shards.kd_shards(read(spark, sf_dir, "documents", "doc_id", "text", *kd_shards.DIMS), shards=16))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two public vocabularies, aligned over every whole text, with the corpus counts of their links."""
    return alignment.alignment_digest(read(spark, sf_dir, "documents", "doc_id", "text"),
                                      public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of other labels scored between 0.8 and 1 times a positive's score; every seventh label is set wrong first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label").withColumn("label", label)
    return hard_negatives.hard_negatives(rows, anchor=F.col("vec_id") % 100 == 0)


QUERIES = {f.__name__: f for f in (
    op1_vector_dedup, op2_language_id, op3_packing, op4_substring_dedup, op5_token_files,
    op6_html_text, op7_quality_rules, op8_secret_scan, op9_byte_bpe, op10_shingle_join,
    op11_kd_shards, op12_token_alignment, op13_hard_negatives,
)}

ORACLE_SQL: dict[str, str] = {
    "op13_hard_negatives": """
        with v as (
            select vec_id, cast(case when vec_id % 7 = 0 then (label + 1) % 10 else label end as varchar) as label,
                   list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e
            from embeddings
            where vec_id is not null and label is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (
            select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same, cast(list_dot_product(a.e, r.e) as bigint) as score
            from v a join v r on a.vec_id % 100 = 0 and a.vec_id <> r.vec_id and len(a.e) = len(r.e)),
        p as (
            select anchor_id, vec_id as positive_id, score as positive_score from s where same
            qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
        select p.anchor_id, p.positive_id, s.vec_id as negative_id, p.positive_score, s.score as negative_score,
               cast(row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) as integer) as rank
        from p join s on p.anchor_id = s.anchor_id and not s.same
         and 80 * p.positive_score <= 100 * s.score and s.score <= p.positive_score
        qualify rank <= 5""",
}
