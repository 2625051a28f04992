"""Registered queries of this subpackage: thin views on the operators, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from .jaccard import similar_documents
from .langid import fit_languages
from .lexical import SEARCH_SQL, search
from .licences import document_licences, fit_licences
from .lines import dedup_lines
from .mixing import MIX_SQL, mix_sources
from .packing import pack_documents
from .phrases import PHRASE_SQL, collocations, count_phrases
from .quality import graded
from .substrings import remove_repeats
from .tokens import tokenizer_file
from .urls import URL_SQL, judge_urls
from .vectors import nearest_vectors, similar_vectors


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 token ids."""
    packed = pack_documents(_table(spark, sf_dir, "documents"), tokenizer_file())
    return packed.placed(
        F.col("id").alias("doc_id"), "piece", "start", F.crc32("ids").alias("ids_crc32")
    )


URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page by a short list of rules."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence that each document names, or unknown."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return document_licences(docs, fit_licences(docs))


def op4_quality_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probabilities of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return graded(spark, docs, sf_dir).select(
        "doc_id",
        "expected_grade",
        F.element_at("at_least", 1).alias("p_at_least_1"),
        F.element_at("at_least", 2).alias("p_at_least_2"),
        "keep",
    )


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked at a Jaccard similarity of 0.9 on 3-word shingles."""
    return similar_documents(_table(spark, sf_dir, "documents"), size=3, percent=90)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps when strings of 400 bytes that occur again go."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return remove_repeats(docs).select(
        "doc_id",
        n_bytes.alias("n_bytes"),
        gone.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings linked at a cosine of 0.95."""
    return similar_vectors(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document keeps when lines within two edits of an earlier one go."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes_kept"),
        F.col("n_lines_removed").cast("long").alias("n_lines_removed"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth embedding, against all rows."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest_vectors(vectors, vectors.where("vec_id % 20 = 0"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 phrases of each language whose parts belong together most."""
    return collocations(count_phrases(_table(spark, sf_dir, "documents").select("lang", "text"), least=30))


def op12_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents of highest score for each benchmark item."""
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    items = _table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text")
    return search(docs, items).withColumnsRenamed({"item": "item_id", "id": "doc_id"})


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those outside the held-out third."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", fold.alias("fold"))
    model = fit_languages(docs.where("fold <> 1").select(F.col("doc_id").alias("id"), "text", "lang"))
    held = docs.select("doc_id", F.coalesce(F.col("fold") == 1, F.lit(False)).alias("held_out"), "text")
    return model.predict(held, keep=["doc_id", "held_out"])


def rated_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampling weights of the labelled documents: good ones 2, others a half."""
    labels = _table(spark, sf_dir, "labels").where("quality IS NOT NULL")
    mean = labels.groupBy(F.col("doc_id").alias("id")).agg(F.avg("quality").alias("mean"))
    return mean.select("id", F.when(F.col("mean") >= 0.5, 2.0).otherwise(0.5).alias("weight"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document a mix of one and a half times all words takes."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mix_sources(docs, quality=rated_quality(spark, sf_dir), columns=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
    return own | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    own = {
        "op2_url_filters": URL_SQL,
        "op9_source_mixing": MIX_SQL,
        "op11_phrase_collocations": PHRASE_SQL,
        "op12_ranked_lexical_search": SEARCH_SQL,
    }
    return own | pipeline
