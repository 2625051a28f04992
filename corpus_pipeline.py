"""From raw documents to packed training sequences: five stages, each written and reread."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm.jaccard import similar_documents
from pairloom.llm.lines import dedup_lines
from pairloom.llm.mixing import mix_sources
from pairloom.llm.packing import pack_documents
from pairloom.llm.quality import graded
from pairloom.llm.tables import Scratch, mark_table, with_mark
from pairloom.llm.tokens import tokenizer_file


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the highest grade is large enough.

    Null or empty texts are graded like any other. The model is fitted on the rated
    documents of sf_dir; without ratings every document stays.
    """
    return graded(spark, docs, sf_dir).where("keep").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that came before, n_chars renewed; what lost all its text goes.

    A document that lost no line stays as it is, also without text.
    """
    lost = F.col("n_lines_removed") > 0
    left = dedup_lines(docs).where(~(lost & (F.length(F.trim(F.translate("text", "\t\n\r", "   "))) == 0)))
    chars = F.when(lost, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", chars).select(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest doc_id.

    Rows of one doc_id are one document, of which one row stays. Rows without doc_id stay.
    """
    scratch = Scratch(spark)
    similar = similar_documents(docs, size=5, percent=80).where("doc_id IS NOT NULL")
    judged = similar.groupBy(F.col("doc_id").alias("id")).agg(
        F.min(F.col("component_id") != F.col("doc_id")).alias("goes"), F.count("*").alias("times")
    )
    judged = scratch.put(judged.where("goes OR times > 1"), "judged")
    rows = with_mark(docs, mark_table(judged, "id", hashed=True), F.xxhash64("doc_id"))
    others = rows.where("NOT __hit OR doc_id IS NULL").select(*docs.columns)
    marked = rows.where("__hit AND doc_id IS NOT NULL").join(judged, F.col("doc_id") == F.col("id"), "left")
    stays = marked.where("coalesce(NOT goes, true)").dropDuplicates(["doc_id"]).select(*docs.columns)
    return others.unionByName(stays)


def length_weight() -> Column:
    """Sampling weight by length: half for very short and very long texts."""
    chars = F.coalesce(F.length("text"), F.lit(0))
    return F.when(chars.between(200, 50_000), 2.0).otherwise(1.0)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    mixed = mix_sources(docs, quality=length_weight())
    times = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return mixed.where("copies > 0").withColumn("__time", times).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 2048 ids."""
    packed = pack_documents(docs, tokenizer_file())
    return packed.placed(F.col("id").alias("doc_id"), "piece", "start", F.crc32("ids").alias("ids_crc32"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("mixing sources to target weights", source_mixing),
    ("best-fit packing", best_fit_packing),
]

# A fitted model, edit distances, components and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.put(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
