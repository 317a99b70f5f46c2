"""The registered queries: each operator over its whole table with production parameters, and the SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import (
    hard_negatives, language_id, mixing, ngram_join, pair_merges, prefix_trie, quality_model, quality_rules, segmentation, suffix_dedup, top_k, toxicity, warc,
)
from tradewind.llm.common import bucket_of_id, stored, table

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
WORD_VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted target: documents labelled 1 for quality. Raw corpus: all documents."""
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), trusted)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = bucket_of_id("doc_id", 3) == 1
    model = language_id.fit(docs.where(~held_out))
    return language_id.predict(docs, model, keep=["doc_id", held_out.alias("held_out")])


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = stored(quality_model.document_statistics(table(spark, sf_dir, "documents")), "document-statistics")
    labels = table(spark, sf_dir, "labels").where(bucket_of_id("doc_id", 4) != 2)
    model = quality_model.fit(stats, labels.select(F.col("doc_id").alias("id"), F.col("quality").alias("label")))
    return quality_model.predict(stats, model).select(
        F.col("id").alias("doc_id"), (bucket_of_id("id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archived(table(spark, sf_dir, "pages"))
    return read.select(F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicate(table(spark, sf_dir, "documents")).drop("kept")


def op7_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two distinct samples a document; ``exact`` tells whether decoding gave back the text."""
    encoded = segmentation.encode(table(spark, sf_dir, "documents"), VOCABULARY)
    encoded = encoded.withColumn("n_pieces", F.size("pieces").cast("long")).withColumn("pieces_hash", F.xxhash64("pieces"))
    exact = F.sha2(F.col("text").cast("binary"), 256) == F.col("text_sha256")
    return segmentation.decode(encoded, VOCABULARY).select("doc_id", "sample", "n_pieces", "pieces_hash", "log_probability", "log_inclusion", exact.alias("exact"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(bucket_of_id("doc_id", 5) != 0)
    model = toxicity.fit(docs, labels.select(F.col("doc_id").alias("id"), F.col("toxic").alias("label")))
    return toxicity.predict(docs, model).select(
        F.col("id").alias("doc_id"), (bucket_of_id("id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "abuse", "quotation",
    )


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal weights for all sources, as many rows out as in (expected)."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_pair_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pair_merges.encode(table(spark, sf_dir, "documents"), WORD_VOCABULARY)
    encoded = encoded.withColumn("n_tokens", F.size("ids").cast("long"))
    decoded = pair_merges.decode(encoded, WORD_VOCABULARY)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors: every hundredth row; labels of every seventh row are moved on by one first."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", label), F.col("id") % 100 == 0)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(prefix_trie.turns(table(spark, sf_dir, "conversations")), "turns")
    return prefix_trie.trie(*prefix_trie.rebuilt(rows)).withColumnRenamed("ends", "ends_sha256")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_language_id, op3_quality_classifier, op4_exact_top_k, op5_warc, op6_suffix_dedup,
        op7_segmentation, op8_toxicity, op9_ngram_jaccard, op10_mixing, op11_pair_merges, op12_hard_negatives, op13_prefix_trie, pipeline,
    )
}

