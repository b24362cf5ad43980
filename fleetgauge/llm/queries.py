"""The registered queries: thin, each applies its operator to the whole table and derives the digest columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.llm import (
    centroids,
    collocations,
    exact_copies,
    jaccard,
    language,
    lines,
    mixing,
    packing,
    pieces,
    quality,
    secrets,
    substrings,
    toxicity,
)
from fleetgauge.llm.common import documents, in_fold

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), WORD_TOKENIZER)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_substrings(documents(spark, sf_dir)).drop("kept")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(documents(spark, sf_dir))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = language.predict(docs, language.learn(docs, ~in_fold("doc_id", 2)))
    return found.select("doc_id", in_fold("doc_id", 2).alias("held_out"), "lang_pred", "score")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = toxicity.predict(docs, toxicity.learn(docs, labels))
    return found.select("doc_id", in_fold("doc_id", 2).alias("held_out"), "score", "predicted")


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_classes(documents(spark, sf_dir))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_copies.exact_dedup(documents(spark, sf_dir), digest_all=True)
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("content_hash").alias("text_sha256"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(documents(spark, sf_dir)).drop("text")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_digests(documents(spark, sf_dir), PIECE_MODEL)


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(documents(spark, sf_dir)).drop("text")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    return found.select(
        "doc_id", *(count(k.name).alias(f"n_{k.name}") for k in secrets.KINDS),
        F.sha2(secrets.joined(base), 256).alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"))


def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(documents(spark, sf_dir))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))[0]


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_substring_dedup, op3_quality_rules, op4_language_id, op5_toxicity, op6_ngram_jaccard,
    op7_exact_dedup, op8_line_dedup, op9_sentencepiece, op10_secret_scans, op11_source_mixing,
    op12_centroid_clustering, op13_phrase_collocations)}
