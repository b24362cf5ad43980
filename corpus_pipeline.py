"""From raw documents to packed training sequences, in five stages over whole tables.

Every stage works on all that its predecessor kept and returns the columns of ``documents``; the last one returns the
packed pieces. Rows without an id stay in every stage. A null text has no language and goes in the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetgauge.llm import exact_copies, jaccard, language, packing, secrets
from fleetgauge.llm.common import TEXT_BATCH, as_table, documents, shuffles_removed
from fleetgauge.llm.queries import WORD_TOKENIZER


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network, trained on the documents' own labels, knows."""
    return language.keep_known(docs, language.learn(docs))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts: the longest as written, then the smallest id."""
    return exact_copies.without_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group linked by Jaccard similarity, of five-word shingles and 0.8 or more: the smallest id."""
    return jaccard.one_of_each(docs, width=5, percent=80)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    return secrets.without_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of 2048."""
    return packing.pack_documents(docs, WORD_TOKENIZER)


STAGES = [
    ("language ID", known_language),
    ("exact dedup", without_copies),
    ("n-gram Jaccard join", without_near_copies),
    ("secret scans", without_secrets),
    ("best-fit packing", packed),
]

#: SQL can't express the network, the entropy scan or the packing; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        with shuffles_removed(spark, TEXT_BATCH):
            docs = as_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
