"""Exact copies by progressive refinement: length, then a hash of the beginning, then a hash of everything.

Two texts are equal when they are identical without the characters ``[\\x20\\x09-\\x0D]``. Of equal texts the row
with the most code points stays, among those the smallest id. Only built-in functions are used.

Defined cases: a null text counts as empty and empty texts equal each other; a row without an id is never compared
and stays; rows that repeat an id are rows of their own, so that of repeated rows all carry the same ``keep_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.common import as_table, id_text

PREFIX_CHARS = 64


def squeezed(text: Column) -> Column:
    """The text without its white space."""
    return F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", "")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                prefix_chars: int = PREFIX_CHARS, digest_all: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, settled_by, content_hash``.

    ``settled_by`` says which step told the row apart: ``length``, ``prefix`` or ``content``. The first two steps
    move numbers only. The third computes SHA-256 of the whole text, for the rows that share length and
    beginning with another one; ``digest_all`` asks for that hash as a result for the other rows too.

    No step needs the rows of a group together: counts and the row to keep come from partial aggregates, and
    the joins back to the rows are plain ones whose large partitions adaptive execution splits.
    """
    texts = id_text(docs, id_col, text_col)
    known = texts.filter("doc_id IS NOT NULL")
    bare = known.select("doc_id", squeezed(F.col("text")).alias("bare"))
    signs = as_table(bare.select("doc_id", F.length("bare").alias("bare_length"),
                                 F.xxhash64(F.substring("bare", 1, prefix_chars)).alias("prefix_hash")), "copies-signs")

    by_prefix = signs.groupBy("bare_length", "prefix_hash").agg(F.count(F.lit(1)).alias("n"))
    by_length = by_prefix.groupBy("bare_length").agg(F.sum("n").alias("n_length"))
    step = (F.when(F.col("n_length") == 1, "length").when(F.col("n") == 1, "prefix").otherwise("content"))
    labels = by_prefix.join(by_length, "bare_length").select("bare_length", "prefix_hash", step.alias("step"))
    # Rows that repeat an id take the step of the one that gets furthest: "content" comes first in order.
    steps = (signs.join(labels, ["bare_length", "prefix_hash"]).groupBy("doc_id").agg(F.min("step").alias("step")))

    full = F.sha2(squeezed(F.col("text")), 256)
    hashed = as_table(
        known.join(steps, "doc_id")
        .select("doc_id", F.length("text").alias("points"), "step",
                (full if digest_all else F.when(F.col("step") == "content", full)).alias("content_hash")),
        "copies-hashes")
    groups = (hashed.filter("step = 'content'").groupBy("content_hash")
              .agg(F.count(F.lit(1)).alias("n"),
                   F.min(F.struct((-F.col("points")).alias("points"), F.col("doc_id"))).alias("best"))
              .select(F.col("content_hash").alias("group_key"), "n", F.col("best.doc_id").alias("best_id")))
    # Rows without a group get keys of their own: a shared null would send them all to one task.
    key = F.when(F.col("step") == "content", F.col("content_hash")).otherwise(
        F.concat(F.lit("alone-"), F.col("doc_id").cast("string")))
    keep_id = F.coalesce(F.col("best_id"), F.col("doc_id"))
    grouped = (hashed.withColumn("group_key", key).join(groups, "group_key", "left")
               .select("doc_id", keep_id.alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                       (keep_id == F.col("doc_id")).alias("kept"), F.col("step").alias("settled_by"), "content_hash"))
    nameless = texts.filter("doc_id IS NULL").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
        F.lit("id").alias("settled_by"), (full if digest_all else F.lit(None).cast("string")).alias("content_hash"))
    return grouped.unionByName(nameless)


def keep_ids(docs: DataFrame, kept: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is in the column ``doc_id`` of ``kept``, all columns, and the rows without an id.
    Of repeated rows (equal id, text equal but for white space) one stays."""
    ids = kept.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("__kept_id")).distinct()
    own = docs.withColumn("__text_key", F.xxhash64(squeezed(F.coalesce(docs[text_col], F.lit("")))))
    rows = own.join(ids, own[id_col] == ids["__kept_id"], "left_semi").dropDuplicates([id_col, "__text_key"])
    return rows.select(*docs.columns).unionByName(docs.filter(docs[id_col].isNull()))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns."""
    return keep_ids(docs, exact_dedup(docs, id_col, text_col).filter("kept"), id_col, text_col)
