"""What the driver gets to learn from is bounded, whatever the ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetgauge.llm import language


def test_rows_that_share_an_id_do_not_flood_the_driver(spark):
    text = F.concat(F.lit("text "), F.col("id").cast("string")).alias("text")
    for key in (F.lit(7), F.lit(None), F.lit(3)):
        docs = spark.range(100_000).select(key.cast("bigint").alias("doc_id"), text, F.lit("aa").alias("lang"))
        for share in (40, 100_000):
            assert language.sample_of(docs, None, "doc_id", "text", "lang", share).count() <= 2 * share
    docs = spark.range(5_000).select(F.col("id").alias("doc_id"), text, F.lit("aa").alias("lang"))
    found = language.sample_of(docs, None, "doc_id", "text", "lang", 500)
    assert 400 < found.count() < 600 and found.columns == ["lang", "text"]
    assert language.sample_of(docs.filter("false"), None, "doc_id", "text", "lang", 500).count() == 0
