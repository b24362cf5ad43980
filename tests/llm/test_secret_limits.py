"""The patterns of the secret scan on very long strings."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fleetgauge.llm import secrets

LONG = 100_000


@pytest.mark.parametrize("unit", ["=-", "a", "0", "aB3", "a-", "/x9", "Ab1=", "example", "f0-", "=", "A_", "1x"])
def test_long_runs_of_every_kind_do_not_overflow_the_matcher(spark, unit):
    run = (unit * LONG)[:LONG]
    for text in (run, run + "1x", "password=" + run, "AKIA" + run):
        df = spark.createDataFrame([(text,)], "t string")
        for pattern in (*secrets.ALLOWED, *(k.pattern for k in secrets.KINDS), *(c.pattern for c in secrets.CLASSES)):
            df.select(F.col("t").rlike(f"^(?:{pattern})$")).collect()


def test_a_text_of_marks_is_scanned(spark):
    docs = spark.createDataFrame([(1, "=-" * 2000 + "1x"), (2, "a-" * 5000), (3, "k=" + "0f" * 3000)], "doc_id bigint, text string")
    found = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in secrets.find_secrets(docs).collect()}
    assert found[1] == found[2] == [] and "hex" in found[3]


def test_the_allow_list_knows_names_and_marks(spark):
    for run, known in (("some_long/name-of=things12", True), ("abc12345", False), ("a1b2", False), ("=-=-1234", True), ("x", True)):
        df = spark.createDataFrame([(run,)], "t string")
        assert df.select(secrets.is_allowed(F.col("t"), (secrets.ALLOWED[2],))).first()[0] is known
