"""Index lists of the similarity join, and what its stages leave behind."""

from __future__ import annotations

import random

import corpus_pipeline
from fleetgauge.llm import jaccard, packing
from fleetgauge.llm.common import TEXT_BATCH
from fleetgauge.llm.queries import WORD_TOKENIZER


def test_a_list_has_its_head_after_one_exchange(spark):
    rng = random.Random(3)
    rows = [(i if i % 9 else i - 1, 20 + i % 4, rng.sample(range(-60, 60), 5)) for i in range(1, 80)]
    found = jaccard.index_lists(spark.createDataFrame(rows, "doc_id bigint, n bigint, prefix array<bigint>"))
    lists = {}
    for i, n, prefix in rows:
        for pos, token in enumerate(prefix):
            lists.setdefault(token, []).append((pos, i, n))
    expected = sorted((i, n, pos, token, min(members)) for token, members in lists.items() if len(members) > 1
                      for pos, i, n in members)
    assert sorted((r["id"], r["n"], r["pos"], r["token"], (r["head_pos"], r["head"], r["head_n"]))
                  for r in found.collect()) == expected
    assert any(len(x) == 1 for x in lists.values())
    plan = found._jdf.queryExecution().sparkPlan().toString() + found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning(token") <= 2  # initial and final plan


def settings_of(monkeypatch, spark, module, call):
    """The cleaning and batch settings under which ``module`` writes its tables while ``call`` runs."""
    seen, write = [], module.as_table

    def spy(df, *args, **options):
        seen.append(tuple(spark.conf.get(k) for k in ("spark.sql.classic.shuffleDependency.fileCleanup.enabled",
                                                      "spark.sql.execution.arrow.maxBytesPerBatch")))
        return write(df, *args, **options)

    monkeypatch.setattr(module, "as_table", spy)
    call()
    return set(seen)


def test_tables_are_written_in_small_batches_and_leave_no_shuffle_files(spark, monkeypatch, tmp_path):
    docs = spark.createDataFrame([(i, f"some words of text {i % 5} and the same end", "en", "web", 40) for i in range(40)],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    clean = {("true", TEXT_BATCH)}
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    assert settings_of(monkeypatch, spark, jaccard, lambda: jaccard.jaccard_classes(docs).count()) == clean
    assert settings_of(monkeypatch, spark, packing, lambda: packing.pack_documents(docs, WORD_TOKENIZER).count()) == clean
    assert settings_of(monkeypatch, spark, corpus_pipeline, lambda: corpus_pipeline.run(spark, str(tmp_path)).count()) == clean
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
