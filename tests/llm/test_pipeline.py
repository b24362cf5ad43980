"""The pipeline against the stages' brute-force versions."""

from __future__ import annotations

import re

import corpus_pipeline
from fleetgauge.llm import packing
from fleetgauge.llm.queries import WORD_TOKENIZER

from .test_text_operators import brute_classes, labelled


def test_stages_on_a_small_table(spark, tmp_path):
    data = [(i, t, lang) for i, t, lang, _ in labelled(60)]
    data += [(100, data[0][1], "aa"), (101, data[0][1].replace(" ", "\n"), "aa"), (102, None, None), (103, "123 456", "aa")]
    data += [(104, data[1][1] + " changed", "bb"), (105, data[2][1] + " password = 'hunter2hunter2'", None)]
    spark.createDataFrame([(i, t, x, "s", len(t or "")) for i, t, x in data],
                          "doc_id bigint, text string, lang string, source string, n_chars bigint"
                          ).write.parquet(f"{tmp_path}/documents.parquet")
    copies = {}
    for i, t, _ in data:
        if t and re.search(r"[^\W\d_]", t):
            key = re.sub(r"\s", "", t)
            copies[key] = min([(-len(t), i, t), *([copies[key]] if key in copies else [])])
    rows = sorted((i, t) for _, i, t in copies.values())
    classes = brute_classes(rows, 5, 80)
    want = {i: re.sub("password = 'hunter2hunter2", "[secret]", t) for i, t in rows if classes[i][1] == i}
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {r["doc_id"]: r["text"] for r in docs.collect()} == want
    pieces = packing.token_pieces(docs, WORD_TOKENIZER).collect()
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(tuple(r)[:5] for r in found) == sorted(map(tuple, pieces))
