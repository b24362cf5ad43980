"""Token ids against the tokenizer itself, and shards of rows that repeat."""

from __future__ import annotations

import random

from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleetgauge.llm import packing
from fleetgauge.llm.queries import WORD_TOKENIZER

PARTS = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "<|startoftext|>", "<|STARTOFTEXT|>", "<|", "|>", "<", "|", "Word", "don't",
         "É", "É", "ß", " ", "  ", "\n", "\t", ".", ",", "!", "?", ":", "9", "42", "x", "日本", "İ", "ﬁ", "A.B", "é!", "<|Other|>"]


def test_ids_are_the_tokenizers_for_special_tokens_in_any_case():
    rng, tokenizer, words = random.Random(8), Tokenizer.from_file(WORD_TOKENIZER), packing.WordIds(WORD_TOKENIZER)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12))) for _ in range(6000)]
    found = words.of([t.encode() for t in texts])
    for text, ids in zip(texts, found, strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_rows_that_repeat_are_dealt_into_many_shards(spark):
    docs = spark.range(100_000).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("the same few words").alias("text"))
    pieces = packing.token_pieces(docs.repartition(4), WORD_TOKENIZER)
    found = packing.pack(pieces, shard_pieces=4096)
    shards = found.groupBy(F.shiftright("sequence_id", 32).alias("shard")).count().collect()
    assert len(shards) == 25 and max(r["count"] for r in shards) < 2 * 4096 and sum(r["count"] for r in shards) == 100_000
    sums = found.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert sums.filter(f"n > {packing.CAPACITY} OR n != end").count() == 0


def test_null_ids_clashing_names_and_an_empty_table(spark):
    rows = [(None, "a b", 1, 2, 3), (None, "a b", 1, 2, 3), (5, None, None, None, None), (5, "word " * 5000, 0, 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, shard bigint, piece bigint, offset bigint")
    found = packing.pack_documents(docs, WORD_TOKENIZER).collect()
    assert sorted((r["doc_id"] or 0, r["piece"], r["length"]) for r in found) == [
        (0, 0, 3), (0, 0, 3), (5, 0, 1), (5, 0, 2048), (5, 1, 2048), (5, 2, 905)]
    assert packing.pack_documents(docs.filter("false"), WORD_TOKENIZER).count() == 0


def test_words_of_small_letters_go_straight_to_the_model(monkeypatch):
    rng, tokenizer, words = random.Random(9), Tokenizer.from_file(WORD_TOKENIZER), packing.WordIds(WORD_TOKENIZER)
    texts = [" ".join("".join(rng.choice(packing.SMALL_LETTERS) for _ in range(rng.randint(1, 14))) for _ in range(n)) for n in range(1, 60)]
    texts += ["".join(c.upper() if c.isascii() else c for c in t) for t in texts]
    monkeypatch.setattr(words, "encode", None)
    found = words.of([t.encode() for t in texts])
    assert [x.tolist() for x in found] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_ids_do_not_depend_on_white_space_or_on_what_is_remembered(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 40)
    rng, tokenizer, words = random.Random(10), Tokenizer.from_file(WORD_TOKENIZER), packing.WordIds(WORD_TOKENIZER)
    parts = [*map(chr, range(0x21)), "\x7f", "\x85", "\xa0", " ", "﻿", *"abcßéÿÉ.,'1", "caño", "straße", "x's"]
    for _ in range(100):
        texts = ["", *("".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(20))]
        found = words.of([t.encode() for t in texts])
        assert [x.tolist() for x in found] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert words.of([]) == []
