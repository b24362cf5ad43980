"""Phrases against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from fleetgauge.llm import collocations

SCHEMA = "doc_id bigint, text string, lang string, phrase string, n bigint, a string"


def lower(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def counts(rows: list[tuple]) -> tuple[Counter, Counter]:
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        n[lang] += 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i:i + k])) for k in range(1, 6) for i in range(len(words) - k + 1))
    return f, n


def brute(rows: list[tuple], support: int, top: int) -> list[tuple]:
    f, n = counts(rows)
    often = {x: c for x, c in f.items() if c >= support and len(x[1]) > 1}
    found = []
    for (lang, p), a in often.items():
        longer = (c for (o, q), c in often.items() if o == lang and len(q) > len(p)
                  and any(q[i:i + len(p)] == p for i in range(len(q))))
        if any(c >= a for c in longer):
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        found.append((lang, -score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]], n[lang]))
    out, rank = [], Counter()
    for lang, score, a, phrase, left, right, total in sorted(found):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), -a, left, right, total, -score))
    return out


def texts() -> list[tuple]:
    rng = random.Random(3)
    words = ["new", "york", "city", "the", "of", "in", "Über", "été", "x\x00y", "ın", "rain", "sun", "İt", "a-b", "~"]
    rows = []
    for i in range(400):
        text = ""
        for _ in range(rng.randint(0, 30)):
            text += rng.choice(["New York City", "in the rain", *words]) + rng.choice([" ", " ", " ", "\t", ", ", ".", "\n", "\r\n", "  ", " ", "\x85 "])
        rows.append((i, text, rng.choice(["en", "en", "en", "de", None])))
    return rows + [(None, None, None), (1, "", "en"), (2, None, "zz"), (3, "a a a a a a a a " * 2000, "en"), (3, "a a a", "en"),
                   (3, "a a a", "en"), (4, ".,;:!?", "en"), (5, "one two " * 30, "und")]


def table(spark, rows):
    return spark.createDataFrame([(i, t, x, "p", None, None) for i, t, x in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize(("support", "shards", "top"), [(20, 4, 2000), (3, 8, 15), (1, 1, 40)])
def test_agrees_with_plain_counting(spark, support, shards, top):
    rows = texts()
    found = collocations.collocations(table(spark, rows), support=support, shards=shards, top=top, bits=1 << 16)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, support, top)


def test_a_full_bitmap_rules_nothing_out_and_changes_nothing(spark):
    rows = texts()[:150]
    found = collocations.collocations(table(spark, rows), support=4, bits=64)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, 4, 2000)


def test_empty_tables(spark):
    assert collocations.collocations(table(spark, texts()).filter("false")).count() == 0
    assert collocations.collocations(table(spark, [(1, None, None), (2, "", "en")])).count() == 0


def test_phrases_that_share_a_hash_are_told_apart():
    ids = np.array([0, 1, 2, 1, 0, 1])
    found = list(collocations.distinct(np.zeros(5, dtype=np.uint64), ids, np.arange(5), 2))
    assert sorted(zip(found[0][0], found[0][1].tolist(), strict=True)) == [(0, 2), (1, 1), (2, 1), (3, 1)]


def test_scores_pass_64_bits(spark):
    a, n, left, right = 3 * 10**12, 4 * 10**13, 3 * 10**12, 5 * 10**12
    wide = "CAST({} AS DECIMAL(18,0))"
    assert 1000 * a * n > 1 << 64
    score = spark.range(1).selectExpr(
        f"CAST(1000 * CAST({wide.format(f'{a}L')} * {wide.format(f'{n}L')} AS DECIMAL(34,0)) AS DECIMAL(38,0)) div "
        f"({wide.format(f'{left}L')} * {wide.format(f'{right}L')}) AS s").first()["s"]
    assert score == 1000 * a * n // (left * right)
