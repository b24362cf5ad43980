"""What the two models keep of the counts, against plain Kneser-Ney counting."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetgauge.llm import toxicity


def plain(data):
    """Shares of words and pairs in each class by the formulas, without hashes: ``word(c, w)`` and ``pair(c, v, w)``."""
    pairs = [Counter(), Counter()]
    for text, toxic in data:
        words = text.split()
        pairs[toxic].update(zip(["", *words], words, strict=False))
    k = [Counter(w for _, w in p) for p in pairs]
    own, vocabulary = [sum(x.values()) for x in k], set(k[0]) | set(k[1])
    shared = {w: (k[0][w] + k[1][w] + 1) / (sum(own) + len(vocabulary) + 1) for w in vocabulary}
    left = [1 - sum(max(n - toxicity.WORD_DISCOUNT, 0) for n in k[c].values()) / own[c] for c in (0, 1)]
    totals = [Counter(), Counter()]
    for c in (0, 1):
        for (v, _), n in pairs[c].items():
            totals[c][v] += n

    def word(c, w):
        return max(k[c][w] - toxicity.WORD_DISCOUNT, 0) / own[c] + left[c] * shared.get(w, 1.0)

    def pair(c, v, w):
        kept = sum(max(n - toxicity.PAIR_DISCOUNT, 0) for (x, _), n in pairs[c].items() if x == v) / max(totals[c][v], 1)
        return max(pairs[c][v, w] - toxicity.PAIR_DISCOUNT, 0) / max(totals[c][v], 1) + max(1 - kept, 1e-3) * word(c, w)

    return word, pair


@pytest.mark.parametrize("cached", [10_000, 7])
def test_figures_are_those_of_plain_kneser_ney(spark, cached):
    rng = random.Random(11)
    common, bad = [f"w{i}" for i in range(30)], ["grim", "foul"]
    data = []
    for i in range(150):
        toxic = int(i % 10 == 0)
        words = rng.choices(common, weights=range(30, 0, -1), k=25)
        if toxic:
            words[5:5] = bad
        data.append((" ".join(words), toxic))
    rows = spark.createDataFrame(data, "text string, toxic int").withColumn("text", F.col("text").cast("binary"))
    model = toxicity.fit_models(toxicity.pair_counts(rows), cached)
    asked = [(0, data[0][0]), (1, data[1][0]), (2, "grim foul w1 w2 never heard"), (3, ""), (4, "w1 w1 w1")]
    docs = spark.createDataFrame(asked, "doc_id bigint, text string").withColumn("text", F.col("text").cast("binary"))
    found = {r["doc_id"]: (r["figure"], r["peak"]) for r in toxicity.with_figures(docs, model).collect()}
    word, pair = plain(data)
    for i, text in asked:
        own = set(zip(["", *text.split()], text.split(), strict=False))
        figure = np.mean([math.log(pair(1, *p) / pair(0, *p)) for p in own]) if own else 0.0
        peak = math.log(np.mean([(word(1, w) / word(0, w)) ** 2 for _, w in own])) / 2 if own else 0.0
        assert found[i] == (pytest.approx(figure), pytest.approx(peak)), i


def test_the_ordinary_class_keeps_its_share(spark):
    """Nine in ten texts are ordinary: words, and pairs, that only these have must speak against toxicity."""
    data = [("the calm sea and the calm sky", 0)] * 9 + [("the grim foul sky and the calm foul sea", 1)]
    data = [(f"{text} {i} {i % 4}", toxic) for i, (text, toxic) in enumerate(data * 20)]
    rows = spark.createDataFrame(data, "text string, toxic int").withColumn("text", F.col("text").cast("binary"))
    base, _, weights = toxicity.weights_of(toxicity.pair_counts(rows))
    found = {r["key"]: r["behind"] for r in weights.collect()}
    words = toxicity.WordPairs()
    pairs, first, second = words.pairs(b"the calm sea and the calm sky")
    assert found[int(words.pairs(b"foul")[2][0])] + base > 0
    assert sum(found.get(int(p), 0.0) != 0 for p in pairs) == len(pairs)
    assert found[int(pairs[2])] < 0  # "calm sea"


def test_a_bitmap_rules_out_and_never_loses_a_key(spark):
    rng = np.random.default_rng(2)
    keys = rng.integers(-(1 << 63), (1 << 63) - 1, 5000)
    held = toxicity.bitmap_of(spark.createDataFrame([(int(x),) for x in keys], "key bigint"), len(keys))
    assert toxicity.may_hold(held, keys).all()
    others = rng.integers(-(1 << 63), (1 << 63) - 1, 5000)
    assert toxicity.may_hold(held, others).mean() < 0.1
