"""The mix against a version in plain Python that follows the same draws."""

from __future__ import annotations

import random
import re
from collections import Counter
from fractions import Fraction
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from fleetgauge.llm import mixing
from fleetgauge.llm.common import in_order

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, source string, size string, number bigint, row string, target int"
BLOCK, SHARD = 4, 64


def number(*parts) -> int:
    return int(md5(":".join(map(str, parts)).encode()).hexdigest()[:12], 16)


def aims(sizes: dict, weights=(3, 1, 2)) -> dict:
    """Targets by sharing what the bounds leave, source by source."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    out, open_ = {}, set(names)
    while open_:
        rest = Fraction(3, 2) * sum(sizes.values()) - sum(out.values())
        share = {s: rest * weight[s] / sum(weight[t] for t in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        out |= {s: Fraction(2 * sizes[s]) for s in over} if over else share
        open_ = open_ - over if over else set()
    return {s: out[s] for s in names}


def permuted(x: int, n: int, turn_of: tuple) -> int:
    for r in range(1, mixing.ROUNDS + 1):
        other = (number(*turn_of, r) % n - x) % n
        if md5(":".join(map(str, (*turn_of, r, max(x, other)))).encode()).hexdigest()[0] < "8":
            x = other
    return x


def brute(rows: list[tuple]) -> list[tuple]:
    docs = [(i, len(WORD.findall(t or "")), s) for i, t, s in rows]
    sizes = {s: 0 for _, _, s in docs}
    for _, n, s in docs:
        sizes[s] += n
    target = aims(sizes)
    blocks = {s: -(-n // BLOCK) for s, n in sizes.items()}
    unit = mixing.UNIT
    expected = {s: min(int(target[s] * blocks[s] * unit / sizes[s]), 2 * unit * blocks[s]) if sizes[s] else 0 for s in target}
    shards = -(-sum(expected.values()) // (SHARD * unit))
    given = {s: e // (max(shards, 1) * unit) for s, e in expected.items()}
    tickets = {s: (e - given[s] * shards * unit) // max(shards, 1) for s, e in expected.items()}
    left = (shards * sum(tickets.values()) + unit // 2) // unit
    slots = {s: [k * given[s] + j for k in range(shards) for j in range(given[s])] for s in target}
    for k in range(shards):
        for draw in range(1, (k + 1) * left // shards - k * left // shards + 1):
            ticket = number("mix", "draw", k, draw) % sum(tickets.values())
            for s, n in tickets.items():
                if ticket < n:
                    slots[s].append(len(slots[s]))
                    break
                ticket -= n
    out = []
    for s, n in sizes.items():
        no = list(target).index(s)
        times = Counter(permuted(i % blocks[s], blocks[s], ("mix", no, i // blocks[s])) for i in slots[s] if i < 2 * blocks[s])
        place = 0
        for i, size, _ in sorted((d for d in docs if d[2] == s), key=lambda d: (d[0] is not None, d[0] or 0, d[1])):
            out.append((i, size, n, float(target[s]), sum(times[w // BLOCK] for w in range(place, place + size))))
            place += size
    return sorted(out, key=str)


def texts() -> list[tuple]:
    rng = random.Random(2)
    prose = lambda n: " ".join(["word"] * n)
    rows = [(i, prose(rng.randint(0, 30)), rng.choice(["a", "b", "b", "b", "é", None, "tiny"])) for i in range(150)]
    rows += [(1000 + i, prose(9), "hot") for i in range(80)] + [(2000, prose(3000), "long"), (2001, None, "none"), (2002, "", "none")]
    return rows + [(None, prose(7), "a"), (None, prose(7), "a"), (5, prose(3), "b"), (5, prose(3), "b"), (3000, " \t\n", None)]


def table(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", None, "y", None) for i, t, s in rows], SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, texts())


def test_mix_follows_the_plain_version(docs):
    found = mixing.mix_documents(docs, block=BLOCK, shard=SHARD)
    got = sorted((tuple(r) for r in found.collect()), key=str)
    want = brute(texts())
    assert [r[:3] + r[4:] for r in got] == [r[:3] + r[4:] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], rel=1e-12)
    assert got == sorted((tuple(r) for r in mixing.mix_documents(docs.repartition(7), block=BLOCK, shard=SHARD).collect()), key=str)


def test_sources_come_near_their_targets_and_no_document_twice_over(docs):
    mix = mixing.mix_documents(docs, block=1, shard=500)
    assert mix.filter("taken > 2 * size").count() == 0
    near = mix.groupBy("source_size", "target").agg(F.sum("taken").alias("taken"))
    for r in near.collect():
        assert abs(r["taken"] - r["target"]) <= 8 and r["target"] <= 2 * r["source_size"]


def test_slots_hold_blocks_evenly_and_parts_cover_every_word(docs):
    mix = mixing.mix_blocks(docs, block=BLOCK, shard=SHARD)
    times = mix.slots.groupBy("number", "block").count()
    assert times.groupBy("number").agg((F.max("count") - F.min("count")).alias("d")).filter("d > 1").count() == 0
    assert mix.slots.groupBy("number", "index").count().filter("count > 1").count() == 0
    words = mix.parts.groupBy("row").agg(F.sum("words").alias("n"), F.min("first").alias("first"))
    assert mix.documents.filter("size > 0").join(words, "row").filter("n = size AND first = 0").count() == \
        mix.documents.filter("size > 0").count()
    full = mix.parts.groupBy("number", "block").agg(F.sum("words").alias("n"))
    assert full.filter(F.col("n") < BLOCK).groupBy("number").count().filter("count > 1").count() == 0


def test_permutation_hits_every_number_once(spark):
    for n in (1, 2, 3, 17, 100):
        x = spark.range(n).withColumn("n", F.lit(n).cast("bigint"))
        keys = mixing.round_keys(F.col("n"), F.lit("s"), F.lit(1))
        found = [r[0] for r in x.select(mixing.permuted(F.col("id"), F.col("n"), keys, F.lit("s"), F.lit(1))).collect()]
        assert sorted(found) == list(range(n))
        assert found == [permuted(i, n, ("s", 1)) for i in range(n)]


def test_tables_without_rows_or_words(spark, docs):
    assert mixing.mix_documents(docs.filter("false")).count() == 0
    empty = mixing.mix_documents(table(spark, [(1, None, "a"), (2, "", None)])).collect()
    assert sorted(tuple(r) for r in empty) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    one = mixing.mix_documents(table(spark, [(1, "a b c", None)])).collect()
    assert one[0]["target"] == 4.5 and one[0]["taken"] in (3, 6)


def test_order_over_many_ranges(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.randint(0, 5), i) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, n bigint, row bigint").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        found = in_order(df, [F.col("k").isNull(), F.col("k"), F.col("row")], "t", "n").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    total, want = 0, {}
    for k, n, row in sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[2])):
        want[row] = total
        total += n
    assert {r["row"]: r["before"] for r in found} == want
