"""Clustering against plain Python integers, with the awkward vectors."""

from __future__ import annotations

import math
import random
from hashlib import sha256

import numpy as np
import pytest

from fleetgauge.llm import centroids

SCHEMA = "vec_id bigint, embedding array<double>, cluster int, distance string, x array<double>, ids string"


def brute(rows: list[tuple], dims: int, clusters: int, rounds: int) -> list[tuple]:
    def held(x):
        return max(-centroids.HELD, min(centroids.HELD, math.floor(1024 * x) if abs(x) < 1e300 else int(math.copysign(1, x)) * centroids.HELD))

    kept = [(i, x, [held(c) for c in x]) for i, x in rows
            if x is not None and len(x) == dims and all(c is not None and math.isfinite(c) for c in x)]
    first = sorted(kept, key=lambda r: (r[0] is None, sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))[:clusters]
    at = [v for _, _, v in first]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(at))

    for _ in range(rounds):
        members = [near(v)[1] for _, _, v in kept]
        for k in range(len(at)):
            own = [v for (_, _, v), m in zip(kept, members, strict=True) if m == k]
            at[k] = [sum(c) // len(own) for c in zip(*own, strict=True)] if own else at[k]
    most = centroids.MOST
    found = [(i, k, min(d, most)) for i, _, v in kept for d, k in [near(v)]]
    inertia = [sum(d for _, k, d in found if k == c) for c in range(len(at))]
    sign = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    return sorted(((i, k, d, min(inertia[k], most), min(sum(inertia), most), sign[k]) for i, k, d in found), key=str)


def vectors(dims: int, wide: float = 1.0) -> list[tuple]:
    rng = random.Random(4)
    spots = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, 0.1) for c in rng.choice(spots)]) for i in range(300)]
    rows += [(i, [0.25] * dims) for i in range(400, 520)] + [(7, rows[7][1]), (7, rows[8][1]), (None, [0.5] * dims)]
    rows += [(600, None), (601, [0.1] * (dims - 1)), (602, [0.1] * (dims + 1)), (603, []), (604, [None] + [0.1] * (dims - 1)),
             (605, [float("nan")] * dims), (606, [float("inf")] + [0.0] * (dims - 1)), (607, [-0.0] * dims)]
    return [(i, None if x is None else [c if c is None else c * wide for c in x]) for i, x in rows]


def table(spark, rows):
    return spark.createDataFrame([(i, x, None, "d", [1.0], None) for i, x in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize(("dims", "wide", "block"), [(6, 1.0, 1 << 16), (6, 1e7, 50), (3, 1e16, 100), (2, 1e302, 40)])
def test_agrees_with_integers(spark, dims, wide, block):
    rows = vectors(dims, wide)
    found, _ = centroids.cluster_vectors(table(spark, rows), dims=dims, rounds=5, block=block)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows, dims, 8, 5)


def test_few_or_no_vectors(spark):
    rows = vectors(4)[:3]
    found, at = centroids.cluster_vectors(table(spark, rows), dims=4)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows, 4, 8, 10) and len(at) == 3
    found, at = centroids.cluster_vectors(table(spark, rows).filter("false"), dims=4)
    assert found.collect() == [] and at == []
    same = [(i, [0.5, 0.5]) for i in range(20)]
    found, _ = centroids.cluster_vectors(table(spark, same), dims=2)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(same, 2, 8, 10)


def test_tables_hold_each_integer_once():
    block = centroids.Block.of(np.array([[1, 5], [1, 7], [3, 5]], dtype=np.int64))
    assert [v.tolist() for v in block.values] == [[1, 3], [5, 7]]
    again = centroids.Block.unpacked(*block.packed())
    cluster, distance = again.nearest([[1, 5], [3, 5]])
    assert cluster.tolist() == [0, 0, 1] and distance.tolist() == [0, 4, 0]
    assert again.sums(cluster, 2) == [[2, 12], [3, 5]]
