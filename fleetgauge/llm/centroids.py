"""Clustering around centroids in whole numbers, by scalar look-up tables.

A component ``x`` counts as the integer ``floor(scale * x)``. Vectors are stored in blocks, in which every dimension has
the list of integers that occur there and, for each vector, the place in that list. A round tabulates, for each dimension,
occurring integer and centroid, the squared difference; a vector's distances are then gathered from the tables and added.
A task sends on one row per cluster and dimension, the sum of the members' integers and their number, and only those
sums of clusters come to the driver, which makes the next centroids of them by floor division.

Everything is exact: the tables hold 64-bit integers while no distance in a block can pass 62 bits, else Python integers.
A distance or sum above the largest bigint is given as that number, and integers are held between -2**62 and 2**62.

Defined cases: a vector of another length, with a null, infinite or NaN component, or that is null is left out; a vector
without an id is clustered but starts no centroid unless vectors with ids are too few; of rows that repeat an id each counts,
as starts in the order of their components; with fewer vectors than centroids each starts one; a centroid nobody is
nearest to stays; of equal distances the smaller number counts; an empty table gives no row. Memory is bounded by
``BLOCK_VECTORS`` however many vectors are alike. Columns but the two named aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.common import as_table, sql_type

DIMS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
BLOCK_VECTORS = 1 << 16
#: Held integers, and the largest bigint.
HELD, MOST = 1 << 62, (1 << 63) - 1
SUMS = pa.decimal128(38)


def usable(vectors: DataFrame, id_col: str, vector_col: str, dims: int) -> DataFrame:
    """``vec_id, x`` of the vectors with exactly ``dims`` finite components, these as doubles."""
    x = vectors.select(vectors[id_col].alias("vec_id"), vectors[vector_col].cast("array<double>").alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return x.filter(F.coalesce((F.size("x") == dims) & finite, F.lit(False)))


def integers(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * x), -float(HELD), float(HELD)).astype(np.int64)


class Block:
    """Vectors by their places in the lists of integers that occur in each dimension."""

    def __init__(self, codes: np.ndarray, values: list[np.ndarray]):
        self.codes, self.values = codes, values  # dims x vectors; per dimension

    @staticmethod
    def of(vectors: np.ndarray) -> Block:
        found = [np.unique(column, return_inverse=True) for column in vectors.T]
        return Block(np.array([i for _, i in found], dtype=np.uint16 if len(vectors) <= 1 << 16 else np.uint32),
                     [v for v, _ in found])

    def packed(self) -> tuple[int, bytes, list[int], bytes]:
        return (self.codes.shape[1], self.codes.astype("<u4").tobytes() if self.codes.dtype == np.uint32 else
                self.codes.astype("<u2").tobytes(), [len(v) for v in self.values],
                np.concatenate(self.values).astype("<i8").tobytes())

    @staticmethod
    def unpacked(n: int, codes: bytes, sizes: list[int], values: bytes) -> Block:
        kind = "<u2" if len(codes) == 2 * n * len(sizes) else "<u4"
        return Block(np.frombuffer(codes, dtype=kind).reshape(len(sizes), n),
                     np.split(np.frombuffer(values, dtype="<i8"), np.cumsum(sizes)[:-1]))

    def nearest(self, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of every vector and the squared distance to it."""
        largest = max(abs(int(x)) for v in (*self.values, *map(np.array, centroids)) for x in (v.min(), v.max()))
        kind = np.int64 if (2 * largest) ** 2 * len(self.values) < HELD else object
        at = np.array(centroids, dtype=kind).T
        total = np.zeros((self.codes.shape[1], len(centroids)), dtype=kind)
        for codes, values, centre in zip(self.codes, self.values, at, strict=True):
            table = (values.astype(kind)[:, None] - centre[None, :]) ** 2
            total += table[codes]
        cluster = np.argmin(total, axis=1)
        return cluster, total[np.arange(len(total)), cluster]

    def sums(self, cluster: np.ndarray, k: int) -> list[list[int]]:
        """Of every cluster and dimension the sum, from how often each integer occurs there."""
        out = []
        for codes, values in zip(self.codes, self.values, strict=True):
            times = np.bincount(codes + cluster * len(values), minlength=k * len(values)).reshape(k, len(values))
            largest = max(abs(int(values[0])), abs(int(values[-1])))
            kind = np.int64 if largest * len(codes) < HELD else object
            out.append((times.astype(kind) @ values.astype(kind)).tolist())
        return np.array(out, dtype=object).T.tolist()


def as_blocks(vectors: DataFrame, dims: int, scale: int, block: int) -> DataFrame:
    """``vectors`` (``vec_id, x``) in rows of up to ``block``: ``n, codes, sizes, ints, ids``."""
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def row() -> pa.RecordBatch:
            ids = pa.concat_arrays([b.column(0) for b in held])
            x = np.concatenate([b.column(1).flatten().to_numpy(zero_copy_only=False) for b in held]).reshape(-1, dims)
            found = Block.of(integers(x, scale)).packed()
            ids = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(found, (pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.binary()), strict=True)]
                + [ids], names=["n", "codes", "sizes", "ints", "ids"])

        for batch in batches:
            for start in range(0, len(batch), block):
                part = batch.slice(start, block)
                if n and n + len(part) > block:
                    yield row()
                    held, n = [], 0
                held.append(part)
                n += len(part)
        if n:
            yield row()

    return as_table(vectors.mapInArrow(pack, f"n bigint, codes binary, sizes array<int>, ints binary, ids array<{kind}>"), "centroid-blocks")


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, pa.Array]]:
    for batch in batches:
        for i in range(len(batch)):
            n, codes, sizes, values = (batch.column(c)[i].as_py() for c in range(4))
            yield Block.unpacked(n, codes, sizes, values), batch.column(4).slice(i, 1).flatten()


def next_centroids(blocks: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The floors of the means of every centroid's nearest vectors."""
    k, dims = len(centroids), len(centroids[0])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, dtype=np.int64), np.zeros((k, dims), dtype=object)
        for block, _ in _blocks_of(batches):
            cluster, _ = block.nearest(centroids)
            counts += np.bincount(cluster, minlength=k)
            sums += np.array(block.sums(cluster, k), dtype=object)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(k), dims), pa.int32()), pa.array(np.tile(np.arange(dims), k), pa.int32()),
             pa.array(np.repeat(counts, dims), pa.int64()), pa.array(sums.ravel().tolist(), SUMS)],
            names=["cluster", "dim", "n", "total"])

    found = blocks.mapInArrow(partial, "cluster int, dim int, n bigint, total decimal(38,0)").groupBy("cluster", "dim").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"))
    out = [list(c) for c in centroids]
    for r in found.filter("n > 0").collect():  # one row per cluster and dimension
        out[r["cluster"]][r["dim"]] = int(r["total"]) // r["n"]
    return out


def starts(vectors: DataFrame, clusters: int, seed: int, scale: int) -> list[list[int]]:
    """The vectors with the smallest hashes of seed and id."""
    sign = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = vectors.withColumn("sign", sign).orderBy(F.col("sign").asc_nulls_last(), "x").limit(clusters).collect()
    return [integers(np.array(r["x"], dtype=np.float64), scale).tolist() for r in first]


def cluster_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = DIMS,
                    clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED,
                    block: int = BLOCK_VECTORS) -> tuple[DataFrame, list[list[int]]]:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every usable vector, and the centroids."""
    known = usable(vectors, id_col, vector_col, dims)
    centroids = starts(known, clusters, seed, scale)
    blocks = as_blocks(known, dims, scale, block)
    for _ in range(rounds if centroids else 0):
        moved = next_centroids(blocks, centroids)
        if moved == centroids:
            break  # the rounds to come change nothing
        centroids = moved

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, ids in _blocks_of(batches):
            cluster, distance = found.nearest(centroids)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(cluster, pa.int32()), pa.array([min(d, MOST) for d in distance.tolist()], pa.int64())],
                names=["vec_id", "cluster", "distance"])

    schema = f"vec_id {sql_type(known, 'vec_id')}, cluster int, distance bigint"
    near = as_table(blocks.mapInArrow(assign, schema), "centroid-nearest")
    inertia = {r[0]: int(r[1]) for r in near.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}
    sign = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    facts = near.sparkSession.createDataFrame(  # one row per centroid
        [(c, min(inertia.get(c, 0), MOST), min(sum(inertia.values()), MOST), sign[c]) for c in range(len(centroids))],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return near.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"), centroids
