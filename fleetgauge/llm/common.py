"""Helpers that the text operators share: document columns, hashing of words, tables in the shared folder."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
#: Bytes of text that a task works on at once, and words that it remembers.
SLICE_BYTES = 4 << 20
KNOWN_WORDS = 300_000
#: Batches of texts that go to Python and back, where a stage must leave room for what earlier ones hold.
TEXT_BATCH = "4m"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that operators work on, a null text as the empty one; other columns stay out of the way."""
    return docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))


def id_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``id_text``, with the text as UTF-8 bytes, which Arrow passes to Python without decoding."""
    return id_text(docs, id_col, text_col).withColumn("text", F.col("text").cast("binary"))


def sql_type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def in_fold(id_col: str | Column, fold: int, folds: int = 4) -> Column:
    """Whether CRC-32 of the id as text falls into ``fold``; a null id falls into none."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % folds == fold, F.lit(False))


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that the driver and all executors reach: below ``spark.checkpoint.dir``, or below the
    warehouse where that is unset, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/llm/{purpose}-{uuid.uuid4().hex}"


def as_table(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """``df`` written to the shared folder and read back, so that a lost executor costs no recomputation."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession, batch: str | None = None) -> Iterator[None]:
    """What is built and run in here leaves no shuffle files behind once it has run, and Python gets batches of about
    ``batch`` bytes at most. For results that are collected or written, not for plans that run later."""
    settings = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    if batch:
        settings["spark.sql.execution.arrow.maxBytesPerBatch"] = batch
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


#: Rows of at most so many ids, or ids with small arrays, are sent to all tasks (a few tens of MB at the most).
SENT_ROWS = 1_000_000


def sent_if_small(df: DataFrame, rows: int | None = None, most: int = SENT_ROWS) -> DataFrame:
    """``df``, a table already written, marked for broadcast if its rows, or ``rows`` of what they hold, are few
    enough; else as it is, for a join by a shuffle."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= most else df


def kept_in_worker(key: tuple, make):
    """What ``make`` returns, made once in a worker process and used by all its tasks. It is kept by ``sys``: functions
    that travel with a job have module variables of their own in each task."""
    held = sys.__dict__.setdefault("_kept_for_text", {})
    if key not in held:
        held[key] = make()
    return held[key]


class WordHashes(dict):
    """64-bit hashes of words (bytes), remembered for the words seen lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, 2 * len(_POWERS[0]))
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """The values of a 64-bit finaliser: neighbouring inputs become unrelated."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` consecutive words, from their hashes: differences of running sums modulo 2**64."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    up, down = _powers(len(words))
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * up, dtype=np.uint64, out=sums[1:])
    return mixed((sums[width:] - sums[:n]) * down[:n])


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a window that begins at one of ``starts``."""
    edges = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, np.minimum(starts + width, n), -1)
    return np.cumsum(edges[:n]) > 0


def slices(sizes: list[int], most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of at most ``most`` bytes together, at least one text each."""
    begin, held = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and held + size > most:
            yield begin, i
            begin, held = i, 0
        held += size
    if begin < len(sizes):
        yield begin, len(sizes)


def batch_of(schema: dict[str, pa.DataType], ids: pa.Array, columns: list) -> pa.RecordBatch:
    """A batch of the ids followed by ``columns``."""
    arrays = [ids] + [x if isinstance(x, pa.Array) else pa.array(x, type=t)
                      for x, t in zip(columns, schema.values(), strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["doc_id", *schema])


def in_order(df: DataFrame, order: list[Column], purpose: str, value: str | None = None) -> DataFrame:
    """``df``, written to the shared folder, with ``before``: how many rows come before it in ``order``, or what their
    ``value``, whole numbers, add up to. ``order`` should tell rows apart, or rows that are equal in it share a task.

    The rows are dealt out by ranges and sorted there. A row's place is its range's start, one number per
    range that the driver adds up, and its place in the range.
    """
    spark, bits = df.sparkSession, 33  # of a row's place in its partition
    own = df.columns
    named = df.select("*", *(c.alias(f"__by_{i}") for i, c in enumerate(order)))
    by = [F.col(f"__by_{i}") for i in range(len(order))]
    placed = named.repartitionByRange(*by).sortWithinPartitions(*by).select(*own, F.monotonically_increasing_id().alias("__at"))
    placed = as_table(placed, purpose).withColumn("__part", F.shiftright("__at", bits))
    sizes = placed.groupBy("__part").agg(F.sum(value) if value else F.count(F.lit(1))).collect()
    starts, at = [], 0
    for part, size in sorted((r[0], r[1]) for r in sizes):
        starts.append((part, at))
        at += int(size or 0)
    starts = spark.createDataFrame(starts, "__part bigint, __start bigint")
    if value:
        earlier = Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
        inside = F.coalesce(F.sum(value).over(earlier), F.lit(0))
    else:
        inside = F.col("__at").bitwiseAND((1 << bits) - 1)
    return (placed.withColumn("__inside", inside).join(starts, "__part")
            .select(*own, (F.col("__start") + F.col("__inside")).cast("bigint").alias("before")))
