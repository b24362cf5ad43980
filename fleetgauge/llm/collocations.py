"""Phrases of words that go together, mined by partitioning: locally frequent phrases first, then exact counts.

Documents fall into ``shards`` by a hash. A phrase that occurs ``support`` times in its language occurs in some shard at
least as often as that shard's part of the language's words asks for, so that every shard is mined completely at the
support lowered by that part. What is frequent in any shard is a candidate, and all candidates are then counted by their
texts over all documents, wherever they occur.

A shard is as large as the table makes it and is mined by Spark, not in one task: words become 64-bit hashes in a table,
and level by level the phrases of one more word are counted in each shard, those alone whose two parts one word shorter
were candidates. Which those are is asked of a bitmap of fixed size (``bits``), which every task gets; where it is too full
it rules out less, and nothing that counts is ever ruled out. So hashes and bitmap only choose what is counted exactly.

Defined cases: a null text has no words; a null language is ``und``; ids aren't read, so that null, tied and repeated ones
need no rule and repeated rows count each; a long text is counted whole, as a slice of its own; an empty table gives no
row. Columns but the two named aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.llm.common import WordHashes, as_table, mixed, shuffles_removed, slices

SUPPORT, LONGEST, TOP, SHARDS = 100, 5, 2000, 4
#: Size of the bitmap of candidates, 8 MB.
BITS = 1 << 26
UNKNOWN = "und"
#: Bytes of text that a task works on at once.
SLICE = 1 << 20
#: Batches that Python gets of texts, and of rows of hashes: both sides hold several copies of one.
TEXTS_AT_ONCE, HASHES_AT_ONCE = "12m", "4m"
#: Small row groups, looked at after every row: a file of a few large rows can then be read in parts.
SMALL_GROUPS = {"parquet.block.size": str(4 << 20), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1"}
#: What ends a piece is made a full stop, which is then a word by itself and no other word.
ENDS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", b"..........")
_BASE, _ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: Bits of a hash that hold a shard's number, hence 64 shards at most.
FREE = np.uint64(6)


def words_of(texts: list[bytes]) -> list[bytes]:
    """The words of the texts in lower case, with ``.`` where a piece ends."""
    return b".".join(texts).lower().translate(ENDS).replace(b".", b" . ").split()


def hashes_of(words: list[bytes], known: WordHashes) -> np.ndarray:
    """The words' hashes, 0 for the end of a piece."""
    found = known.of(words)
    found[found == np.uint64(xxhash.xxh64_intdigest(b"."))] = 0
    return found


def phrase_hashes(words: np.ndarray, size: int, lang: str) -> tuple[np.ndarray, np.ndarray]:
    """For every place where ``size`` words could begin, the hash of them and of the language, its lowest bits free for a
    shard, and whether the words lie in one piece."""
    n = max(len(words) - size + 1, 0)
    total, fine = np.zeros(n, dtype=np.uint64), np.ones(n, dtype=bool)
    for k in range(size):
        part = words[k:k + n]
        total = total * _BASE + part
        fine &= part != 0
    salt = np.uint64(xxhash.xxh64_intdigest(lang.encode(), seed=size))
    return mixed(total ^ salt) >> FREE << FREE, fine


def places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of a bitmap for each hash."""
    n = np.uint64(bits)
    return (hashes >> FREE) % n, (hashes >> np.uint64(32)) * _ODD % n


def may_hold(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Of which hashes both bits are set."""
    out = np.ones(len(hashes), dtype=bool)
    for place in places(hashes, 64 * len(bitmap)):
        out &= (bitmap[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
    return out


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[int, str, list[bytes]]]:
    """The texts of a batch ``shard, lang, text`` by shard and language, about ``SLICE`` bytes at a time."""
    members: dict[tuple[int, str], list[int]] = {}
    for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
        members.setdefault(key, []).append(i)
    sizes = pa.compute.binary_length(batch.column(2)).to_pylist()
    for (shard, lang), rows in sorted(members.items()):
        for begin, end in slices([sizes[i] for i in rows], SLICE):
            yield shard, lang, batch.column(2).take(pa.array(rows[begin:end])).to_pylist()


def hashed_words(docs: DataFrame) -> DataFrame:
    """``shard, lang, n, hashes``: texts of one shard and language as hashes of words."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()  # goes with the task; the tasks to come need the memory
        for batch in batches:
            for shard, lang, texts in _groups(batch):
                found = hashes_of(words_of(texts), known)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int32()), pa.array([lang]), pa.array([np.count_nonzero(found)], pa.int64()),
                     pa.array([found.astype("<u8").tobytes()], pa.binary())], names=["shard", "lang", "n", "hashes"])

    return as_table(docs.mapInArrow(hashed, "shard int, lang string, n bigint, hashes binary"), "phrase-words", **SMALL_GROUPS)


def shard_counts(words: DataFrame, size: int, candidates: Broadcast) -> DataFrame:
    """``key, least, n``: how often phrases of ``size`` words occur in a shard, those whose parts may be candidates. The key
    is the phrase's hash with the shard in its free bits."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                shard, least, lang = (batch.column(k)[i].as_py() for k in range(3))
                row = np.frombuffer(batch.column(3)[i].as_buffer(), dtype="<u8")
                found, fine = phrase_hashes(row, size, lang)
                if size > 1:
                    parts, whole = phrase_hashes(row, size - 1, lang)
                    held = np.zeros(len(parts), dtype=bool)
                    held[whole] = may_hold(candidates.value, parts[whole])
                    fine &= held[:-1] & held[1:]
                keys, n = np.unique(found[fine], return_counts=True)
                keys = (keys | np.uint64(shard)).astype(np.int64)
                for k in range(0, len(keys), 100_000):
                    part = keys[k:k + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part), pa.array(np.full(len(part), least, dtype=np.int32)), pa.array(n[k:k + 100_000])],
                        names=["key", "least", "n"])

    return (words.select("shard", "least", "lang", "hashes").mapInArrow(count, "key bigint, least int, n bigint")
            .groupBy("key", "least").agg(F.sum("n").alias("n")))


def add_frequent(bitmap: np.ndarray, counts: DataFrame) -> int:
    """Sets the bits of the phrases that are frequent in a shard, and says how many numbers of the bitmap that touches.
    These, each once, are what the driver gets."""
    n_bits = 64 * len(bitmap)

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy().astype(np.uint64) >> FREE << FREE
            place = np.sort(np.concatenate(places(keys, n_bits)))
            at, value = place >> np.uint64(6), np.uint64(1) << (place & np.uint64(63))
            starts = np.flatnonzero(np.append(True, at[1:] != at[:-1])[:len(at)])
            value = np.bitwise_or.reduceat(value, starts) if len(starts) else value
            yield pa.RecordBatch.from_arrays([pa.array(at[starts].astype(np.int64)), pa.array(value.astype(np.int64))],
                                             names=["at", "bits"])

    found = (counts.filter("n >= least").select("key").mapInArrow(bits, "at bigint, bits bigint")
             .groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow())
    bitmap[found.column("at").to_numpy()] |= found.column("bits").to_numpy().astype(np.uint64)
    return len(found)


def exact_counts(docs: DataFrame, longest: int, candidates: Broadcast) -> DataFrame:
    """``lang, phrase, size, n``: all occurrences of the phrases of up to ``longest`` words that may be candidates."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for _, lang, texts in _groups(batch):
                words = words_of(texts)
                row = hashes_of(words, known)
                index: dict[bytes, int] = {}
                ids = np.fromiter((index.setdefault(w, len(index)) for w in words), dtype=np.int64, count=len(words))
                held = None
                for size in range(1, longest + 1):
                    found, fine = phrase_hashes(row, size, lang)
                    if held is not None:
                        fine &= held[:-1] & held[1:]
                    held = np.zeros(len(found), dtype=bool)
                    held[fine] = may_hold(candidates.value, found[fine])
                    at = np.flatnonzero(held)
                    for first, n in distinct(found, ids, at, size):
                        names = [b" ".join(words[i:i + size]).decode() for i in first]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(names)), pa.array(names), pa.array([size] * len(names), pa.int32()), pa.array(n)],
                            names=["lang", "phrase", "size", "n"])

    return (docs.mapInArrow(count, "lang string, phrase string, size int, n bigint")
            .groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n")))


def distinct(found: np.ndarray, ids: np.ndarray, at: np.ndarray, size: int, most: int = 50_000) -> Iterator[tuple[list[int], np.ndarray]]:
    """Where each different phrase that begins at ``at`` begins first, and how often it occurs, in lots. Phrases are told
    apart by hash; should two share one, by their words."""
    _, first, inverse, n = np.unique(found[at], return_index=True, return_inverse=True, return_counts=True)
    if all((ids[at + k] == ids[at[first][inverse] + k]).all() for k in range(size)):
        first = at[first]
    else:
        rows = np.stack([ids[at + k] for k in range(size)], axis=1)
        _, first, n = np.unique(rows, axis=0, return_index=True, return_counts=True)
        first = at[first]
    for k in range(0, len(first), most):
        yield first[k:k + most].tolist(), n[k:k + most].astype(np.int64)


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT,
                     longest: int = LONGEST, shards: int = SHARDS, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, size, n`` of every phrase of up to ``longest`` words that occurs ``support`` times in its language,
    and ``lang, n``, the words of each."""
    lang = F.coalesce(docs[lang_col].cast("string"), F.lit(UNKNOWN))
    text = F.coalesce(docs[text_col], F.lit(""))
    texts = docs.select(F.pmod(F.xxhash64(lang, text), F.lit(shards)).cast("int").alias("shard"), lang.alias("lang"),
                        text.cast("binary").alias("text"))
    with shuffles_removed(docs.sparkSession, TEXTS_AT_ONCE):
        words = hashed_words(texts)
    in_shard = words.groupBy("lang", "shard").agg(F.sum("n").alias("n_shard"))
    in_all = as_table(words.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-languages")
    least = as_table(in_shard.join(in_all, "lang").select(
        "lang", "shard", F.expr(f"CAST(greatest((n_shard * {support} + n - 1) div greatest(n, 1L), 1L) AS INT)").alias("least")),
        "phrase-supports")
    words = words.join(least, ["lang", "shard"])

    context, bitmap = docs.sparkSession.sparkContext, np.zeros(bits // 64, dtype=np.uint64)
    sent = context.broadcast(bitmap)
    for size in range(1, longest + 1):
        found = 0
        for shard in range(shards):  # one after the other, so that one shard's counts at a time take disk
            with shuffles_removed(docs.sparkSession, HASHES_AT_ONCE):
                found += add_frequent(bitmap, shard_counts(words.filter(F.col("shard") == shard), size, sent))
        if not found:
            break
        sent.destroy()
        sent = context.broadcast(bitmap)
    with shuffles_removed(docs.sparkSession, TEXTS_AT_ONCE):
        return as_table(exact_counts(texts, longest, sent).filter(F.col("n") >= support), "phrase-counts"), in_all


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT,
                 longest: int = LONGEST, top: int = TOP, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` phrases of two and more words. The score
    is the least, over all cuts in two, of 1000 times how often the phrase occurs over what its parts' counts lead to
    expect. A phrase that occurs inside a longer one alone is left out."""
    counted, totals = frequent_phrases(docs, text_col, lang_col, support, longest, shards, bits)
    phrases = counted.filter("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))

    text = lambda start, length: F.array_join(F.slice("words", start, length), " ")
    inner = (phrases.filter("size > 2").withColumn("length", F.explode(F.expr("sequence(2, size - 1)")))
             .withColumn("start", F.explode(F.expr("sequence(1, size - length + 1)")))
             .groupBy("lang", text(F.col("start"), F.col("length")).alias("phrase")).agg(F.max("a").alias("longer")))
    phrases = phrases.join(inner, ["lang", "phrase"], "left").filter("longer IS NULL OR longer < a").drop("longer")

    parts = counted.select("lang", F.col("phrase").alias("part"), F.col("n").alias("times"))
    cuts = phrases.withColumn("k", F.explode(F.expr("sequence(1, size - 1)"))).withColumns({
        "first": text(F.lit(1), F.col("k")), "rest": text(F.col("k") + 1, F.col("size") - F.col("k"))}).drop("words")
    cuts = cuts.join(parts.select("lang", F.col("part").alias("first"), F.col("times").alias("l")), ["lang", "first"])
    cuts = cuts.join(parts.select("lang", F.col("part").alias("rest"), F.col("times").alias("r")), ["lang", "rest"])
    wide = lambda c: f"CAST({c} AS DECIMAL(18,0))"
    score = F.expr(f"CAST(1000 * CAST({wide('a')} * {wide('n')} AS DECIMAL(34,0)) AS DECIMAL(38,0)) div ({wide('l')} * {wide('r')})")
    scored = (cuts.join(totals, "lang").withColumn("score", score)
              .groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    return (scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score"))
