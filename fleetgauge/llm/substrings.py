"""Removal of passages of at least ``WINDOW`` words that a document with a smaller id holds.

The words of a window of ``WINDOW`` consecutive words go if its word sequence also starts in a document with a smaller
id; windows are judged on the input. The steps:

1. Texts of the same words are found by a hash; all but the smallest id's repeat entirely, and take no further part.
2. Anchors (in each window the group of ``ANCHOR`` words with the smallest hash) show which stretches may repeat: equal
   windows have equal anchors. Of the windows around anchors that several documents hold, partial aggregates find
   those that repeat and the first document of each.
3. The reference is what first documents hold of repeating windows, each passage once. It is dealt into shards of
   about ``SHARD_WORDS`` words, by document, and a shard's suffix automaton gives matching statistics for the stretches
   of documents made of windows that it holds. An automaton is made where it is used: a shard, of bounded
   size, goes to as many cells as its stretches fill, so that a passage in a third of all documents is matched in many
   tasks. A task reads a cell's shard, then streams the stretches.
4. The maximal spans found are removed.

Words are compared by 64-bit hashes. Defined cases: a null or empty text has no words; a row without an id neither
loses nor takes words; rows that repeat an id never repeat one another; a text of fewer words than a window loses
nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.automaton import SuffixAutomaton
from fleetgauge.llm.common import (
    SENT_ROWS,
    WordHashes,
    as_table,
    batch_of,
    covered,
    id_bytes,
    sent_if_small,
    sql_type,
    window_hashes,
)

WINDOW = 50
ANCHOR = 16
SHARD_WORDS = 16_000
CELL_WORDS = 16_000
_INTS = pa.list_(pa.int32())


def anchors_of(hashes: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the groups of ``anchor`` words that are the smallest of some window, and their hashes."""
    groups = window_hashes(hashes, anchor)
    per_window = window - anchor + 1
    if len(groups) < per_window:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    found = []
    for at in range(0, len(groups) - per_window + 1, 1 << 16):  # so that a very long text needs little memory
        view = sliding_window_view(groups[at:at + (1 << 16) + per_window - 1], per_window)
        found.append(view.argmin(axis=1) + np.arange(len(view)) + at)
    places = np.unique(np.concatenate(found))
    return places, groups[places].astype(np.int64)


def near_starts(places: np.ndarray, n: int, window: int, anchor: int) -> np.ndarray:
    """Starts of the windows that hold a group of words at one of ``places``."""
    if not len(places):
        return np.empty(0, dtype=np.int64)
    starts = (places[:, None] + np.arange(anchor - window, 1)[None]).ravel()
    return np.unique(starts[(starts >= 0) & (starts <= n - window)])


def runs(mask: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of true entries."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def scan(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """``doc_id, n_words, whole_sha256, words_key, places, anchors`` of every document."""
    out = {"n_words": pa.int64(), "whole_sha256": pa.string(), "words_key": pa.binary(), "places": _INTS,
           "anchors": pa.list_(pa.int64())}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()

        def one(raw: bytes) -> tuple:
            words = raw.split()
            whole, hashes = b" ".join(words), known.of(words)
            places, anchors = anchors_of(hashes, window, anchor)
            return (len(words), sha256(whole).hexdigest(), blake2b(whole, digest_size=16).digest(),
                    places.astype(np.int32), anchors)

        for batch in batches:
            yield batch_of(out, batch.column(0), list(zip(*(one(t.as_py()) for t in batch.column(1)), strict=True))
                           or [[]] * len(out))

    return docs.mapInArrow(work, f"doc_id {sql_type(docs, 'doc_id')}, n_words bigint, whole_sha256 string, "
                                 "words_key binary, places array<int>, anchors array<bigint>")


def window_rows(flagged: DataFrame, window: int, anchor: int) -> DataFrame:
    """``doc_id, window, start`` of all windows that hold a shared anchor."""
    kind = sql_type(flagged, "doc_id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for i, (raw, places) in enumerate(zip(*batch.columns[1:], strict=True)):
                hashes = known.of(raw.as_py().split())
                starts = near_starts(np.array(places.as_py()), len(hashes), window, anchor)
                found = window_hashes(hashes, window)[starts].astype(np.int64)
                for at in range(0, len(found), 1 << 18):
                    part = found[at:at + (1 << 18)]
                    yield batch_of({"window": pa.int64(), "start": pa.int32()},
                                   batch.column(0).take(pa.array(np.full(len(part), i))),
                                   [part, starts[at:at + (1 << 18)].astype(np.int32)])

    return flagged.select("doc_id", "text", "places").mapInArrow(work, f"doc_id {kind}, window bigint, start int")


def reference(flagged: DataFrame, firsts: DataFrame, window: int) -> DataFrame:
    """``doc_id, words, n``: the passages of the reference as hashes of words. Long ones are cut with an overlap of a
    window."""
    kind = sql_type(flagged, "doc_id")
    out = {"words": pa.binary(), "n": pa.int64()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            at, found = [], []
            for i, (raw, windows) in enumerate(zip(*batch.columns[1:], strict=True)):
                hashes = known.of(raw.as_py().split())
                starts = np.flatnonzero(np.isin(window_hashes(hashes, window).astype(np.int64), np.array(windows.as_py())))
                for begin, end in runs(covered(starts, window, len(hashes))):
                    for cut in range(begin, max(end - window + 1, begin + 1), SHARD_WORDS // 2):
                        part = hashes[cut:min(end, cut + SHARD_WORDS // 2 + window - 1)]
                        at.append(i)
                        found.append((part.tobytes(), len(part)))
            yield batch_of(out, batch.column(0).take(pa.array(at, pa.int32())),
                           list(zip(*found, strict=True)) or [[]] * len(out))

    rows = flagged.join(firsts, "doc_id").select("doc_id", "text", "windows")
    return rows.mapInArrow(work, f"doc_id {kind}, words binary, n bigint")


def stretches(flagged: DataFrame, routes: DataFrame, window: int) -> DataFrame:
    """``doc_id, shard, start, words, n``: each document's repeating windows, by the shard that has them."""
    kind = sql_type(flagged, "doc_id")
    out = {"shard": pa.int32(), "start": pa.int32(), "words": pa.binary(), "n": pa.int64()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            at, found = [], []
            for i, (raw, shards) in enumerate(zip(*batch.columns[1:], strict=True)):
                hashes = known.of(raw.as_py().split())
                for shard in shards.as_py():
                    starts = np.array(shard["starts"])
                    for begin, end in runs(covered(starts[starts <= len(hashes) - window], window, len(hashes))):
                        at.append(i)
                        found.append((shard["shard"], begin, hashes[begin:end].tobytes(), end - begin))
            yield batch_of(out, batch.column(0).take(pa.array(at, pa.int32())),
                           list(zip(*found, strict=True)) or [[]] * len(out))

    rows = flagged.drop("places").join(routes, "doc_id").select("doc_id", "text", "shards")
    return rows.mapInArrow(work, f"doc_id {kind}, shard int, start int, words binary, n bigint")


def matched(passages: DataFrame, texts: DataFrame, window: int) -> DataFrame:
    """``doc_id, start, stop`` of the maximal spans of ``texts`` that smaller documents of their shards hold."""
    kind = sql_type(texts, "doc_id")
    salts = texts.groupBy("shard").agg(F.ceil(F.sum("n") / CELL_WORDS).cast("int").alias("salts"))
    held = f"array<struct<doc:{kind},words:binary>>"
    # A shard is one row, so that sending it to many cells copies as few rows as there are cells.
    part0 = (passages.groupBy("shard").agg(F.collect_list(F.struct(F.col("doc_id").alias("doc"), "words")).alias("held"))
             .join(salts, "shard")
             .select("shard", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("part"),
                     F.lit(None).cast(kind).alias("doc_id"), F.lit(0).alias("start"), F.lit(None).cast("binary").alias("words"),
                     "held"))
    part1 = (texts.join(salts, "shard")
             .select("shard", F.pmod(F.xxhash64("doc_id", "start"), F.col("salts").cast("long")).cast("int").alias("salt"),
                     F.lit(1).alias("part"), "doc_id", "start", "words", F.lit(None).cast(held).alias("held")))
    cells = (part0.unionByName(part1).repartition(F.col("shard"), F.col("salt"))
             .sortWithinPartitions("shard", "salt", "part", "doc_id"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, automaton = None, None
        for batch in batches:
            docs, starts, stops = [], [], []
            for shard, salt, part, doc, start, words, held in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part == 0:
                    cell, automaton = (shard, salt), SuffixAutomaton(
                        [(x["doc"], np.frombuffer(x["words"], dtype=np.uint64).tolist()) for x in held])
                    continue
                if cell != (shard, salt):
                    continue  # no cell is without its shard
                words = np.frombuffer(words, dtype=np.uint64).tolist()
                for begin, end in automaton.spans(doc, words, window):
                    docs.append(doc)
                    starts.append(start + begin)
                    stops.append(start + end)
            yield pa.RecordBatch.from_arrays([pa.array(docs, batch.column(3).type), pa.array(starts, pa.int32()),
                                              pa.array(stops, pa.int32())], names=["doc_id", "start", "stop"])

    return cells.mapInArrow(work, f"doc_id {kind}, start int, stop int")


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                     anchor: int = ANCHOR) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_removed, kept_sha256, kept``. ``kept`` is what is left, its words
    joined by one space, where something was removed, and null where the text stays as it is."""
    rows, c = id_bytes(docs, id_col, text_col), F.col
    seen = as_table(scan(rows, window, anchor), "word-scan")
    same = seen.filter(f"doc_id IS NOT NULL AND n_words >= {window}").groupBy("words_key").agg(F.min("doc_id").alias("first"))
    base = as_table(seen.drop("places", "anchors").join(same, "words_key", "left")
                    .select("doc_id", "n_words", "whole_sha256", (c("doc_id") > c("first")).alias("copy")), "word-copies")
    own = same.select(c("first").alias("doc_id")).distinct()
    # One text of an id is enough: of repeated rows, or rows that repeat an id, each anchor counts once.
    placed = (seen.filter(f"n_words >= {window}").join(own, "doc_id", "left_semi")
              .select("doc_id", F.explode(F.arrays_zip("places", "anchors")).alias("x"))
              .select("doc_id", c("x.places").alias("place"), c("x.anchors").alias("anchor")))
    shared = (placed.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
              .filter("low < high").select("anchor"))
    placed = as_table(placed.join(shared, "anchor", "left_semi"), "shared-anchors")
    by_doc = as_table(placed.groupBy("doc_id").agg(F.collect_set("place").alias("places")), "flagged-places")
    flagged = as_table(rows.join(sent_if_small(by_doc, placed.count(), 4 * SENT_ROWS), "doc_id"), "flagged-texts")

    windows = window_rows(flagged, window, anchor)
    firsts = (windows.groupBy("window").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
              .filter("first < last").select("window", "first"))
    firsts = as_table(firsts, "repeating-windows")
    by_first = firsts.groupBy(c("first").alias("doc_id")).agg(F.collect_list("window").alias("windows"))
    passages = as_table(reference(flagged, by_first, window), "reference")
    n_shards = int((passages.agg(F.sum("n")).first()[0] or 0) // SHARD_WORDS + 1)
    shard = lambda doc: F.pmod(F.xxhash64(doc), F.lit(n_shards)).cast("int").alias("shard")
    # A repeating window has one first document and goes to that one's shard: no more rows than windows.
    routes = (windows.join(firsts, "window").filter("first < doc_id").groupBy("doc_id", shard("first"))
              .agg(F.collect_list("start").alias("starts"))
              .groupBy("doc_id").agg(F.collect_list(F.struct("shard", "starts")).alias("shards")))
    texts = as_table(stretches(flagged, routes, window), "stretches")
    spans = (matched(passages.select("doc_id", "words", shard("doc_id")), texts, window).groupBy("doc_id")
             .agg(F.collect_list(F.struct("start", "stop")).alias("spans")))
    cleaned = as_table(removed(flagged.drop("places").join(spans, "doc_id").select("doc_id", "text", "spans")), "cleaned")

    nothing = sha256(b"").hexdigest()
    return (base.join(cleaned, ["doc_id", "whole_sha256"], "left")
            .select("doc_id", "n_words",
                    F.when(c("copy"), c("n_words")).otherwise(F.coalesce("lost", F.lit(0))).cast("long").alias("n_removed"),
                    F.when(c("copy"), nothing).otherwise(F.coalesce("sha", "whole_sha256")).alias("kept_sha256"),
                    F.when(c("copy"), "").otherwise(c("kept")).alias("kept")))


def removed(rows: DataFrame) -> DataFrame:
    """``doc_id, whole_sha256, lost, sha, kept`` of texts with spans to remove."""
    out = {"whole_sha256": pa.string(), "lost": pa.int64(), "sha": pa.string(), "kept": pa.string()}

    def one(raw: bytes, spans: list[dict]) -> tuple:
        words = raw.split()
        gone = np.zeros(len(words) + 1, dtype=np.int64)
        for s in spans:
            gone[min(s["start"], len(words))] += 1
            gone[min(s["stop"], len(words))] -= 1
        gone = np.cumsum(gone[:-1]) > 0
        kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])
        return sha256(b" ".join(words)).hexdigest(), int(gone.sum()), sha256(kept).hexdigest(), kept.decode()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [one(raw.as_py(), spans.as_py()) for raw, spans in zip(*batch.columns[1:], strict=True)]
            yield batch_of(out, batch.column(0), list(zip(*found, strict=True)) or [[]] * len(out))

    return rows.mapInArrow(work, f"doc_id {sql_type(rows, 'doc_id')}, whole_sha256 string, lost bigint, sha string, "
                                 "kept string").dropDuplicates(["doc_id", "whole_sha256"])
