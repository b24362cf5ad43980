"""Documents linked by the Jaccard similarity of their sets of word shingles, as classes of linked documents.

Sets that are equal share one answer. Of the others, only a prefix is indexed: in an order in which rare shingles come
first, two sets that link share one of the first ``n - ceil(t n) + 1``. An index list holds the sets with a shingle in
their prefix, with size and position; by these two a pair is out of reach if too few shingles can follow.

The relation of sets is used twice. First, each list's head, the set in which the shingle stands first, answers
for the list: only pairs with it are verified. What links to it has its class. Second, sets of a list that stayed
outside that class meet the list's other classes. They skip whole blocks of positions that are out of reach, and the
sets whose overlap with the head, known from the first step, rules them out: ``|s & x| <= |s & h| + |x| - |x & h|``.
So every pair in reach is verified, or lies in one class already, or is ruled out.

The order of shingles comes from counts over all documents in ``2**COUNT_BITS`` hashed places; any order gives the same
links. Shingles are 64-bit hashes. Verification compares whole sets, made again from the texts.

Defined cases: a text without words, or null, has an empty set and links with nothing; one with fewer words than a
shingle is one shingle; a row without an id is a class of its own; repeated rows are
one document; rows that repeat an id with other texts link if any of its texts does; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.llm.common import (
    TEXT_BATCH,
    WordHashes,
    as_table,
    batch_of,
    id_bytes,
    mixed,
    sent_if_small,
    shuffles_removed,
    sql_type,
    window_hashes,
)
from fleetgauge.llm.components import components
from fleetgauge.llm.exact_copies import keep_ids

COUNT_BITS = 18
COUNT_BLOCKS = 16
SKETCH = 128
#: Positions in a block of an index list, and texts that are verified against one other in a task at a time.
BLOCK = 4
CELL = 64


def shingle_set(raw: bytes, known: WordHashes, width: int) -> np.ndarray:
    """The set's hashes in order; A-Z are lower-cased, as ``bytes.lower`` does it."""
    hashes = known.of(raw.lower().split())
    if not len(hashes):
        return hashes
    if len(hashes) < width:
        return mixed(window_hashes(hashes, len(hashes)) + np.uint64(len(hashes)))
    return np.unique(window_hashes(hashes, width))


def sketch_of(own: np.ndarray) -> np.ndarray:
    """How many shingles fall into each of ``SKETCH`` places, up to 255. Two sketches differ by no more than their
    sets do."""
    return np.minimum(np.bincount((own & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH), 255).astype(np.int16)


def need(a: Column, b: Column, percent: int) -> Column:
    """Shingles that sets of these sizes must share."""
    return F.ceil((a + b) * percent / (100 + percent) - 1e-9)


def scan_sets(docs: DataFrame, width: int) -> tuple[DataFrame, np.ndarray]:
    """``doc_id, n, set_key`` of every document, and how often shingles fall into each place, over all of them."""
    kind, step = sql_type(docs, "doc_id"), (1 << COUNT_BITS) // COUNT_BLOCKS

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, ids = WordHashes(), np.zeros(1 << COUNT_BITS, dtype=np.int64), None
        for batch in batches:
            ids, n, keys = batch.column(0), [], []
            for raw in batch.column(1):
                own = shingle_set(raw.as_py(), known, width)
                counts += 0 if not len(own) else np.bincount((own >> np.uint64(64 - COUNT_BITS)).astype(np.int64),
                                                             minlength=1 << COUNT_BITS)
                n.append(len(own))
                keys.append(blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
            empty = [None] * len(n)
            yield batch_of(columns, ids, [n, keys, empty, empty])
        if ids is not None:
            yield batch_of(columns, pa.nulls(COUNT_BLOCKS, ids.type), [
                [None] * COUNT_BLOCKS, [None] * COUNT_BLOCKS, range(COUNT_BLOCKS),
                [counts[i * step:(i + 1) * step].tobytes() for i in range(COUNT_BLOCKS)]])

    columns = {"n": pa.int64(), "set_key": pa.binary(), "block": pa.int32(), "counts": pa.binary()}
    found = as_table(docs.mapInArrow(work, f"doc_id {kind}, n bigint, set_key binary, block int, counts binary"), "sets")

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, dtype=np.int64) for x in rows["counts"])
        return pd.DataFrame({"block": [key[0]], "counts": [total.tobytes()]})

    # Added up in two steps, so that no group grows with the number of tasks faster than by its square root.
    parts = found.filter("block IS NOT NULL").select("block", "counts", F.pmod(F.xxhash64("counts"), F.lit(64)).alias("part"))
    parts = parts.groupBy("block", "part").applyInPandas(add, "block int, counts binary")
    blocks = parts.groupBy("block").applyInPandas(add, "block int, counts binary").toPandas().sort_values("block")
    counts = np.frombuffer(b"".join(blocks["counts"]), dtype=np.int64) if len(blocks) else np.zeros(1 << COUNT_BITS, dtype=np.int64)
    return found.filter("block IS NULL").select("doc_id", "n", "set_key"), counts


def prefixes(docs: DataFrame, counts: np.ndarray, width: int, percent: int) -> DataFrame:
    """``doc_id, n, sketch, prefix``: the shingles of the prefix, rare ones first."""
    kind = sql_type(docs, "doc_id")
    shared = docs.sparkSession.sparkContext.broadcast(counts)  # 2 MB, whatever the number of documents
    columns = {"n": pa.int64(), "sketch": pa.list_(pa.int16()), "prefix": pa.list_(pa.int64())}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, often = WordHashes(), shared.value
        for batch in batches:
            out = []
            for raw in batch.column(1):
                own = shingle_set(raw.as_py(), known, width)
                n = len(own)
                order = np.lexsort((own, often[(own >> np.uint64(64 - COUNT_BITS)).astype(np.int64)]))
                out.append((n, sketch_of(own), own[order[:n - -(-percent * n // 100) + 1]].astype(np.int64)))
            yield batch_of(columns, batch.column(0), list(zip(*out, strict=True)) or [[], [], []])

    return docs.mapInArrow(work, f"doc_id {kind}, n bigint, sketch array<smallint>, prefix array<bigint>").filter("n > 0")


def verified(pairs: DataFrame, docs: DataFrame, sketches: DataFrame, width: int, percent: int) -> DataFrame:
    """``a, b, most, overlap`` of the pairs (``a, b``): the overlap of those that link or come close, and for all of
    them the most that it can be by their sketches, which rule out the others before any text is moved. A text ``a`` with many others is sent to several cells, each with some of the others; a task holds
    one set at a time and reads the others as they come."""
    kind = sql_type(docs, "doc_id")
    apart = F.aggregate(F.zip_with("x", "y", lambda x, y: F.abs(x - y).cast("int")), F.lit(0), lambda s, x: s + x)
    left = sketches.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("x"))
    right = sketches.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("y"))
    pairs = as_table(
        pairs.select("a", "b").join(left, "a").join(right, "b")
        .withColumn("most", F.floor((F.col("na") + F.col("nb") - apart) / 2))
        .select("a", "b", "most", (F.col("most") >= need(F.col("na"), F.col("nb"), percent)).alias("near")), "pairs")
    near = pairs.filter("near").select("a", "b")
    # Few texts are in a pair: they are picked out once, where possible without moving the others.
    ids = as_table(near.select(F.col("a").alias("doc_id")).unionByName(near.select(F.col("b").alias("doc_id")))
                   .distinct(), "near-ids")
    docs = as_table(docs.join(sent_if_small(ids), "doc_id", "left_semi"), "near-texts")
    cells = near.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / CELL).cast("int").alias("salts"))
    heads = (docs.join(cells, docs["doc_id"] == cells["a"])
             .select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
                     F.lit(None).cast(kind).alias("b"), "text"))
    others = (near.join(cells, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts").cast("long")).cast("int"))
              .join(docs, F.col("b") == docs["doc_id"]).select("a", "salt", "b", "text"))
    dealt = (heads.unionByName(others).repartition(F.col("a"), F.col("salt"))
             .sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, cell, head = WordHashes(), None, None
        for batch in batches:
            a, b, overlap = [], [], []
            for x, salt, y, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = shingle_set(text, known, width)
                if y is None:
                    cell, head = (x, salt), own
                elif cell == (x, salt):
                    a.append(x)
                    b.append(y)
                    overlap.append(len(np.intersect1d(head, own, assume_unique=True)))
            yield pa.RecordBatch.from_arrays([pa.array(a, batch.column(0).type), pa.array(b, batch.column(0).type),
                                              pa.array(overlap, pa.int64())], names=["a", "b", "overlap"])

    found = dealt.mapInArrow(work, f"a {kind}, b {kind}, overlap bigint")
    return as_table(pairs.drop("near").join(found, ["a", "b"], "left"), "verified")


def index_lists(own: DataFrame) -> DataFrame:
    """``id, n, pos, token, head, head_n, head_pos`` of every shingle that stands in two prefixes or more: the list of a
    shingle and its head, found in one pass over the list, so that the prefixes are shuffled once."""
    postings = own.select(F.col("doc_id").alias("id"), "n", F.posexplode("prefix").alias("pos", "token"))
    along = Window.partitionBy("token").orderBy("pos", "id", "n")
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    head = {"head": "id", "head_n": "n", "head_pos": "pos"}
    alone = (F.row_number().over(along) == 1) & F.lead("token").over(along).isNull()
    found = postings.withColumns({name: F.first(c).over(so_far) for name, c in head.items()} | {"alone": alone})
    return found.filter(~F.col("alone")).drop("alone")


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                    percent: int = 90) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id``. Sets link when they share at least
    ``percent`` of a hundred shingles of their union; a component is named by its smallest id."""
    rows = id_bytes(docs, id_col, text_col)
    with shuffles_removed(docs.sparkSession, TEXT_BATCH):
        sets, equal, final = classes_of_sets(rows, width, percent)
    c = F.col
    answer = equal.join(final, c("rep") == c("id"), "left").select("set_key", F.coalesce("component", "rep").alias("component"))
    named = sets.filter("doc_id IS NOT NULL AND n > 0").join(answer, "set_key").select("doc_id", "n", "component")
    alone = sets.filter("doc_id IS NULL OR n = 0").select("doc_id", "n", c("doc_id").alias("component"))
    return named.unionByName(alone).select("doc_id", c("n").alias("n_shingles"), c("component").alias("component_id"))


def classes_of_sets(rows: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three written tables: ``doc_id, n, set_key`` of every row, ``set_key, rep`` of every set, and ``id, component`` of
    the sets that link with others."""
    sets, counts = scan_sets(rows, width)
    known = sets.filter("doc_id IS NOT NULL AND n > 0")
    equal = as_table(known.groupBy("set_key").agg(F.min("doc_id").alias("rep")), "equal-sets")
    reps = equal.select(F.col("rep").alias("doc_id")).distinct()
    own = as_table(prefixes(rows, counts, width, percent).join(sent_if_small(reps, equal.count()), "doc_id", "left_semi"),
                   "prefixes")
    listed = as_table(index_lists(own), "index-lists")
    sketches = own.select("doc_id", "n", "sketch")

    def reach(n1, p1, n2, p2) -> Column:
        """Whether enough shingles can follow, this one included, for sets of sizes in reach of one another."""
        return F.least(n1 - p1, n2 - p2) >= need(n1, n2, percent)

    c = F.col
    with_head = (listed.filter((c("id") != c("head")) & reach(c("n"), c("pos"), c("head_n"), c("head_pos")))
                 .select(c("head").alias("a"), c("id").alias("b")).distinct())
    first = verified(with_head, rows, sketches, width, percent)
    sizes = own.select("doc_id", "n")
    links = as_table(linked(first, sizes, percent), "links-first")
    classes = components(links)

    # Of lists that hold several classes, those outside the head's class against the rest.
    member = classes.select("id", c("component").alias("own_class"))
    head_class = classes.select(c("id").alias("head"), c("component").alias("head_class"))
    listed = (listed.join(member, "id", "left").join(head_class, "head", "left")
              .withColumns({"own_class": F.coalesce("own_class", "id"), "head_class": F.coalesce("head_class", "head")}))
    strays = listed.filter("own_class != head_class")
    mixed_lists = strays.select("token").distinct()
    overlaps = first.select(c("a").alias("head"), c("b").alias("id"), "overlap", "most")
    listed = as_table(listed.join(mixed_lists, "token", "left_semi").join(overlaps, ["head", "id"], "left")
                      .withColumn("block", F.floor(c("pos") / BLOCK)), "mixed-lists")
    least = F.coalesce("overlap", F.when(c("id") == c("head"), c("n")).otherwise(0))
    blocks = listed.groupBy("token", "block").agg(F.min("n").alias("n_least"), F.max("n").alias("n_most"))
    stray = listed.filter("own_class != head_class").select(
        "token", c("id").alias("s"), c("n").alias("sn"), c("pos").alias("sp"), c("own_class").alias("s_class"), "head_class",
        F.coalesce("overlap", "most", "n").alias("s_most"))
    # A block is out of reach if even its first position leaves too few, or its sizes are all too far away.
    near_blocks = stray.join(blocks, "token").filter(
        (F.least(c("sn") - c("sp"), c("n_most") - c("block") * BLOCK)
         >= need(c("sn"), F.greatest(c("n_least"), F.ceil(c("sn") * percent / 100)), percent))
        & (c("n_most") * 100 >= c("sn") * percent) & (c("sn") * 100 >= c("n_least") * percent))
    members = listed.select("token", "block", "id", "n", "pos", "own_class", least.alias("least"))
    rest = (near_blocks.drop("n_least", "n_most").join(members, ["token", "block"]).filter(
        (c("own_class") != c("s_class")) & ((c("own_class") == c("head_class")) | (c("s") < c("id")))
        & reach(c("n"), c("pos"), c("sn"), c("sp"))
        & (c("s_most") + c("n") - c("least") >= need(c("n"), c("sn"), percent)))
        .select(F.least("s", "id").alias("a"), F.greatest("s", "id").alias("b")).distinct())
    second = verified(rest, rows, sketches, width, percent)
    more = linked(second, sizes, percent)
    stars = classes.filter("id != component").select(c("id").alias("a"), c("component").alias("b"))
    return sets, equal, components(stars.unionByName(more))


def linked(found: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """The verified pairs that link."""
    na = sizes.select(F.col("doc_id").alias("a"), F.col("n").alias("na"))
    nb = sizes.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"))
    union = F.col("na") + F.col("nb") - F.col("overlap")
    return found.join(na, "a").join(nb, "b").filter(100 * F.col("overlap") >= percent * union).select("a", "b")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                percent: int = 90) -> DataFrame:
    """The rows of ``docs`` without those of other ids than the smallest of their class, all columns."""
    found = jaccard_classes(docs, id_col, text_col, width, percent)
    return keep_ids(docs, found.filter("doc_id = component_id"), id_col, text_col)
