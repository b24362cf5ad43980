"""Toxicity by two Kneser-Ney models of word pairs, one of toxic and one of ordinary texts.

A text has two figures, both over its distinct pairs of words. One is the mean of its pairs' log-likelihood ratios of
the two models. In each class a pair's discounted count is filled up from the class's continuation counts (in how many
pairs a word comes second), and these in turn from the continuation counts of both classes together; discounts are
constants, the same for both classes. What a class happens to have more of, a language for one, moves all words of a
text a little and so this mean. The other figure, the peak, is half the log of the mean square of the ratios of the
second words' continuation shares: few words that are much likelier in one class decide it. A logistic curve of
both, fitted on other labelled texts, gives the score.

Words are lower-cased, without punctuation, and kept as 64-bit hashes, as are pairs. All labelled texts are counted
and both models are fitted by Spark, in tables that grow with the text; nothing is left out. What a pair adds to a
figure is a constant, plus what its first word, its second word and the pair itself add, each of them a row of one
table of weights. The ``CACHED`` weights that occur most often are sent to the tasks. If there are more, what a text has
of words and pairs outside them is joined with the rest of the table: the same figures, by a shuffle if the rest is large. A bitmap of the
rest's keys keeps most words and pairs that no table has out of that join. A key outside the
cache makes up at most one in ``CACHED`` of what was counted, so that none makes a large task.

Defined cases: an empty or null text has no pairs and gets the score of figures 0; without labelled texts of both
classes every score is 0; labels without a document, or null, are left out; rows that repeat an id are counted and
scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from fleetgauge.llm.common import TEXT_BATCH, WordHashes, as_table, id_bytes, in_fold, mixed, sent_if_small, shuffles_removed, sql_type

#: Weights that are sent to all tasks (32 bytes each); the others are joined by a shuffle.
CACHED = 500_000
#: Bits of the bitmap of the others' keys: 64 for each, up to so many (16 MB).
MOST_BITS = 1 << 27
#: Taken from every continuation count of a word, and from every count of a pair.
WORD_DISCOUNT, PAIR_DISCOUNT = 1.0, 4.0
#: Labelled texts that the curve is fitted on, as many as expected.
CURVE_DOCS = 4000
#: Labels of at most so many rows are sent to all tasks (16 bytes each); more are joined by a shuffle.
BROADCAST_LABELS = 500_000
THRESHOLD = 0.3
_PUNCTUATION = bytes(range(256)).translate(bytes.maketrans(b".,;:!?\"'()[]{}|", b" " * 15))


_FIRST = np.uint64(0x9E3779B97F4A7C15)


class WordPairs:
    """Pairs of neighbouring words of a text, as signed 64-bit hashes."""

    def __init__(self) -> None:
        self.known = WordHashes()

    def pairs(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every pair, its first word and its second one; 0 stands before the first word of a text."""
        second = self.known.of(raw.lower().translate(_PUNCTUATION).split())
        first = np.zeros_like(second)
        first[1:] = second[:-1]
        return pair_hashes(first, second), first.view(np.int64), second.view(np.int64)

    def distinct(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``pairs``, each pair once: a repeated line isn't heard again and again."""
        pair, first, second = self.pairs(raw)
        pair, at = np.unique(pair, return_index=True)
        return pair, first[at], second[at]


def pair_counts(labelled: DataFrame) -> DataFrame:
    """``first, second, n0, n1`` from ``text`` and ``toxic``: how often each pair of words occurs in either class. The hash
    of the pair follows from the other two (``with_pair``), and isn't shuffled."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held, size = WordPairs(), ([], []), 0

        def emit() -> Iterator[pa.RecordBatch]:
            for toxic in (0, 1):
                if held[toxic]:
                    pair, first, second = map(np.concatenate, zip(*held[toxic], strict=True))
                    pair, at, n = np.unique(pair, return_index=True, return_counts=True)
                    counts = [n, np.zeros_like(n)] if toxic == 0 else [np.zeros_like(n), n]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (first[at], second[at], *counts)],
                                                     names=["first", "second", "n0", "n1"])

        for batch in batches:
            for raw, toxic in zip(*batch.columns, strict=True):
                found = words.pairs(raw.as_py())
                held[toxic.as_py()].append(found)
                size += len(found[0])
                if size > 1_000_000:
                    yield from emit()
                    held, size = ([], []), 0
        if size:
            yield from emit()

    rows = labelled.select(F.col("text").cast("binary"), "toxic").mapInArrow(
        count, "first bigint, second bigint, n0 bigint, n1 bigint")
    return rows.groupBy("first", "second").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A hash of each pair, from those of its words."""
    return mixed(mixed(first.view(np.uint64) + _FIRST) + second.view(np.uint64)).view(np.int64)


def with_pair(rows: DataFrame) -> DataFrame:
    """``rows`` with the hash ``pair`` of ``first`` and ``second``."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("first", "second"))
            yield batch.append_column("pair", pa.array(pair_hashes(first, second)))

    return rows.mapInArrow(add, StructType([*rows.schema.fields, StructField("pair", LongType())]))


@dataclass
class Model:
    """``keys`` (sorted), ``ahead``, ``behind`` and ``square`` are the cached weights: what a word adds to the pairs that it
    comes first in, what a word adds to those that it comes second in, or a pair to itself, and what a second word adds to
    the squares. ``rest`` is the table of the others, or None without any, ``maybe`` the bitmap of its keys; ``base`` and
    ``base_square`` are what every pair has. ``slopes`` are those of the figure and the peak."""

    base: float
    base_square: float
    keys: np.ndarray
    ahead: np.ndarray
    behind: np.ndarray
    square: np.ndarray
    rest: DataFrame | None
    maybe: np.ndarray | None
    slopes: tuple[float, float] = (1.0, 0.0)
    shift: float = 0.0


def found_in(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted keys that there are, and which these are."""
    if not len(keys):
        return np.zeros(0, dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    known = keys[at] == wanted
    return at[known], known


def bitmap_of(table: DataFrame, n: int) -> np.ndarray:
    """A bitmap of the column ``key`` of ``n`` rows, put together by Spark in blocks of 4 KB."""
    size = min(MOST_BITS, 1 << max(15, (64 * n).bit_length()))
    place = F.pmod("key", F.lit(size))
    blocks = (table.groupBy(F.shiftright(place, 15).cast("int").alias("block"))
              .agg(F.bitmap_construct_agg(place.bitwiseAND(F.lit((1 << 15) - 1))).alias("bits")).collect())
    held = np.zeros(size >> 3, dtype=np.uint8)
    for block, bits in blocks:
        held[block << 12:(block + 1) << 12] = np.frombuffer(bits, dtype=np.uint8)
    return held


def may_hold(held: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the keys the bitmap doesn't rule out."""
    place = keys & np.int64(8 * len(held) - 1)
    return (held[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def weights_of(both: DataFrame) -> tuple[float, float, DataFrame] | None:
    """From the table of pair counts: what every pair has, itself and squared, and ``key, ahead, behind, square, n`` of all
    that adds to it."""
    number = lambda c: (F.col(f"n{c}") > 0).cast("int")
    words = as_table(both.groupBy("second").agg(*(F.sum(number(c)).alias(f"k{c}") for c in (0, 1)),
                                                F.sum(F.col("n0") + F.col("n1")).alias("n")), "words")
    sums = words.agg(*(F.coalesce(F.sum(f"k{c}"), F.lit(0)).alias(f"k{c}") for c in (0, 1)), F.count("*").alias("v")).first()
    if not sums["k0"] or not sums["k1"]:
        return None
    own = [float(sums["k0"]), float(sums["k1"])]
    # One more for each word, and one for all unknown words.
    words = words.withColumn("shared", (F.col("k0") + F.col("k1") + 1) / F.lit(sum(own) + sums["v"] + 1))
    words = words.withColumns({f"x{c}": F.greatest(F.col(f"k{c}") - WORD_DISCOUNT, F.lit(0.0)) for c in (0, 1)})
    kept = words.agg(*(F.sum(f"x{c}").alias(f"x{c}") for c in (0, 1))).first()
    left = [1 - kept[f"x{c}"] / own[c] for c in (0, 1)]
    base = float(np.log(left[1]) - np.log(left[0]))  # of a word with nothing of its own in either class, known or not
    base_square = float(np.exp(2 * base))
    words = words.withColumns({f"word{c}": F.col(f"x{c}") / own[c] + F.lit(left[c]) * F.col("shared") for c in (0, 1)})
    some, ratio = (F.col("x0") > 0) | (F.col("x1") > 0), F.col("word1") / F.col("word0")
    words = words.select("second", "word0", "word1", F.when(some, F.log(ratio) - base).otherwise(0.0).alias("behind"),
                         F.when(some, ratio * ratio - base_square).otherwise(0.0).alias("square"), F.col("n").alias("n_word"))

    totals = both.groupBy("first").agg(F.sum("n0").alias("t0"), F.sum("n1").alias("t1"))
    over = {f"p{c}": F.greatest(F.col(f"n{c}") - PAIR_DISCOUNT, F.lit(0.0)) / F.greatest(F.col(f"t{c}"), F.lit(1)) for c in (0, 1)}
    # A pair that keeps anything occurs more often than the discount; the others needn't meet the totals.
    keeping = as_table(with_pair(both.filter(f"greatest(n0, n1) > {PAIR_DISCOUNT}").join(totals, "first").withColumns(over)),
                       "keeping-pairs")
    firsts = keeping.groupBy("first").agg(*(F.greatest(1 - F.sum(f"p{c}"), F.lit(1e-3)).alias(f"w{c}") for c in (0, 1)),
                                          F.max(F.col("t0") + F.col("t1")).alias("n_first"))
    firsts = firsts.withColumn("ahead", F.log("w1") - F.log("w0"))
    like = [F.log(F.col(f"p{c}") + F.col(f"w{c}") * F.col(f"word{c}")) for c in (0, 1)]
    zero = F.lit(0.0)
    pairs = keeping.join(firsts, "first").join(words, "second").select(
        F.col("pair").alias("key"), zero.alias("ahead"),
        (like[1] - like[0] - F.col("ahead") - base - F.col("behind")).alias("behind"), zero.alias("square"),
        (F.col("n0") + F.col("n1")).alias("n"))
    singles = (words.filter("behind != 0 OR square != 0")
               .select(F.col("second").alias("key"), zero.alias("ahead"), "behind", "square", F.col("n_word").alias("n"))
               .unionByName(firsts.select(F.col("first").alias("key"), "ahead", zero.alias("behind"), zero.alias("square"),
                                          F.col("n_first").alias("n")))
               .groupBy("key").agg(*(F.sum(c).alias(c) for c in ("ahead", "behind", "square")), F.max("n").alias("n")))
    return base, base_square, as_table(singles.unionByName(pairs), "weights")


def fit_models(counts: DataFrame, cached: int = CACHED) -> Model | None:
    """Both models from the table of pair counts, as the differences that scoring needs."""
    fitted = weights_of(counts)
    if fitted is None:
        return None
    base, base_square, weights = fitted
    hot, rest, maybe = weights, None, None
    if (n := weights.count()) > cached:
        hot = as_table(weights.orderBy(F.desc("n"), "key").limit(cached), "cached-weights")
        last = hot.orderBy("n", F.desc("key")).first()  # what comes behind it is the rest, without a join
        behind = F.lit(True) if last is None else (F.col("n") < last["n"]) | ((F.col("n") == last["n"]) & (F.col("key") > last["key"]))
        rest = as_table(weights.filter(behind), "other-weights")
        maybe = bitmap_of(rest, n - cached)
    hot = hot.select("key", "ahead", "behind", "square").toArrow()  # no row objects: the driver holds 32 bytes a weight
    order = np.argsort(hot.column("key").to_numpy())
    hot = [hot.column(c).to_numpy()[order] for c in ("key", "ahead", "behind", "square")]
    return Model(base, base_square, *hot, rest, maybe)


def labelled_texts(docs: DataFrame, labels: DataFrame, fold: Column, id_col: str, text_col: str,
                   label_col: str) -> DataFrame:
    """``doc_id, text, toxic`` of the labelled rows in ``fold`` of the labels' ids."""
    own = (labels.select(labels[id_col].alias("doc_id"), labels[label_col].cast("int").alias("toxic"))
           .filter(F.col("toxic").isin(0, 1) & fold).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    if labels.select(id_col).count() <= BROADCAST_LABELS:
        own = F.broadcast(own)
    return id_bytes(docs, id_col, text_col).join(own, "doc_id")


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", curve_docs: int = CURVE_DOCS, cached: int = CACHED) -> Model | None:
    """Both models from folds 0 and 1 of the labelled texts, the curve from fold 3; fold 2 is never read."""
    with shuffles_removed(docs.sparkSession, TEXT_BATCH):
        counts = as_table(pair_counts(labelled_texts(
            docs, labels, in_fold("doc_id", 0) | in_fold("doc_id", 1), id_col, text_col, label_col)), "pair-counts")
        model = fit_models(counts, cached)
    if model is None:
        return None
    n = labels.filter(in_fold(labels[id_col], 3)).select(id_col).count()
    share = min(1.0, curve_docs / max(1, n))
    some = in_fold("doc_id", 3) & (F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = labelled_texts(docs, labels, some, id_col, text_col, label_col)
    found = with_figures(sample, model, "toxic").select("toxic", "figure", "peak").toPandas()
    return fit_curve(model, found[["figure", "peak"]].to_numpy(), found["toxic"].to_numpy(dtype=float))


def fit_curve(model: Model, figures: np.ndarray, toxic: np.ndarray) -> Model:
    """Newton's method for the logistic curve of both figures, with a small ridge."""
    if len(set(toxic)) < 2:
        return model
    figures = np.clip(figures, *np.percentile(figures, [1, 99], axis=0))  # a few odd texts would bend the curve
    middle, spread = figures.mean(axis=0), figures.std(axis=0)
    spread = np.where(spread > 0, spread, 1.0)
    x = np.column_stack([(figures - middle) / spread, np.ones(len(figures))])
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (toxic - p) - 0.01 * w
        w = w + np.clip(np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(3), slope), -2, 2)
    slopes = w[:2] / spread
    model.slopes, model.shift = tuple(slopes.tolist()), float(w[2] - slopes @ middle)
    return model


def with_figures(rows: DataFrame, model: Model | None, *columns: str) -> DataFrame:
    """``doc_id``, whole-number ``columns``, ``figure`` and ``peak``, over a text's distinct pairs, of rows with ``text``."""
    if model is None:
        return rows.select("doc_id", *columns, F.lit(0.0).alias("figure"), F.lit(0.0).alias("peak"))
    shared = rows.sparkSession.sparkContext.broadcast(
        (model.base, model.base_square, model.keys, model.ahead, model.behind, model.square, model.maybe))
    whole = model.rest is None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, (base, base_square, keys, ahead, behind, square, maybe) = WordPairs(), shared.value
        at = TaskContext.get().partitionId() << 40
        for batch in batches:
            size, known, squares, others = [], [], [], []
            for raw in batch.column(1):
                pair, first, second = words.distinct(raw.as_py())
                a, has_first = found_in(keys, first)
                b, has_second = found_in(keys, second)
                c, has_pair = found_in(keys, pair)
                size.append(len(pair))
                known.append(float(base * len(pair) + ahead[a].sum() + behind[b].sum() + behind[c].sum()))
                squares.append(float(base_square * len(pair) + square[b].sum()))
                left = [] if whole else [x[~has] for x, has in ((first, has_first), (second, has_second), (pair, has_pair))]
                others.append([] if whole else [
                    {"key": k, "firsts": x, "seconds": y} for k, x, y in uses(*(x[may_hold(maybe, x)] for x in left))])
            n = len(size)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(batch.column(2 + i).cast(pa.int64()) for i in range(len(columns))),
                 pa.array(range(at, at + n), pa.int64()), pa.array(size, pa.int64()), pa.array(known, pa.float64()),
                 pa.array(squares, pa.float64()), pa.array(others, USES)],
                names=["doc_id", *columns, "row", "size", "known", "squares", "others"])
            at += n

    found = rows.select("doc_id", "text", *columns).mapInArrow(
        work, f"doc_id {sql_type(rows, 'doc_id')}, " + "".join(f"{c} bigint, " for c in columns)
        + "row bigint, size bigint, known double, squares double, "
        "others array<struct<key:bigint,firsts:bigint,seconds:bigint>>")
    total, squares = F.col("known"), F.col("squares")
    if not whole:
        found = as_table(found, "text-figures")
        added = (found.select("row", F.explode("others").alias("x")).select("row", "x.*").join(sent_if_small(model.rest), "key")
                 .groupBy("row").agg(F.sum(F.col("firsts") * F.col("ahead") + F.col("seconds") * F.col("behind")).alias("added"),
                                     F.sum(F.col("seconds") * F.col("square")).alias("added_squares")))
        found = found.drop("others").join(added, "row", "left")
        total = total + F.coalesce("added", F.lit(0.0))
        squares = squares + F.coalesce("added_squares", F.lit(0.0))
    peak = F.log(F.greatest(squares / F.col("size"), F.lit(1e-12))) / 2
    return found.select("doc_id", *columns, *(F.when(F.col("size") > 0, x).otherwise(0.0).alias(name)
                                              for name, x in (("figure", total / F.col("size")), ("peak", peak))))


USES = pa.list_(pa.struct([("key", pa.int64()), ("firsts", pa.int64()), ("seconds", pa.int64())]))


def uses(first: np.ndarray, second: np.ndarray, pair: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Every key once, with the number of distinct pairs that it is first in and that it is second in, or is."""
    keys, at = np.unique(np.concatenate([first, second, pair]), return_inverse=True)
    firsts = np.bincount(at[:len(first)], minlength=len(keys))
    seconds = np.bincount(at[len(first):], minlength=len(keys))
    return zip(keys.tolist(), firsts.tolist(), seconds.tolist(), strict=True)


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, score, predicted, figure, peak``."""
    found = with_figures(id_bytes(docs, id_col, text_col), model)
    score = F.lit(0.0)
    if model is not None:
        bent = F.lit(model.slopes[0]) * F.col("figure") + F.lit(model.slopes[1]) * F.col("peak") + model.shift
        score = 1 / (1 + F.exp(-F.greatest(F.least(bent, F.lit(30.0)), F.lit(-30.0))))
    found = found.withColumn("score", score)
    return found.select("doc_id", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "figure", "peak")
