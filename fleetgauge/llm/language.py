"""Language of a text by a convolutional network over its bytes, trained here in numpy.

Bytes are embedded; filters of several widths run over windows of fixed length; each filter's largest response in a
window goes to a softmax over the languages. A text's probabilities are those of its windows, weighted by their
bytes. All windows of a text count.

For prediction, embedding and filters are multiplied out into tables over single bytes and pairs of bytes, so that
a filter's response is a sum of one or two rows looked up.

Defined cases: a text that is null or without a letter is ``und`` with score 0, and so is every text if nothing could
be learned; null languages are not learned; rows are never compared, so null ids, ties and repeated rows need no rule.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.common import SLICE_BYTES, batch_of, id_bytes, slices, sql_type

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDED = 8
#: Labelled texts to learn from, as many as expected, and code points of each.
SAMPLE_DOCS = 3000
SAMPLE_CHARS = 1024
EPOCHS = 4
BATCH = 64
UNKNOWN = "und"
#: A text whose best language is less likely is rejected by ``keep_known``.
MIN_SCORE = 0.3
LETTER = regex.compile(r"\p{L}")


@dataclass
class Net:
    languages: list[str]
    embedding: np.ndarray  # byte, dimension
    filters: list[np.ndarray]  # for each width: place, dimension, filter
    offsets: list[np.ndarray]
    dense: np.ndarray
    bias: np.ndarray

    def tables(self) -> list[list[np.ndarray]]:
        """For each width: rows by pair of bytes, then by single byte for an odd width; offsets are in the first."""
        out = []
        for weights, offset in zip(self.filters, self.offsets, strict=True):
            rows = [self.embedding @ w for w in weights]
            parts = [(rows[i][:, None] + rows[i + 1][None]).reshape(65536, -1) for i in range(0, len(rows) - 1, 2)]
            parts += [rows[-1]] * (len(rows) % 2)
            parts[0] = parts[0] + offset
            out.append([p.astype(np.float32) for p in parts])
        return out

    def probabilities(self, windows: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        single = windows.astype(np.intp)
        pairs = single[:, :-1] << 8 | single[:, 1:]
        pooled = []
        for width, parts in zip(WIDTHS, tables, strict=True):
            n = windows.shape[1] - width + 1
            response = parts[0][pairs[:, :n]]
            for k, part in enumerate(parts[1:], 1):
                response += part[(pairs if len(part) > 256 else single)[:, 2 * k:2 * k + n]]
            pooled.append(response.max(axis=1))
        return softmax(np.maximum(np.concatenate(pooled, axis=1), 0) @ self.dense + self.bias)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def windows_of(raw: bytes, window: int = WINDOW) -> np.ndarray:
    """The bytes in rows of ``window``, the last one filled up with zeros."""
    rows = -(-len(raw) // window)
    return np.frombuffer(raw.ljust(rows * window, b"\0"), dtype=np.uint8).reshape(rows, window)


def train(texts: list[bytes], labels: list[str], seed: int = 7) -> Net | None:
    """Adam on the cross-entropy, every language with the same weight."""
    found = [(windows_of(t), label) for t, label in zip(texts, labels, strict=True) if t]
    if not found:
        return None
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    x = np.concatenate([w for w, _ in found])
    y = np.concatenate([np.full(len(w), languages.index(label)) for w, label in found])
    weight = 1 / np.maximum(np.bincount(y, minlength=len(languages)), 1)
    weight = weight / weight[y].mean()
    net = Net(languages, rng.normal(0, 0.5, (256, EMBEDDED)),
              [rng.normal(0, (w * EMBEDDED) ** -0.5, (w, EMBEDDED, FILTERS)) for w in WIDTHS],
              [np.zeros(FILTERS) for _ in WIDTHS],
              rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))), np.zeros(len(languages)))
    params = [net.embedding, *net.filters, *net.offsets, net.dense, net.bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH):
            rows = order[at:at + BATCH]
            step += 1
            for i, (p, g) in enumerate(zip(params, gradients(net, x[rows], y[rows], weight), strict=True)):
                first[i] += 0.1 * (g - first[i])
                second[i] += 0.001 * (g * g - second[i])
                p -= 0.004 * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    return net


def gradients(net: Net, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    n, embedded = len(x), net.embedding[x]
    pooled, places = [], []
    for width, weights, offset in zip(WIDTHS, net.filters, net.offsets, strict=True):
        last = x.shape[1] - width + 1
        response = sum(embedded[:, j:j + last] @ weights[j] for j in range(width)) + offset
        places.append(response.argmax(axis=1))
        pooled.append(response.max(axis=1))
    hidden = np.maximum(np.concatenate(pooled, axis=1), 0)
    wrong = softmax(hidden @ net.dense + net.bias)
    wrong[np.arange(n), y] -= 1
    wrong *= (weight[y] / n)[:, None]
    back = (wrong @ net.dense.T) * (hidden > 0)
    to_embedding = np.zeros_like(net.embedding)
    to_filters, to_offsets = [], []
    for k, (width, weights) in enumerate(zip(WIDTHS, net.filters, strict=True)):
        own = back[:, k * FILTERS:(k + 1) * FILTERS]  # only the largest response passes anything back
        grown = np.zeros_like(weights)
        for j in range(width):
            at = places[k] + j
            grown[j] = np.einsum("bfe,bf->ef", embedded[np.arange(n)[:, None], at], own)
            np.add.at(to_embedding, x[np.arange(n)[:, None], at], own[:, :, None] * weights[j].T[None])
        to_filters.append(grown)
        to_offsets.append(own.sum(axis=0))
    return [to_embedding, *to_filters, *to_offsets, hidden.T @ wrong, wrong.sum(axis=0)]


def learn(docs: DataFrame, learnable: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS) -> Net | None:
    """A network from the labelled rows for which ``learnable`` holds: all of them, or as many as make
    ``sample_docs`` expected ones, chosen by a hash of the id; of each a stretch of ``SAMPLE_CHARS`` code points. Rows that
    share an id are chosen together; there are never more than twice ``sample_docs``."""
    sample = sample_of(docs, learnable, id_col, text_col, lang_col, sample_docs).toPandas().sort_values(["lang", "text"])
    return train([bytes(t) for t in sample["text"]], sample["lang"].tolist())


def sample_of(docs: DataFrame, learnable: Column | None, id_col: str, text_col: str, lang_col: str, sample_docs: int) -> DataFrame:
    """``lang, text`` of the rows to learn from, at most ``2 * sample_docs``."""
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), docs[lang_col].alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    if learnable is not None:
        rows = rows.filter(learnable)
    share = min(1.0, sample_docs / max(1, rows.select("doc_id").count()))
    mark = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30))
    free = F.greatest(F.length("text") - SAMPLE_CHARS + 1, F.lit(1))
    begin = (F.pmod(F.xxhash64("doc_id", F.lit(12)), free) + 1).cast("int")
    return (rows.filter(mark < int(share * (1 << 30)))
            .select("lang", F.substring("text", begin, F.lit(SAMPLE_CHARS)).cast("binary").alias("text"), mark.alias("mark"))
            .orderBy("mark", "lang", "text").limit(2 * sample_docs).select("lang", "text"))


def predict(docs: DataFrame, net: Net | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, lang_pred, score``."""
    rows = id_bytes(docs, id_col, text_col)
    out = {"lang_pred": pa.string(), "score": pa.float64()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.tables() if net else None
        for batch in batches:
            langs, scores = [], []
            for begin, end in slices(pa.compute.binary_length(batch.column(1)).to_pylist(), SLICE_BYTES // 4):
                texts = batch.column(1).slice(begin, end - begin).to_pylist()
                usable = [bool(net) and bool(LETTER.search(t.decode())) for t in texts]
                for (lang, score), good in zip(judged(net, tables, texts, usable), usable, strict=True):
                    langs.append(lang if good else UNKNOWN)
                    scores.append(score if good else 0.0)
            yield batch_of(out, batch.column(0), [langs, scores])

    return rows.mapInArrow(work, f"doc_id {sql_type(rows, 'doc_id')}, lang_pred string, score double")


def keep_known(docs: DataFrame, net: Net | None, min_score: float = MIN_SCORE, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is known with a score of at least ``min_score``, all columns."""
    place = docs.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.tables() if net else None
        for batch in batches:
            texts = batch.column(place)
            keep = []
            for begin, end in slices([len(t.as_py() or "") for t in texts], SLICE_BYTES // 8):
                raw = [(t.as_py() or "").encode() for t in texts.slice(begin, end - begin)]
                usable = [bool(net) and bool(LETTER.search(t.decode())) for t in raw]
                keep += [good and score >= min_score
                         for (_, score), good in zip(judged(net, tables, raw, usable), usable, strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(work, docs.schema)


def judged(net: Net | None, tables, texts: list[bytes], usable: list[bool]) -> list[tuple[str, float]]:
    """Best language of each usable text and its probability."""
    parts = [windows_of(t) if good else np.empty((0, WINDOW), dtype=np.uint8)
             for t, good in zip(texts, usable, strict=True)]
    counts = [len(p) for p in parts]
    if not sum(counts):
        return [(UNKNOWN, 0.0)] * len(texts)
    windows = np.concatenate(parts)
    own = np.concatenate([net.probabilities(windows[i:i + BATCH], tables) for i in range(0, len(windows), BATCH)])
    sizes = np.full(len(windows), WINDOW, dtype=np.float64)
    ends = np.cumsum(counts)
    for t, n, end in zip(texts, counts, ends, strict=True):
        if n:
            sizes[end - 1] = len(t) - (n - 1) * WINDOW
    sums = np.concatenate([np.zeros((1, own.shape[1])), np.cumsum(own * sizes[:, None], axis=0)])
    out = []
    for t, n, end in zip(texts, counts, ends, strict=True):
        mean = (sums[end] - sums[end - n]) / max(1, len(t))
        best = int(mean.argmax())
        out.append((net.languages[best], float(min(1.0, max(0.0, mean[best])))))
    return out
