"""Quality rules: counts of words, symbols and repeats, and bands of zstandard ratios.

A text's ratio is its compressed size by its size in bytes. Repetitive text compresses too well, noise too badly;
how far a ratio can go depends on the length, so that each band of lengths has its own limits. The ratio is taken
over the whole text and over chunks of fixed size, which find a bad stretch in a long text.

Defined cases: a null or empty text has no words, fails the base rules and has ratio 1; rows are never compared, so
null ids, ties and repeated rows need no rule. A text is worked on alone, so that memory follows the longest one.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from fleetgauge.llm.common import SPACE, WordHashes, batch_of, covered, id_bytes, sql_type, window_hashes

SYMBOLS = "#*$%&|<>"
REPEAT_WIDTH = 8
CHUNK_BYTES = 8192
LEVEL = 3


class Band(NamedTuple):
    """Limits for texts of at least ``least`` bytes: ratios below ``low`` are repetitive, above ``high`` noise."""

    least: int
    low: float
    high: float


#: Short texts say little: the frame alone costs bytes. The longer a text, the more repeats it finds in itself. The
#: upper limits lie between natural text and base64 noise, which level 3 brings to 0.94 at 256 bytes, 0.80 at 1,024,
#: 0.77 at 2,048 and 0.75 at 16,384; printable noise lies higher. Hexadecimal noise (0.52) can't be told from text.
WHOLE_BANDS = (Band(0, 0.0, 9.0), Band(128, 0.22, 0.98), Band(192, 0.22, 0.89), Band(256, 0.22, 0.84),
               Band(384, 0.22, 0.81), Band(512, 0.28, 0.78), Band(768, 0.28, 0.75), Band(1024, 0.28, 0.72),
               Band(1536, 0.28, 0.70), Band(2048, 0.25, 0.69), Band(4096, 0.25, 0.67), Band(16384, 0.20, 0.66))
CHUNK_BANDS = tuple(Band(b.least, 0.20 if b.least >= 4096 else 0.0, b.high) for b in WHOLE_BANDS)
#: Share of a text's bytes that may lie in chunks out of their band.
BAD_CHUNKS = 0.1


def limits(bands: tuple[Band, ...], size: int) -> Band:
    return next(b for b in reversed(bands) if size >= b.least)


def repeated_words(hashes: np.ndarray, width: int = REPEAT_WIDTH) -> int:
    """Words in windows of ``width`` words that occur twice or more, the first occurrence included."""
    windows = window_hashes(hashes, width)
    if len(windows) < 2:
        return 0
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    often = np.zeros(len(windows), dtype=bool)
    often[1:] |= same
    often[:-1] |= same
    return int(covered(order[often], width, len(hashes)).sum())


def ratios(compress, raw: bytes, chunk: int = CHUNK_BYTES) -> tuple[float, float]:
    """Ratio of the whole text, and the share of its bytes in chunks out of their band."""
    if not raw:
        return 1.0, 0.0
    whole = len(compress(raw)) / len(raw)
    if len(raw) <= chunk:
        band = limits(CHUNK_BANDS, len(raw))
        return whole, float(not band.low <= whole <= band.high)
    bad = 0
    for at in range(0, len(raw), chunk):
        part = raw[at:at + chunk]
        band = limits(CHUNK_BANDS, len(part))
        if not band.low <= len(compress(part)) / len(part) <= band.high:
            bad += len(part)
    return whole, bad / len(raw)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the base counts, ``base_failed``, ``ratio``, ``bad_chunks``, ``kept``."""
    rows = id_bytes(docs, id_col, text_col)
    out = {"n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(),
           "n_repeat_words": pa.int64(), "base_failed": pa.bool_(), "kept": pa.bool_(), "ratio": pa.float64(),
           "bad_chunks": pa.float64()}

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, compress = WordHashes(), zstandard.ZstdCompressor(level=LEVEL).compress
        for batch in batches:
            yield batch_of(out, batch.column(0), list(zip(*(
                _judged(raw.as_py(), known, compress) for raw in batch.column(1)), strict=True)) or [[]] * len(out))

    types = {pa.int64(): "bigint", pa.bool_(): "boolean", pa.float64(): "double"}
    schema = f"doc_id {sql_type(rows, 'doc_id')}, " + ", ".join(f"{k} {types[t]}" for k, t in out.items())
    return rows.mapInArrow(judge, schema)


def _judged(raw: bytes, known: WordHashes, compress) -> tuple:
    words, text = raw.split(), raw.decode()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n = len(words)
    repeats = repeated_words(known.of(words))
    failed = n < 20 or 100 * repeats > 30 * n
    whole, bad = ratios(compress, raw)
    band = limits(WHOLE_BANDS, len(raw))
    kept = not failed and band.low <= whole <= band.high and bad <= BAD_CHUNKS
    return (n, len(text) - sum(map(text.count, SPACE)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
            repeats, failed, kept, whole, bad)
