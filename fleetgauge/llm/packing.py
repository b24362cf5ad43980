"""Packing of tokenised documents into sequences of a fixed length, best two fit.

A document is cut into pieces only where it is longer than a sequence. Pieces are dealt by a hash of their place in a
table into shards of about ``SHARD_PIECES`` and packed there, so that no task holds many more, however many rows
are alike, and the work is spread; a shard wastes part of one sequence.

Defined cases: a null text is empty and has the end token alone; a row without an id is packed like any other; rows
that repeat an id are packed once each; a long text is many pieces, dealt each for itself; of pieces of one length, any
may come first; an empty table gives no piece. Columns but the two named aren't read.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from fleetgauge.llm.common import TEXT_BATCH, as_table, batch_of, id_bytes, kept_in_worker, shuffles_removed, slices, sql_type

CAPACITY = 2048
END = 0
SHARD_PIECES = 4096
#: Words whose ids a worker keeps, some 150 bytes each; beyond that it starts afresh.
REMEMBERED = 500_000
#: Words that the tokenizer encodes in one call; its answer is several hundred bytes for each.
ENCODED_AT_ONCE = 2000


#: A mark behind an ASCII letter or digit, or one of the accented letters of two bytes that begin with C3.
MARK = re.compile(rb"[.,;:!?](?:(?<=[A-Za-z0-9].)|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].))")


#: Letters of which the tokenizer changes and parts nothing, and words of them alone.
SMALL_LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
PLAIN = re.compile(f"[{SMALL_LETTERS}]+")


class WordIds:
    """Token ids of words between white space. The tokenizer never looks across white space, so that a text's ids
    are its words' ids; each word is encoded once and then remembered."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        in_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        self.byte_level = {ord(c): in_bytes.pre_tokenize_str(c)[0][0] for c in SMALL_LETTERS}
        self.forget()

    def forget(self) -> None:
        #: A word that isn't there yet gets the next number.
        self.index: defaultdict[str, int] = defaultdict()
        self.index.default_factory = self.index.__len__
        self.pool = np.empty(0, dtype=np.uint32)
        self.bounds = np.zeros(1, dtype=np.int64)

    @staticmethod
    def parted(text: bytes) -> bytes:
        """The text with words apart from the marks behind them, from which the tokenizer also parts letters and digits. It
        lower-cases after composing letters and accents, so that ASCII letters may be lower-cased before where no accent stands
        by itself (U+0300 to U+036F). Special tokens are looked for before that and in small letters alone, so that a text
        in which one might be written some other way is left as it is."""
        if b"<|" in text:
            return text
        if b"\xcc" not in text and b"\xcd" not in text:
            text = text.lower()
        return MARK.sub(rb" \g<0>", text)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and how many each has. The words are encoded as one text with blanks between them; an
        id belongs to the word that its characters begin in."""
        text = " ".join(words)
        answer = self.tokenizer.encode(text, add_special_tokens=False)
        begins = np.fromiter((x for x, _ in answer.offsets), dtype=np.int64, count=len(answer))
        behind = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
        return np.array(answer.ids, dtype=np.uint32), np.diff(np.searchsorted(begins, behind), prepend=0)

    def encode_plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of ``PLAIN`` letters, which normalising and splitting leave as they are: their bytes go
        straight to the tokenizer's model."""
        found = list(map(self.tokenizer.model.tokenize, " ".join(words).translate(self.byte_level).split(" ")))
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(words))
        return np.fromiter((t.id for t in chain.from_iterable(found)), dtype=np.uint32, count=int(lengths.sum())), lengths

    def numbers(self, words: list[str]) -> np.ndarray:
        """The number of each word in ``bounds``; new ones are learned."""
        at = np.fromiter(map(self.index.__getitem__, words), dtype=np.int64, count=len(words))
        if len(self.index) > REMEMBERED and len(self.bounds) > 1:
            self.forget()
            return self.numbers(words)
        self.learn()
        return at

    def learn(self) -> None:
        """Encodes the words that have a number but no ids yet."""
        new = list(islice(self.index, len(self.bounds) - 1, None))
        if not new:
            return
        plain = np.fromiter((PLAIN.fullmatch(w) is not None for w in new), dtype=bool, count=len(new))
        lengths, parts = np.empty(len(new), dtype=np.int64), []
        for encode, at in ((self.encode_plain, np.flatnonzero(plain)), (self.encode, np.flatnonzero(~plain))):
            for k in range(0, len(at), ENCODED_AT_ONCE):
                ids, lengths[at[k:k + ENCODED_AT_ONCE]] = encode([new[i] for i in at[k:k + ENCODED_AT_ONCE].tolist()])
                parts.append(ids)
        # The ids lie in the order of encoding, the words in that of their numbers.
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        starts = np.empty(len(new), dtype=np.int64)
        starts[order] = np.cumsum(lengths[order]) - lengths[order]
        self.pool = np.concatenate([self.pool, np.concatenate(parts)[ranges(starts, lengths)]])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(lengths)])

    def of(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text."""
        split = pa.compute.ascii_split_whitespace(pa.array(map(self.parted, texts), type=pa.string()))
        words = split.flatten().dictionary_encode()
        at = self.numbers(words.dictionary.to_pylist())[words.indices.to_numpy()]
        starts, lengths = self.bounds[at], self.bounds[at + 1] - self.bounds[at]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return np.split(self.pool[ranges(starts, lengths)], ends[split.offsets.to_numpy()[1:-1]]) if texts else []


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length says, one range after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids`` of every piece."""
    rows = id_bytes(docs, id_col, text_col)
    out = {"piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()}
    if with_ids:
        out["ids"] = pa.list_(pa.int32())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = kept_in_worker(("word ids", tokenizer), lambda: WordIds(tokenizer))
        for batch in batches:
            texts = batch.column(1)
            for begin, end in slices(pa.compute.binary_length(texts).to_pylist()):
                found, rows_at = [], []
                for i, ids in enumerate(words.of(texts.slice(begin, end - begin).to_pylist()), begin):
                    ids = np.append(ids, np.uint32(END)).astype("<u4")
                    for k in range(0, len(ids), capacity):
                        part = ids[k:k + capacity]
                        rows_at.append(i)
                        found.append((k // capacity, k, len(part), zlib.crc32(part.tobytes()),
                                      *([part.astype(np.int32)] if with_ids else [])))
                yield batch_of(out, batch.column(0).take(pa.array(rows_at)), list(zip(*found, strict=True)))

    schema = (f"doc_id {sql_type(rows, 'doc_id')}, piece int, start bigint, length bigint, ids_crc32 bigint"
              + ", ids array<int>" * with_ids)
    return rows.mapInArrow(cut, schema)


def best_two_fit(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of positions in ``lengths``, none over ``capacity``.

    A bin is filled greedily, with the longest piece that fits, again and again. Then its smallest piece may give
    way to two unpacked ones: those that together fit the gap it leaves more tightly than it did, the tightest first.
    """
    stock: dict[int, list[int]] = defaultdict(list)
    for i, n in enumerate(lengths):
        stock[n].append(i)
    sizes = sorted(stock)

    def take(n: int) -> int:
        if len(stock[n]) == 1:
            del sizes[bisect_right(sizes, n) - 1]
        return stock[n].pop()

    def put(n: int, i: int) -> None:
        if not stock[n]:
            insort(sizes, n)
        stock[n].append(i)

    bins = []
    while sizes:
        room, held = capacity, []
        while k := bisect_right(sizes, room):
            n = sizes[k - 1]
            held.append((n, take(n)))
            room -= n
        if room and len(held) > 1 and sizes:
            smallest, at = held[-1]
            pair = tightest_pair(np.array(sizes), stock, room + smallest)
            if pair and sum(pair) > smallest:
                held[-1:] = [(n, take(n)) for n in pair]
                put(smallest, at)
        bins.append([i for _, i in held])
    return bins


def tightest_pair(sizes: np.ndarray, stock: dict[int, list[int]], room: int) -> tuple[int, int] | None:
    """Two sizes in stock with the largest sum of at most ``room``."""
    mate = np.searchsorted(sizes, room - sizes, side="right") - 1
    own = np.arange(len(sizes))
    lone = np.fromiter((len(stock[n]) < 2 for n in sizes.tolist()), dtype=bool, count=len(sizes))
    mate = np.where((mate == own) & lone, mate - 1, mate)
    sums = np.where(mate >= 0, sizes + sizes[np.maximum(mate, 0)], -1)
    best = int(np.argmax(sums))
    return (int(sizes[best]), int(sizes[mate[best]])) if sums[best] > 0 else None


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``pieces`` with the ``sequence_id`` each is packed into and its ``offset`` there."""
    with shuffles_removed(pieces.sparkSession, TEXT_BATCH):
        pieces = as_table(pieces, "pieces")
    shards = -(-pieces.count() // shard_pieces) or 1
    schema = StructType(pieces.schema.fields).add("sequence_id", LongType()).add("offset", LongType())
    # By the place in the table, which no two rows share: rows that repeat are dealt out like others.
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))

    def fill(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop(columns="shard")
        order, sequence, offset, lengths = [], [], [], rows["length"].tolist()
        for k, members in enumerate(best_two_fit(lengths, capacity)):
            at = 0
            for i in members:
                order.append(i)
                sequence.append((int(key[0]) << 32) + k)
                offset.append(at)
                at += lengths[i]
        return rows.iloc[order].assign(sequence_id=sequence, offset=offset)

    return dealt.groupBy("shard").applyInPandas(fill, schema)


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """All documents as pieces in sequences: ``doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset``."""
    return pack(token_pieces(docs, tokenizer, id_col, text_col, capacity, with_ids), capacity)
