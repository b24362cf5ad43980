"""Encoding into the pieces of a unigram or BPE model file, with the original bytes behind every piece.

A text is normalised by the model's compiled character map: at each place the longest key of its trie is replaced,
or else one character is kept. Every normalised byte remembers where its source begins and ends. White space becomes
U+2581, and the normalised text falls into runs of that mark with what follows; no piece reaches over such a border.
``encode_pieces`` encodes a run alone, once, and remembers it; ``encode_digests`` encodes whole texts, long ones in
sections between such borders, which costs less where most runs are new. The pieces' lengths project onto the source.

Defined cases: a null or empty text has no ids; rows are never compared, so null ids, ties and repeated rows need no
rule. A text is worked on alone, so that memory follows the longest one.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from hashlib import sha256
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fleetgauge.llm.common import KNOWN_WORDS, batch_of, id_text, kept_in_worker, sql_type

MARK = "▁"


def fields(message: bytes) -> Iterator[tuple[int, object]]:
    """Numbers and values of a serialised message; enough to read a model file."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        else:
            size = number() if tag & 7 == 2 else 4 if tag & 7 == 5 else 8
            yield tag >> 3, message[at:at + size]
            at += size


class CharMap:
    """The compiled character map: a double-array trie of keys and the texts that replace them."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, dtype="<u4", count=size // 4, offset=4).tolist() if size else []
        self.texts = blob[4 + size:]
        self.known: dict[bytes, tuple[int, bytes | None]] = {}

    def longest(self, raw: bytes, at: int) -> tuple[int, bytes | None]:
        """Length of the longest key at ``at`` and its replacement; (0, None) without any."""
        units, found = self.units, (0, None)
        if not units:
            return found
        node = (units[0] >> 10) << ((units[0] & 512) >> 6)
        for i in range(at, len(raw)):
            node ^= raw[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != raw[i]:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                value = units[node] & 0x7FFFFFFF
                found = (i + 1 - at, self.texts[value:self.texts.index(b"\0", value)])
        return found


class Model:
    """What is needed of a model file."""

    def __init__(self, path: str | None = None, blob: bytes | None = None):
        import sentencepiece

        if blob is None:
            with open(path, "rb") as file:
                blob = file.read()
        self.library = sentencepiece.SentencePieceProcessor(model_proto=blob)
        spec = {k: v for number, part in fields(blob) if number == 3 for k, v in fields(part)}
        self.chars = CharMap(spec.get(2, b""))
        self.dummy, self.squeeze, self.escape = (bool(spec.get(k, 1)) for k in (3, 4, 5))
        self.pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.widths = [1 if self.library.is_byte(i) else len(p.encode()) for i, p in enumerate(self.pieces)]
        self.splits = not any(MARK in p.lstrip(MARK) for p in self.pieces)
        if not (self.splits and self.dummy and self.escape) or self.squeeze:
            raise ValueError("the model joins words, or treats white space in a way that isn't supported")
        self.known = Runs(self)

    def normalised(self, text: str) -> tuple[str, np.ndarray | None]:
        """The normalised text with leading mark, and for each of its bytes where the source begins; one more entry
        ends it. None for the places if nothing but white space changes."""
        if not self.chars.units:
            return MARK + text.replace(" ", MARK), None
        raw, at, out, places = text.encode(), 0, bytearray(MARK.encode()), [0] * len(MARK.encode())
        while at < len(raw):
            size, new = self.chars.longest(raw, at)
            if new is None:
                size = 1
                while at + size < len(raw) and raw[at + size] & 0xC0 == 0x80:
                    size += 1
                new = raw[at:at + size]
            new = new.replace(b" ", MARK.encode())
            out += new
            places += [at] * len(new)
            at += size
        return (out.decode(), np.array([*places, len(raw)])) if len(out) > 3 else ("", np.zeros(1, dtype=int))

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """``(id, begin, end)`` of every piece in bytes of the source. The mark in front is no byte of it."""
        normal, places = self.normalised(text)
        if not text or not normal:
            return []
        if places is None:
            # Blanks became marks of three bytes; the text's own marks had three from the start.
            widths = [0, 0, 0]
            for c in text:
                widths += [0, 0, 1] if c == " " else [1] * len(c.encode())
            places = np.concatenate([[0], np.cumsum(widths)])
        out, at = [], 0
        for run in RUNS.findall(normal):
            _, _, _, ends, ids = self.known[run]
            begin = at
            for i, end in zip(ids, [at + e for e in ends], strict=True):
                out.append((i, int(places[begin]), int(places[end])))
                begin = end
            at = begin
        return out


RUNS = re.compile(f"{MARK}+[^{MARK}]*")


class Runs(dict):
    """Of a run of marks and what follows: ids as text, their number, what they decode to, the end of every piece in
    normalised bytes, and the ids."""

    def __init__(self, model: Model):
        super().__init__()
        self.encode, self.widths = model.library.encode, model.widths
        self.mark = model.library.piece_to_id(MARK)  # a text of one mark only is empty to the library

    def __missing__(self, run: str) -> tuple:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        # The library puts one mark in front, and makes the others from blanks.
        ids = self.encode(run[1:].replace(MARK, " ")) if len(run) > 1 else [self.mark]
        found = self[run] = (",".join(map(str, ids)), len(ids), run.replace(MARK, " "),
                             list(accumulate([self.widths[i] for i in ids])), ids)
        return found


def encode_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, spans``, an array of ``id, begin, end`` in bytes of the text."""
    rows = id_text(docs, id_col, text_col)
    span = pa.list_(pa.struct([("id", pa.int32()), ("begin", pa.int32()), ("end", pa.int32())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = kept_in_worker(("pieces", model_path), lambda: Model(model_path))
        for batch in batches:
            yield batch_of({"spans": span}, batch.column(0), [
                [[{"id": i, "begin": b, "end": e} for i, b, e in model.spans(t.as_py())] for t in batch.column(1)]])

    return rows.mapInArrow(work, f"doc_id {sql_type(rows, 'doc_id')}, spans array<struct<id:int,begin:int,end:int>>")


class PieceTables:
    """By id: its number as text, what it decodes to, and its width in normalised bytes."""

    def __init__(self, model: Model):
        self.model = model
        self.names = list(map(str, range(len(model.pieces))))
        self.bytes = list(map(self.bytes_of, range(len(model.pieces))))
        self.widths = np.array(model.widths, dtype=np.int64)

    def bytes_of(self, i: int) -> bytes:
        """What an id stands for: a byte, text with the mark as a blank, or the library's sign for what it doesn't know."""
        library = self.model.library
        if library.is_byte(i):
            return bytes([int(self.model.pieces[i][1:-1], 16)])
        if library.is_unknown(i):
            return UNKNOWN
        return b"" if library.is_control(i) else self.model.pieces[i].replace(MARK, " ").encode()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def ids(self, text: str) -> list[int]:
        """The library's ids. Long texts are encoded in sections that begin where no piece reaches over: at a blank between
        other characters, in whose place the library puts its own mark."""
        if len(text) <= SECTION or self.model.chars.units:
            return self.model.library.encode(text)
        return [i for part in sections(text) for i in self.model.library.encode(part)]

    def piece_ends(self, ids: list[int], size: int) -> np.ndarray:
        """Where every piece ends in the normalised bytes, which are ``size``."""
        ends = np.cumsum(self.widths[np.array(ids, dtype=np.int64)])
        if (ends[-1] if len(ends) else 0) != size:
            raise ValueError("pieces don't cover the normalised text")
        return ends


#: Characters of a text that the library gets at once, where the text has a place to cut.
SECTION = 1 << 20
_CUT = re.compile(f"(?<=[^ {MARK}]) (?=[^ {MARK}])")


def sections(text: str) -> Iterator[str]:
    begin = 0
    while len(text) - begin > SECTION and (cut := _CUT.search(text, begin + SECTION)):
        yield text[begin:cut.start()]
        begin = cut.end()
    yield text[begin:]


#: What the library decodes an unknown piece to.
UNKNOWN = " ⁇ ".encode()


def source_ends(raw: bytes, ends: np.ndarray, places: np.ndarray | None) -> np.ndarray:
    """Ends in normalised bytes as ends in the source, whose blanks are marks of three bytes there, behind one mark more."""
    if places is not None:
        return places[ends]
    widths = np.where(np.frombuffer(raw, dtype=np.uint8) == 32, 3, 1)
    return np.searchsorted(np.cumsum(widths) + 3, ends, side="right")


def encode_digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``encode_pieces``, summed up: ``doc_id, n_tokens, ids_sha256, decoded_sha256, spans_crc32``. The text is decoded
    from the ids; ``spans_crc32`` is the CRC-32 of where every piece ends in the source's bytes, 32 bits each in little
    endian (pieces leave no gaps, so that a piece begins where the one before ends)."""
    rows = id_text(docs, id_col, text_col)
    out = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string(), "spans_crc32": pa.int64()}

    def digest(text: str, tables: PieceTables) -> tuple:
        ids = tables.ids(text) if text else []
        if not ids:
            return 0, EMPTY, EMPTY, 0
        raw = text.encode()
        normal, places = tables.model.normalised(text)
        ends = tables.piece_ends(ids, len(normal.encode()))
        spans = source_ends(raw, ends, places).astype("<u4").tobytes()
        return (len(ids), sha256(",".join(map(tables.names.__getitem__, ids)).encode()).hexdigest(),
                sha256(tables.decode(ids)[1:]).hexdigest(), crc32(spans))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = kept_in_worker(("piece tables", model_path), lambda: PieceTables(Model(model_path)))
        for batch in batches:
            found = [digest(text.as_py(), tables) for text in batch.column(1)]
            yield batch_of(out, batch.column(0), list(zip(*found, strict=True)) or [[]] * len(out))

    return rows.mapInArrow(
        work, f"doc_id {sql_type(rows, 'doc_id')}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, spans_crc32 bigint")


EMPTY = sha256(b"").hexdigest()
