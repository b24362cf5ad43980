"""Ids, decoded text and spans of the query against the library and against the spans of every piece."""

from __future__ import annotations

import random
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
import sentencepiece

from fleetgauge.llm import pieces
from fleetgauge.llm.queries import PIECE_MODEL

PARTS = ["word", "Word", " ", "  ", "\t", "\n", "▁", "▁▁", "é", "é", "日本", "🙂", "\x00", "\x85", "ﬁ", "<s>", "</s>", "<unk>", "<0x41>", "x" * 40, ".", "42", "​", "�"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(6)
    return [None, "", " ", "▁", "word " * 20_000] + ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 14))) for _ in range(1500)]


def test_digests_against_the_library_and_the_spans(spark, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, spans string").repartition(3)
    spans = {r["doc_id"]: r["spans"] for r in pieces.encode_pieces(docs, PIECE_MODEL).collect()}
    for r in pieces.encode_digests(docs, PIECE_MODEL).collect():
        text = texts[r["doc_id"]] or ""
        ids = library.encode(text)
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest()), text
        assert r["decoded_sha256"] == sha256(library.decode(ids).encode()).hexdigest(), text
        ends = np.array([s["end"] for s in spans[r["doc_id"]]], dtype="<u4")
        assert r["spans_crc32"] == crc32(ends.tobytes()), text
        assert not ids or ends[-1] == len(text.encode())


def test_runs_are_forgotten_and_learned_again(texts, monkeypatch):
    monkeypatch.setattr(pieces, "KNOWN_WORDS", 50)
    model = pieces.Model(PIECE_MODEL)
    for t in texts[5:300]:
        assert [i for i, _, _ in model.spans(t)] == model.library.encode(t)


@pytest.mark.parametrize("size", [1, 5, 40])
def test_sections_of_long_texts_have_the_ids_of_the_whole(texts, monkeypatch, size):
    monkeypatch.setattr(pieces, "SECTION", size)
    tables = pieces.PieceTables(pieces.Model(PIECE_MODEL))
    for t in [*texts[2:4], *texts[5:], "a b" * 200, "a  b " * 50, "a ▁b▁ c" * 50, " x y ", "no-blank" * 30]:
        assert tables.ids(t) == tables.model.library.encode(t), t
    assert len(list(pieces.sections("a b" * 200))) > 10


def test_unknown_and_byte_pieces_decode_by_their_kind():
    tables = pieces.PieceTables(pieces.Model(PIECE_MODEL))
    library = tables.model.library
    assert tables.decode([library.unk_id()]) == pieces.UNKNOWN == library.decode([library.unk_id()]).encode()
    some = [i for i in range(library.get_piece_size()) if library.is_byte(i)][0x41:0x43]
    assert tables.decode(some) == b"AB"
