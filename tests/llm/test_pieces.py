"""Piece encoding against the library whose models it reads, on its own model and on others' character maps."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from termloom.llm import pieces as P
from termloom.llm.queries import op12_piece_encoding, piece_file

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, ids long, starts string, decoded string"
TEXTS = [
    "", " ", "  ", "a", " a", "a ", "  two  spaces  ", "▁", "▁▁ ▁x", "tab\tand\nlines\r\n", "\x00\x01", "<s></s><unk> <0x41>", "日本語のテキスト", "𐍈😀👩‍👩‍👧 zwj",
    "é é ﬁ ㌔ Ⅳ ½ ＡＢ", "word " * 3000, "x" * 5000, "ab" * 700 + "▁" * 50, "…—“q”", "İıſß", " nbsp　wide", "don't stop", "1234567890" * 40, "﻿bom�",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_file())


def random_text(rng):
    kinds = ["abcdefgh ", "  \t\n▁", "éüñß", "日本語中文字", "😀🎉‍️", "\x00\x7f́̂", "ABC.,;!?'\"", "Привет мир "]
    return "".join(rng.choice(rng.choice(kinds)) for _ in range(rng.randint(0, 60)))


def test_encoding_as_the_library(library):
    model, rng = P.piece_model(piece_file()), random.Random(2)
    for text in TEXTS + [random_text(rng) for _ in range(1500)]:
        ids, starts, ends = model.encoded(text.encode())
        assert ids.tolist() == library.encode(text), text
        assert model.decoded([model.begin, *ids.tolist(), model.end]) == library.decode([1, *library.encode(text), 2])
        spans = library.encode(text, return_type="proto").pieces
        assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == [(p.begin, p.end) for p in spans], text


def test_decoding_any_ids_as_the_library(library):
    model, rng = P.piece_model(piece_file()), random.Random(3)
    for _ in range(1500):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259), 28705, rng.randrange(3)]) for _ in range(rng.randint(0, 12))]
        assert model.decoded(ids) == library.decode(ids), ids


def test_bytes_that_are_no_text(library):
    model = P.piece_model(piece_file())
    for data in (b"\xff", b"a\xc3", b"\xe2\x96 x", b"\xed\xa0\x80", b"\xf5\x80\x80\x80 ok", b"\xc0\x80"):
        assert model.encoded(data)[0].tolist() == library.encode(data), data


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "nfkc_cf", "identity"])
def test_character_maps(rule):
    """The compiled maps that come with the library; none is trained here."""
    own = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    spec = dict(P._fields(own.serialized_normalizer_spec()))
    model = P.PieceModel.__new__(P.PieceModel)
    model.map, model.prefix, model.marked = P.CharacterMap(spec.get(2, b"")), bool(spec.get(3, 1)), bool(spec.get(5, 1))
    model.space = P.SPACE if model.marked else b" "
    rng = random.Random(4)
    for text in TEXTS + [random_text(rng) for _ in range(300)]:
        for model.single in (bool(spec.get(4, 1)), False):
            data, came = model.normalised(text.encode())
            if model.single == bool(spec.get(4, 1)):
                assert data.decode() == own.normalize(text), (rule, text)
            assert len(came) == len(data) + 1 and (np.diff(came) >= 0).all() and came[-1] <= len(text.encode())


def test_hard_rows(spark, library):
    rows = [(1, None, 1, "x", "y"), (2, "", None, None, None), (2, "", None, None, None), (None, "One line", 1, None, None), (7, "word " * 30_000, 1, None, None), *((100 + i, t, 1, None, None) for i, t in enumerate(TEXTS))]
    out = P.decode(P.encode(spark.createDataFrame(rows, SCHEMA), piece_file()), piece_file()).collect()
    assert len(out) == len(rows)
    plain = sorted((str(i), tuple(library.encode(t or "", add_bos=True, add_eos=True)), library.decode(library.encode(t or "", add_bos=True, add_eos=True))) for i, t, *_ in rows)
    assert sorted((str(r["doc_id"]), tuple(np.frombuffer(r["ids"], "<u4").tolist()), r["decoded"]) for r in out) == plain
    for r in out:
        starts, ends = (np.frombuffer(r[n], "<u4") for n in ("starts", "ends"))
        assert len(starts) == len(ends) == len(r["ids"]) // 4 and (starts <= ends).all() and (ends[:-1] <= starts[1:]).all()
    assert P.encode(spark.createDataFrame([], SCHEMA), piece_file()).count() == 0


def test_query(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in op12_piece_encoding(spark, SF).collect()}
    assert len(got) == len(docs)
    for doc_id, text in docs:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        assert got[doc_id] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())


def test_models_of_another_kind_are_refused():
    def field(number, data):
        return bytes([number << 3 | 2, len(data)]) + data

    unknown = field(1, field(1, b"<unk>") + b"\x18\x02")
    with pytest.raises(ValueError):
        P.PieceModel(unknown + field(2, b"\x18\x01"))
    with pytest.raises(ValueError):
        P.PieceModel(unknown + field(1, field(1, b"own") + b"\x18\x04") + field(2, b"\x18\x02"))
