"""Piece encoding against the sentencepiece library, whole texts and random ids."""

import hashlib
import random

import numpy as np
import pandas as pd
import pytest
import sentencepiece

from finlake.llm import piece_bpe as P
from finlake.llm.queries import QUERIES
from tests.llm.cases import awkward, frame

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=P.piece_model_path())


def digest(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


def test_op11_equals_the_library(spark, library):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    got = QUERIES["op11_piece_bpe"](spark, SF).toPandas().set_index("doc_id")
    assert len(got) == len(docs)
    for doc_id, text in zip(docs.doc_id, docs.text, strict=True):
        ids = library.encode(text or "")
        row = got.loc[doc_id]
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (
            len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids)))


def test_awkward_rows(spark, library):
    texts = [*awkward(), (20, "  two  spaces  "), (21, "▁mark ▁ "), (22, "<s>a</s><0x41>"), (23, "a\x00b "),
             (24, "x" * 20_000), (25, "the" * 10_000), (26, "日本語 � é́")]
    got = P.decode(P.encode(frame(spark, texts))).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, P.encode(frame(spark, texts), back=True).collect()))
    known = lambda t: (library.encode(t or ""), library.decode(library.encode(t or "")))
    order = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in got), key=order) == sorted(
        ((i, *known(t)) for i, t in texts), key=order)
    assert P.decode(P.encode(frame(spark, []))).count() == 0


def test_null_ids_have_no_text(spark):
    rows = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded for r in P.decode(rows).collect()} == {1: None, 2: ""}


def test_random_strings_and_ids(library):
    pieces, decoder, r = P.Pieces(P.piece_model_path()), P.Decoder(), random.Random(1)
    texts = ["".join(r.choice("ab  \n\t▁é́�\x00日本😀<s>the ing,.  ") for _ in range(r.randrange(40))) for _ in range(3000)]
    for k in range(0, 3000, 100):
        for text, ids in zip(texts[k:k + 100], pieces.encode(texts[k:k + 100]), strict=True):
            assert np.frombuffer(ids, "<i4").tolist() == library.encode(text)
    for _ in range(20_000):
        ids = [r.choice([r.randrange(32_000), r.randrange(4), r.randrange(300), 28705, 259]) for _ in range(r.randrange(6))]
        assert decoder.text(ids) == library.decode(ids), ids


def test_a_difference_from_the_library_is_an_error():
    pieces = P.Pieces(P.piece_model_path())
    pieces.pair_costs = -pieces.pair_costs
    with pytest.raises(ValueError, match="otherwise"):
        pieces.encode(["some words that merge"])


def test_both_forms_of_the_agenda_agree(library):
    pieces, r = P.Pieces(P.piece_model_path()), random.Random(2)
    parts = ["".join(r.choice("abcdefghiklmnoprstuv▁é") for _ in range(r.randint(1, P.WIDE))) for _ in range(4000)]
    parts += ["a\x00b", "日本語", "x" * 50, "é" + "z" * P.WIDE, "\x00"]
    for part, ids in zip(parts, pieces.encode_parts(parts), strict=True):
        assert np.frombuffer(ids, "<i4").tolist() == pieces.agenda(part)


def test_little_memory_gives_the_same(library):
    pieces = P.Pieces(P.piece_model_path())
    pieces.parts.limit = pieces.stretches.limit = 3
    texts = [" ".join(w) for w in (["one", "two", "three"], ["two", "four", "five."], ["one", "six,", "one"], ["two"])]
    for text in texts * 3:
        assert np.frombuffer(pieces.encode([text])[0], "<i4").tolist() == library.encode(text)
