"""Encoding, records, packing and the word table against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from finlake.llm import packing, records, tokens, word_bpe
from finlake.session import scratch_path
from tests.llm.cases import awkward, frame, words

LETTERS = list("aàéßÉŁİΣςbcdefg., '!\t\n\x85\xa0 　\x1c\x1fµª½²٣ñÑ") + [
    "é", "́x", "don't", "<|endoftext|>", "<|ENDOFTEXT|>", "12", "漢字", "😀", "  ", "word", "The.", "it's$$"]


def odd_texts(n=400):
    r = random.Random(5)
    return ["".join(r.choice(LETTERS) for _ in range(r.randint(0, 40))) for _ in range(n)]


def library_ids(path, text):
    return tokens.load(path).encode(text or "", add_special_tokens=False).ids


def test_spaced_encoder_equals_the_library():
    encoder, t = tokens.SpacedEncoder(tokens.word_tokenizer_path()), tokens.load(tokens.word_tokenizer_path())
    for text in odd_texts() + odd_texts(50):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, text
    with pytest.raises(ValueError):
        tokens.SpacedEncoder(tokens.byte_tokenizer_path())


def test_split_words_encode_alone_as_in_their_text():
    t = tokens.load(tokens.byte_tokenizer_path())
    for text in odd_texts():
        parts = word_bpe.split_words(text)
        assert "".join(parts) == text
        assert [i for p in parts for i in t.encode(p, add_special_tokens=False).ids] == t.encode(
            text, add_special_tokens=False).ids, text


def test_word_table_round_trip(spark, monkeypatch):
    monkeypatch.setattr(word_bpe, "HOT_WORDS", 20)        # most words take the shuffled way
    monkeypatch.setattr(word_bpe, "BLOCK_CHARS", 5000)
    rows = awkward() + [(100 + i, t) for i, t in enumerate(odd_texts(60))]
    t = tokens.load(tokens.byte_tokenizer_path())
    got = word_bpe.encode(frame(spark, rows), back=True)
    want = sorted(((i, t.encode(x or "", add_special_tokens=False).ids) for i, x in rows), key=repr)
    rows_got = got.collect()
    assert sorted(((r.doc_id, r.ids) for r in rows_got), key=repr) == want
    assert sorted(((r.doc_id, r.decoded) for r in rows_got), key=repr) == sorted(((i, x or "") for i, x in rows), key=repr)
    again = word_bpe.decode(got.select("doc_id", "ids"))
    assert sorted(r.decoded for r in again.collect()) == sorted(x or "" for _, x in rows)
    assert word_bpe.encode(frame(spark, rows).limit(0)).count() == 0


def test_spaced_encoder_holds_a_word_once():
    encoder = tokens.SpacedEncoder(tokens.word_tokenizer_path())
    encoder.encode("plain plain, Plain other")
    assert set(encoder) == {"plain", "plain,", "Plain", "other"} and set(encoder.marks) == {","}


def test_words_of_many_owners_travel_packed(spark, monkeypatch):
    monkeypatch.setattr(word_bpe, "HOT_WORDS", 2)
    monkeypatch.setattr(word_bpe, "BLOCK_CHARS", 200)
    texts = [(i, t) for i, t in enumerate(odd_texts(60) + [" ".join(words(40, i % 9)) for i in range(30)])]
    df = word_bpe.encode(frame(spark, texts), back=True)
    got = {r.doc_id: (list(r.ids), r.decoded) for r in df.collect()}
    path = tokens.byte_tokenizer_path()
    t = tokens.load(path)
    assert got == {i: (ids := library_ids(path, x), t.decode(ids, skip_special_tokens=False)) for i, x in texts}
    # rare words go by owner, and come back as ids: no row per word is shuffled
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(owner" in plan and "hashpartitioning(word" not in plan


def test_decode_replaces_broken_bytes_like_the_library():
    t, table = tokens.load(tokens.byte_tokenizer_path()), word_bpe.pieces()
    r = random.Random(2)
    for _ in range(300):
        ids = [r.randrange(50257) for _ in range(r.randint(0, 12))]
        assert word_bpe.decoded(np.array(ids, np.int64), table) == t.decode(ids, skip_special_tokens=False)


def test_records_round_trip_in_id_order(spark):
    rows = awkward() + [(50 - i, " ".join(words(i, i))) for i in range(30)]
    path = scratch_path(spark, "test-records")
    records.write_records(frame(spark, rows), path)
    got = sorted(records.read_records(spark, path).collect(), key=lambda r: r.start)
    order = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    want = [[*library_ids(tokens.word_tokenizer_path(), x), 2] for _, x in order]
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in got] == want
    assert [r.doc_id for r in got] == [i for i, _ in order]
    assert [r.start for r in got] == np.cumsum([0] + [len(w) for w in want[:-1]]).tolist()
    mixed = records.read_records(spark, path, seed=3).collect()
    assert sorted((r.start, bytes(r.ids)) for r in mixed) == [(r.start, bytes(r.ids)) for r in got]
    empty = scratch_path(spark, "test-records")
    records.write_records(frame(spark, rows).limit(0), empty)
    assert records.read_records(spark, empty).count() == 0


def test_damaged_records_are_refused():
    block = records.frame(b"some ids")
    assert records.unframe(block) == b"some ids"
    for at in range(len(block)):
        with pytest.raises(OSError):
            records.unframe(block[:at] + bytes([block[at] ^ 1]) + block[at + 1:])


def check_pieces(pieces, ids_by_doc, limit=2048):
    docs, sequences = {}, {}
    for p in pieces:
        docs.setdefault(p.doc_id, []).append(p)
        sequences.setdefault(p.sequence_id, []).append(p)
        assert zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32 and len(p.ids) == p.length
    for doc_id, ps in docs.items():
        ps.sort(key=lambda p: p.start)
        assert [i for p in ps for i in p.ids] == ids_by_doc[doc_id]
        assert {p.doc_tokens for p in ps} == {len(ids_by_doc[doc_id])}
    padding = total = 0
    for ps in sequences.values():
        ps.sort(key=lambda p: p.offset)
        at = 0
        for p in ps:
            assert p.offset == at
            at += p.length
        assert at <= limit and len(ps) <= packing.MAX_SEGMENTS
        total += at
        padding += 0 if at & (at - 1) == 0 else limit - at
    assert set(docs) == set(ids_by_doc)
    return padding / total


def test_packing_places_every_id_once(spark):
    rows = [(i, t) for i, t in awkward() if i not in (None, 4)] + [(100 + i, " ".join(words(7 * i, i))) for i in range(120)]
    ids = {i: [*library_ids(tokens.word_tokenizer_path(), t), 1] for i, t in rows}
    pieces = packing.pack_documents(frame(spark, rows), with_ids=True).collect()
    assert check_pieces(pieces, ids) == 0
    many = packing.pack_documents(frame(spark, awkward() + awkward())).groupBy().agg(F.sum("length")).first()[0]
    assert many == 2 * sum(len(library_ids(tokens.word_tokenizer_path(), t)) + 1 for _, t in awkward())
    assert packing.pack_documents(frame(spark, rows).limit(0)).count() == 0


def test_packing_examples_keeps_all_limits(spark):
    r = random.Random(1)
    rows = [(str(i), n := r.randint(1, 900), r.randint(0, n)) for i in range(300)] + [("big", 5000, 10), ("loss", 900, 900),
                                                                                  (None, None, None), ("neg", -3, 4)]
    df = spark.createDataFrame(rows, "id string, tokens int, loss int").coalesce(1)
    got = packing.pack_examples(df, "id", "tokens", "loss", max_segments=4, max_loss=800).collect()
    assert len(got) == len(rows)
    need = {k: (max(n or 0, 0), max(x or 0, 0)) for k, n, x in rows}
    by = {}
    for g in got:
        by.setdefault(g.sequence_id, []).append(g)
    for members in by.values():
        assert len(members) <= 4
        if len(members) > 1:
            assert sum(need[m.key][0] for m in members) <= 2048 and sum(need[m.key][1] for m in members) <= 800
    lower = max(sum(n for n, _ in need.values()) / 2048, sum(x for _, x in need.values()) / 800, len(rows) / 4)
    assert len(by) <= 1.25 * lower + 3


def test_ids_digest_form():
    assert hashlib.sha256(b"1,2").hexdigest() == hashlib.sha256(",".join(map(str, [1, 2])).encode()).hexdigest()
