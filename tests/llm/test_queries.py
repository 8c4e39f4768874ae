"""The registered queries on a whole small table against brute force, and op2 against its SQL."""

import hashlib
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as E
from finlake.llm import tokens
from finlake.llm.queries import CONTROL_TEXT, ORACLES, QUERIES
from finlake.llm.wordhash import edits_within, shingles, word_hashes
from tests.llm.test_native import base_truth

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id")


def result(spark, name):
    return QUERIES[name](spark, SF).toPandas()


def library(path, texts):
    return [np.array(e.ids, "<u4") for e in tokens.load(path).encode_batch(list(texts), add_special_tokens=False)]


def test_all_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())


def test_op2_equals_its_sql(spark):
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS FROM '{SF}/documents.parquet'")
    want, got = duckdb.sql(ORACLES["op2_exact_dedup"]).df(), result(spark, "op2_exact_dedup")
    order = lambda x: x[list(want.columns)].sort_values("doc_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(order(got), order(want), check_dtype=False)


def test_op1_loses_no_link(spark, docs):
    got = dict(result(spark, "op1_order_minhash")[["doc_id", "class_id"]].itertuples(index=False, name=None))
    assert set(got) == set(docs.doc_id)
    hashes = {i: word_hashes(t) for i, t in zip(docs.doc_id, docs.text, strict=True)}
    holders = defaultdict(set)
    for i, h in hashes.items():
        for s in set(shingles(h, 5).tolist()):
            holders[s].add(i)
    parent = {i: i for i in hashes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in {(a, b) for m in holders.values() for a in m for b in m if a < b}:
        n = max(len(hashes[a]), len(hashes[b]))
        if edits_within(hashes[a], hashes[b], int(n * 0.2 + 1e-9)) is not None:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    assert got == {i: find(i) for i in hashes}


def test_op4_runs_are_equal_lines(spark, docs):
    lines = {i: [x.strip() for x in t.split("\n") if x.strip()] for i, t in zip(docs.doc_id, docs.text, strict=True)}
    found = result(spark, "op4_line_runs")
    for r in found.itertuples():
        assert r.n_lines >= 3
        assert lines[r.doc_id][r.start_line:r.end_line] == lines[r.source_doc_id][r.source_line:r.source_line + r.n_lines]
        assert (r.source_doc_id, r.source_line) < (r.doc_id, r.start_line)
    covered = {(r.doc_id, at) for r in found.itertuples() for at in range(r.start_line, r.end_line)}
    seen, needed = set(), set()
    for i, ls in lines.items():
        for at in range(len(ls) - 2):
            run = tuple(ls[at:at + 3])
            if run in seen:
                needed.update((i, at + k) for k in range(3))
            seen.add(run)
    assert len(needed - covered) <= 0.1 * len(needed) and not covered - needed


def test_op5_packs_every_id_once(spark, docs):
    ids = {i: np.append(e, 1).astype("<u4") for i, e in
           zip(docs.doc_id, library(tokens.word_tokenizer_path(), docs.text), strict=True)}
    got = result(spark, "op5_packing")
    for r in got.itertuples():
        assert zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) == r.ids_crc32
        assert r.doc_tokens == len(ids[r.doc_id])
    assert got.groupby("doc_id").length.sum().to_dict() == {i: len(x) for i, x in ids.items()}
    sizes = got.groupby("sequence_id").length.sum()
    assert sizes.max() <= 2048 and sum(2048 - n for n in sizes if n & (n - 1)) <= 0.01 * sizes.sum()
    assert (got.groupby("sequence_id").apply(lambda g: (g.offset + g.length).max()) == sizes).all()


def test_op6_reads_back_all_ids_in_order(spark, docs):
    ids = [np.append(e, 2).astype("<u4") for e in library(tokens.word_tokenizer_path(), docs.text)]
    got = result(spark, "op6_token_records").sort_values("doc_id")
    n = np.array([len(x) for x in ids])
    assert got.doc_id.tolist() == docs.doc_id.tolist() and got.n_tokens.tolist() == n.tolist()
    assert got.start.tolist() == (np.cumsum(n) - n).tolist()
    assert got.ids_crc32.tolist() == [zlib.crc32(x.tobytes()) for x in ids]


def test_op7_passages_are_similar_and_cover_exact_repeats(spark, docs):
    text = {i: t.split() for i, t in zip(docs.doc_id, docs.text, strict=True)}
    found = result(spark, "op7_passages")
    for r in found.itertuples():
        a, b = (word_hashes(" ".join(x)) for x in (text[r.doc_id][r.start_word:r.end_word],
                                                   text[r.source_doc_id][r.source_start:r.source_end]))
        edits = edits_within(a, b, max(len(a), len(b)))
        assert r.source_doc_id < r.doc_id and r.n_words >= 40
        assert abs(1 - edits / max(len(a), len(b)) - r.similarity) < 1e-9 and r.similarity >= 0.8
    holders, seen = set(), {}
    for i, ws in text.items():
        runs = {tuple(ws[at:at + 50]) for at in range(len(ws) - 49) if len(set(ws[at:at + 50])) > 15}
        if any(x in seen for x in runs):
            holders.add(i)
        seen.update(dict.fromkeys(runs, i))
    assert holders <= set(found.doc_id)


def test_op8_equals_the_library(spark, docs):
    t = tokens.load(tokens.byte_tokenizer_path())
    ids = [e.ids for e in t.encode_batch(list(docs.text), add_special_tokens=False)]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = result(spark, "op8_word_bpe").sort_values("doc_id")
    assert got.n_tokens.tolist() == [len(x) for x in ids]
    assert got.ids_sha256.tolist() == [sha(",".join(map(str, x))) for x in ids]
    assert got.decoded_sha256.tolist() == [sha(t.decode(x, skip_special_tokens=False)) for x in ids]


def test_op9_base_counts(spark, docs):
    got = result(spark, "op9_quality_rules").sort_values("doc_id")
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    want = [(i, *base_truth(t)) for i, t in zip(docs.doc_id, docs.text, strict=True)]
    assert list(got[cols].itertuples(index=False, name=None)) == want
    assert not (got.kept & got.base_failed).any()


def test_op10_reads_back_conversations(spark):
    rows = pd.read_parquet(f"{SF}/conversations.parquet")
    rows = pd.concat([rows, pd.DataFrame([(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)],
                                         columns=rows.columns)]).sort_values(["conv_id", "turn"])
    want = []
    for conv_id, g in rows.groupby("conv_id"):
        said = "".join(g.text[g.role == "assistant"].fillna(""))
        heard = "".join(f"{r}\n{t}\n" for r, t in zip(g.role, g.text.fillna(""), strict=True))
        want.append((conv_id, len(g), hashlib.sha256(heard.encode()).hexdigest(), len(said),
                     hashlib.sha256(said.encode()).hexdigest()))
    got = result(spark, "op10_chat_format").sort_values("conv_id")
    cols = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256"]
    assert list(got[cols].itertuples(index=False, name=None)) == want
    assert re.fullmatch("op10_.*", "op10_chat_format")
