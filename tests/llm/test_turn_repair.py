"""Conversation repair: every short symbol string by brute force, whole tables against SQL, awkward rows."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pandas as pd

from finlake.llm import turn_repair as R
from finlake.llm.queries import ORACLES, QUERIES

FORM = re.compile("(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string, code int, `a.b` int"


def by_trial(symbols) -> tuple[int, str]:
    """Cheapest edits, then the ASCII-least audit, over all scripts with up to two inserted rows at a place."""
    best = None
    per_row = []
    for s in symbols:
        extra = 5 if s % 2 and s != R.GONE else 0
        per_row.append([("D", 2, "")] if s == R.GONE else
                       [("D", 2, ""), ("K", extra, "sua?"[s // 2]), ("R", 1 + extra, "u"), ("R", 1 + extra, "a")])
    fills = [("", 0, ""), *(("I" * n, 5 * n, "".join(x)) for n in (1, 2) for x in itertools.product("ua", repeat=n))]
    for rows in itertools.product(*per_row):
        for gaps in itertools.product(fills, repeat=len(rows) + 1):
            edits = [gaps[0]]
            for row, gap in zip(rows, gaps[1:]):
                edits += [row, gap]
            cost = sum(e[1] for e in edits)
            if best and cost > best[0]:
                continue
            if FORM.fullmatch("".join(e[2] for e in edits)):
                got = cost, "".join(e[0] for e in edits)
                best = min(best, got) if best else got
    return best


def by_suffixes(symbols) -> tuple[int, str]:
    """The same by a plain table of (cost, audit) from the end."""
    def filled(v):
        v = list(v)
        for _ in range(3):
            for s in range(4):
                c, a = v[R.GROWN[s]]
                v[s] = min(v[s], (c + 5, "I" + a))
        return v

    v = filled([(0, ""), (10**9, ""), (10**9, ""), (0, "")])
    for s in reversed(symbols):
        v = filled([min((c + v[to][0], e + v[to][1]) for e, c, to in R.edges(state, s)) for state in range(4)])
    return v[0]


def test_every_short_string_by_trial():
    for n in range(3):
        for symbols in itertools.product(range(R.SYMBOLS), repeat=n):
            assert R.cheapest(bytes(symbols)) == by_trial(symbols), symbols


def test_longer_strings_by_suffixes():
    r = random.Random(3)
    for symbols in itertools.product(range(R.SYMBOLS), repeat=4):
        assert R.cheapest(bytes(symbols)) == by_suffixes(symbols)
    for _ in range(2000):
        symbols = [r.choice([0, 2, 2, 4, 4, 6, r.randrange(9)]) for _ in range(r.randrange(60))]
        assert R.cheapest(bytes(symbols)) == by_suffixes(symbols)


def test_block_length_does_not_matter(monkeypatch):
    r = random.Random(4)
    strings = [bytes(r.randrange(9) for _ in range(r.randrange(40))) for _ in range(200)]
    want = [R.cheapest(s) for s in strings]
    for length in (1, 2, 5):
        t = R.Tables(length)
        monkeypatch.setattr(R, "tables", lambda t=t: t)
        assert [R.cheapest(s) for s in strings] == want


def test_op13_equals_its_sql(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        duckdb.sql(f"CREATE OR REPLACE VIEW conversations AS FROM '{sf}/conversations.parquet'")
        want, got = duckdb.sql(ORACLES["op13_turn_repair"]).df(), QUERIES["op13_turn_repair"](spark, sf).toPandas()
        order = lambda x: x[list(want.columns)].sort_values("conv_id").reset_index(drop=True)
        pd.testing.assert_frame_equal(order(got), order(want), check_dtype=False)
        assert got.blank.sum() and got.duplicate.sum() and got.truncated.sum() and got.illegal.sum()


def test_awkward_rows(spark, tmp_path):
    rows = [(None, 0, "user", "a."), (None, None, None, None), (1, None, "user", "b."), (1, 3, "assistant", "c!"),
            (1, 3, "assistant", "c!"), (2, 0, "", "x."), (2, 1, "tool", "y."), (3, 0, "system", "only."),
            (4, 0, "user", " \t\n\x0b"), (5, 7, "user", "no end \x1c"), (6, 0, "user", "é?" * 5000),
            (6, 1, "assistant", "ok. \n")]
    rows += [(7, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(3000)]
    got = {r.conv_id: r for r in R.repair_conversations(
        spark.createDataFrame([(*x, 9, 1) for x in rows], SCHEMA)).collect()}
    assert set(got) == {r[0] for r in rows}
    code = lambda c, t: zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
    for conv in got:
        mine = sorted(((t is not None, t or 0, role or " " if role is None else role, " " if text is None else text, t)
                       for c, t, role, text in rows if c == conv), key=lambda x: x[:4])
        left, turns = [], []
        for _, _, role, text, t in mine:
            now = R.damaged(code(conv, t), role, text)
            left += now
            turns += [t] * bool(now and t is not None)
        assert tuple(got[conv])[1:] == R.repair(left, turns)
    pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype(
        {"conv_id": "Int64", "turn": "Int64"}).to_parquet(tmp_path / "c.parquet")
    duckdb.sql(f"CREATE OR REPLACE VIEW conversations AS FROM '{tmp_path}/c.parquet'")
    want = {r[0]: r for r in duckdb.sql(ORACLES["op13_turn_repair"]).fetchall()}
    assert {k: tuple(v) for k, v in got.items()} == want
    assert R.repair_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_nothing_left_after_damage(spark):
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = R.repair_conversations(spark.createDataFrame([(lost, 0, "user", "x.", 1, 1)], SCHEMA)).collect()
    assert [tuple(r) for r in got] == [(lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
