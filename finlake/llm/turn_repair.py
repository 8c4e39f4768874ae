r"""Conversation structure repair by Four-Russians block tables.

A conversation is well formed when its roles' initials are ``(s?(ua)+)?``.
The cheapest edits that make it so follow from costs to go: for every place
between two rows, the cost of the rest from each of the four states of that
pattern.  Such a cost vector less its least entry is one of a few (``Tables``
finds all that can occur), and a row is one of nine symbols.  So for every
vector and every block of ``BLOCK`` symbols a table holds the vector in front
of the block and the cost added.  A conversation is run through from its end by
one lookup a block; then it is traced from its start, each block expanded
backward from the vector behind it, and of the edits that keep the cost least
the one with the least initial is taken.  An edit's initial and the state
determine the next state, so the trace is the ASCII-least of the cheapest.

Edits: ``K`` keep (0), ``R`` give the row the role user or assistant (1), ``D``
delete (2; blank and duplicate rows have no other), ``I`` insert a row with
empty text and the role user or assistant (5).  A truncated row that stays adds
5.

Conversations are dealt by id and sorted by turn; a task holds one of them at a
time, as a row of the result, whose ``audit`` has a letter for every edit, does.

Defined results: nulls in role and text are one space, and so are nulls of id
and turn where the damage is drawn; rows without an id are one conversation;
rows of equal turn are ordered by role, then text, a repeated row directly
behind its original; a role that is empty or starts with no s, u or a can't be
kept; repeated rows are duplicates; texts of any length are whole; an empty
table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from finlake.llm.common import SPACE_CLASS, ship

BLOCK = 4
KEEP, RENAME, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
OUT_ROWS = 1000

# States: nothing yet, after s, after u, after a (the first and the last may end).
STATES, ENDS = 4, (0, 3)
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
GROWN = (2, 2, 3, 2)        # state behind a row of the one role that may be made in a state
MADE = ("user", "user", "assistant", "user")
LEGAL = {"su", "ua", "au"}

# Symbols: a role's initial (s, u, a, other), doubled for truncated rows, and rows that must go.
INITIALS = "sua"
GONE, SYMBOLS = 8, 9

_BLANK = re.compile(f"[{SPACE_CLASS}]*")
_SPACES = " \t\n\x0b\x0c\r"
_STOPS = re.compile("[.!?]")
REPAIRED = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
            "audit string, repaired_sha256 string")


def symbol(initial: str, truncated: bool) -> int:
    return 2 * (INITIALS.find(initial) if initial and initial in INITIALS else 3) + truncated


def closed(costs: list[int]) -> tuple[int, ...]:
    """Costs to go when rows may be inserted first."""
    after_u, after_a = min(costs[2], INSERT + costs[3]), min(costs[3], INSERT + costs[2])
    return (min(costs[0], INSERT + after_u), min(costs[1], INSERT + after_u), after_u, after_a)


def edges(state: int, sym: int) -> Iterator[tuple[str, int, int]]:
    """(initial, cost, next state) of the edits of a row, by initial."""
    yield "D", DELETE, state
    if sym == GONE:
        return
    extra = TRUNCATED if sym % 2 else 0
    kept = KEPT.get((state, INITIALS[sym // 2])) if sym // 2 < 3 else None
    if kept is not None:
        yield "K", KEEP + extra, kept
    yield "R", RENAME + extra, GROWN[state]


class Tables:
    """All normalised cost vectors that occur, and their transitions by symbol and by block.

    ``vectors[0]`` is that of the end.  ``step[v, sym]`` and ``jump[v, block]``
    are the vectors in front, ``step_cost`` and ``jump_cost`` what is added to the least entry.
    """

    def __init__(self, length: int = BLOCK):
        end = closed([0 if s in ENDS else 10**9 for s in range(STATES)])
        known, todo = {end: 0}, [end]
        step: list[list[tuple[int, int]]] = []
        for vector in todo:
            rows = []
            for sym in range(SYMBOLS):
                costs = closed([min(c + vector[to] for _, c, to in edges(state, sym)) for state in range(STATES)])
                least = min(costs)
                front = tuple(c - least for c in costs)
                if front not in known:
                    known[front] = len(known)
                    todo.append(front)
                rows.append((known[front], least))
            step.append(rows)
        self.length, self.vectors = length, list(known)
        both = np.array(step, np.int64)
        self.step, self.step_cost = both[..., 0], both[..., 1]
        jump, cost = self.step, self.step_cost
        for _ in range(length - 1):        # one more symbol in front of every block
            shape = (len(known), -1)
            cost = (cost[:, None, :] + self.step_cost[jump].transpose(0, 2, 1)).reshape(shape)
            jump = self.step[jump].transpose(0, 2, 1).reshape(shape)
        self.jump, self.jump_cost = jump, cost


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


def cheapest(symbols: bytes) -> tuple[int, str]:
    """Cost and audit of the cheapest edits of a conversation."""
    t = tables()
    n, b = len(symbols), t.length
    lead = n % b
    whole = np.frombuffer(symbols, np.uint8)[lead:].reshape(-1, b).astype(np.int64) @ SYMBOLS ** np.arange(b - 1, -1, -1)
    behind, total = [0], 0             # vectors behind each block, from the last on
    for code in whole[::-1].tolist():
        total += int(t.jump_cost[behind[-1], code])
        behind.append(int(t.jump[behind[-1], code]))
    blocks = [(0, lead, behind.pop())] + [(lead + b * i, lead + b * (i + 1), v)
                                          for i, v in enumerate(reversed(behind))]
    audit, state, first = [], 0, None
    for start, stop, vector in blocks:
        at, costs = [vector], []       # expanded backward: vectors in front of each row of the block
        for sym in reversed(symbols[start:stop]):
            costs.append(int(t.step_cost[at[-1], sym]))
            at.append(int(t.step[at[-1], sym]))
        if first is None:
            first = at[-1]
            total += sum(costs)
        for k in range(stop - start):
            front, back = t.vectors[at[-1 - k]], t.vectors[at[-2 - k]]
            added, moved = costs[-1 - k], False
            while not moved:
                options = [(e, to) for e, c, to in edges(state, symbols[start + k]) if c + back[to] == added + front[state]]
                if INSERT + front[GROWN[state]] == front[state]:
                    options.append(("I", GROWN[state]))
                edit, state = min(options)
                audit.append(edit)
                moved = edit != "I"
    end = t.vectors[0]
    while end[state]:
        audit.append("I")
        state = GROWN[state]
    return total + t.vectors[first][0], "".join(audit)


def repaired(rows: list[tuple[str, str]], audit: str) -> Iterator[tuple[str, str]]:
    """The rows that the edits of ``audit`` make of ``rows``."""
    state, left = 0, iter(rows)
    for edit in audit:
        if edit == "I":
            yield MADE[state], ""
            state = GROWN[state]
            continue
        role, text = next(left)
        if edit == "K":
            yield role, text
            state = KEPT[state, role[0]]
        elif edit == "R":
            yield MADE[state], text
            state = GROWN[state]


def damaged(code: int, role: str, text: str) -> list[tuple[str, str]]:
    """What the damage ``code`` leaves of a row: nothing, the row changed, or the row twice."""
    if code == 0:
        return []
    if code == 1:
        text = ""
    elif code == 2:
        text = _STOPS.sub("", text)
    elif code == 4:
        role = "user"
    return [(role, text)] * (2 if code == 3 else 1)


def repair(rows: list[tuple[str, str]], turns: list[int]) -> tuple:
    """gaps, blank, duplicate, truncated, illegal, cost, audit and repaired hash of a conversation's rows."""
    seen, symbols, faults = set(), bytearray(), {"blank": 0, "duplicate": 0, "truncated": 0}
    for role, text in rows:
        mark = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
        fault = ("blank" if _BLANK.fullmatch(text) else "duplicate" if mark in seen
                 else "truncated" if text.rstrip(_SPACES)[-1] not in ".!?" else None)
        seen.add(mark)
        if fault:
            faults[fault] += 1
        symbols.append(GONE if fault in ("blank", "duplicate") else symbol(role[:1], fault == "truncated"))
    illegal = sum(a[:1] + b[:1] not in LEGAL for (a, _), (b, _) in zip(rows, rows[1:]))
    cost, audit = cheapest(bytes(symbols))
    said = hashlib.sha256()
    for k, (role, text) in enumerate(repaired(rows, audit)):
        said.update(f"{chr(10) if k else ''}{role}:{text}".encode())
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, *faults.values(), illegal, cost, audit, said.hexdigest()


def repair_conversations(rows: DataFrame, damage: bool = True) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text): its faults and cheapest repair.

    With ``damage`` the rows are damaged first, by ``crc32('conv_id:turn') % 20``.
    """
    ship(rows.sparkSession)
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.pmod(F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")), F.lit(20)).cast("int")
    schema = to_arrow_schema(StructType.fromDDL(REPAIRED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def result() -> pa.RecordBatch:
            columns = zip(*out) if out else [[] for _ in schema]
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        began, now, held, turns = False, None, [], []
        for batch in batches:
            for conv, turn, kind, role, text in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
                if began and conv != now:
                    out.append((now, *repair(held, turns)))
                    held, turns = [], []
                    if len(out) >= OUT_ROWS:
                        yield result()
                        out.clear()
                began, now = True, conv
                left = damaged(kind, role, text)
                held += left
                if left and turn is not None:
                    turns.append(turn)
        if began:
            out.append((now, *repair(held, turns)))
        yield result()

    return (rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        (code if damage else F.lit(-1)).alias("code"), blank("role").alias("role"),
                        blank("text").alias("text"))
            .repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
            .select("conv_id", "turn", "code", "role", "text").mapInArrow(run, REPAIRED))


def _edge(cost: str, edit: str, best: str) -> str:
    """SQL: the string of cost (ten digits) and audit, with one more edit in front."""
    return f"lpad((substr({best}, 1, 10)::BIGINT + {cost})::VARCHAR, 10, '0') || '{edit}' || substr({best}, 11)"


def _oracle() -> str:
    grown = GROWN
    keeps = {s: " ".join(f"WHEN '{i}' THEN {_edge(f'{KEEP} + extra', 'K', f'v{to}')}"
                         for (a, i), to in KEPT.items() if a == s) for s in range(STATES)}
    steps = ", ".join(
        f"""least({_edge(str(DELETE), 'D', f'v{s}')},
              CASE WHEN gone THEN '9' ELSE coalesce(CASE initial {keeps[s]} END, '9') END,
              CASE WHEN gone THEN '9' ELSE {_edge(f'{RENAME} + extra', 'R', f'v{grown[s]}')} END) AS w{s}"""
        for s in range(STATES))
    inserted = f"least(w2, {_edge(str(INSERT), 'I', 'w3')}) AS v2, least(w3, {_edge(str(INSERT), 'I', 'w2')}) AS v3"
    leads = f"least(w0, {_edge(str(INSERT), 'I', 'v2')}) AS v0, least(w1, {_edge(str(INSERT), 'I', 'v2')}) AS v1"
    zero, one = "0" * 10, "0" * 9
    state = "CASE WHEN edit = 'D' THEN state WHEN edit = 'K' THEN CASE role[1] WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END " \
            "ELSE CASE state WHEN 2 THEN 3 ELSE 2 END END"
    made = "CASE state WHEN 2 THEN 'assistant' ELSE 'user' END"
    return rf"""
WITH RECURSIVE bits AS (
  SELECT i, i AS c, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS tab FROM bits WHERE k = 8),
base AS (SELECT conv_id, turn, coalesce(role, ' ') AS role0, coalesce(text, ' ') AS text0,
                coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
coded AS (SELECT base.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(name, ''), lambda x: ascii(x)::BIGINT)),
                        lambda c, b: xor(c >> 8, tab[xor(c & 255, b) + 1])), 4294967295) % 20 AS code FROM base, crc),
hurt AS (SELECT conv_id, turn, role0, text0, copy, CASE WHEN code = 4 THEN 'user' ELSE role0 END AS role,
                CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text0, '[.!?]', '', 'g') ELSE text0 END AS text
         FROM coded, (SELECT unnest([0, 1]) AS copy) WHERE code <> 0 AND (copy = 0 OR code = 3)),
placed AS (SELECT *, row_number() OVER w AS p, count(*) OVER (PARTITION BY conv_id) AS n,
                  lag(role[1]) OVER w || role[1] AS two
           FROM hurt WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role0, text0, copy)),
marked AS (SELECT *, regexp_full_match(text, '[\x20\x09-\x0D]*') AS blank,
                  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 AS again,
                  NOT regexp_full_match(text, '(?s).*[.!?][\x20\x09-\x0D]*') AS cut FROM placed),
r AS (SELECT *, blank OR again AS gone, CASE WHEN cut THEN {TRUNCATED} ELSE 0 END AS extra, role[1] AS initial FROM marked),
facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                 count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again) AS duplicate,
                 count(*) FILTER (NOT gone AND cut) AS truncated,
                 count(*) FILTER (p > 1 AND two NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
ids AS (SELECT DISTINCT conv_id FROM conversations),
back AS (
  SELECT ids.conv_id, coalesce(n, 0) AS p, '{zero}' AS v0, '{one[:-1]}10II' AS v1, '{one}5I' AS v2, '{zero}' AS v3
  FROM ids LEFT JOIN (SELECT conv_id, max(n) AS n FROM r GROUP BY conv_id) c ON ids.conv_id IS NOT DISTINCT FROM c.conv_id
  UNION ALL
  SELECT conv_id, p, {leads}, v2, v3 FROM (
    SELECT conv_id, p, w0, w1, {inserted} FROM (
      SELECT back.conv_id, back.p - 1 AS p, {steps}
      FROM back JOIN r ON back.conv_id IS NOT DISTINCT FROM r.conv_id AND back.p = r.p))),
best AS (SELECT conv_id, substr(v0, 1, 10)::BIGINT AS cost, substr(v0, 11) AS audit FROM back WHERE p = 0),
walk AS (
  SELECT conv_id, 0 AS i, 0 AS p, 0 AS state, []::VARCHAR[] AS said, audit FROM best
  UNION ALL
  SELECT conv_id, i + 1, CASE WHEN edit = 'I' THEN p ELSE p + 1 END, {state},
         CASE edit WHEN 'D' THEN said WHEN 'K' THEN list_append(said, role || ':' || text)
                   WHEN 'R' THEN list_append(said, {made} || ':' || text) ELSE list_append(said, {made} || ':') END, audit
  FROM (SELECT walk.*, walk.audit[walk.i + 1] AS edit, r.role, r.text
        FROM walk LEFT JOIN r ON walk.conv_id IS NOT DISTINCT FROM r.conv_id AND r.p = walk.p + 1
        WHERE walk.i < len(walk.audit)))
SELECT best.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, cost, best.audit, sha256(array_to_string(said, chr(10))) AS repaired_sha256
FROM best LEFT JOIN facts ON best.conv_id IS NOT DISTINCT FROM facts.conv_id
JOIN (SELECT conv_id, said FROM walk WHERE i = len(audit)) w ON best.conv_id IS NOT DISTINCT FROM w.conv_id
"""


ORACLE_SQL = _oracle()
