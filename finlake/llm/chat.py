r"""Chat formatting with loss masks aligned by offsets.

A conversation is rendered whole as ``### role:\ntext</turn>\n`` per turn and
encoded once with offsets.  The sorted spans of the assistant's turns are
intersected with the sorted token spans by binary search; the tokens that meet
a span bear loss, and ``loss_spans`` keeps, in characters, what of those tokens
lies in the span.  Inside texts and roles, control strings and the escape
character are escaped with a backslash, so a rendered conversation can be
parsed back exactly.

Conversations are dealt by id and sorted by turn; a task holds one of them at
a time, as a row of the result does.

Defined results: null text and null role are empty strings; rows of one
conversation with equal turn are ordered by role and text; repeated rows are
turns of their own; a null ``conv_id`` is one conversation; an empty table
gives an empty result; other columns do not matter.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import ship, text_of
from finlake.llm.tokens import byte_tokenizer_path, load

OPEN, CLOSE = "### ", "</turn>"
ASSISTANT = "assistant"
OUT_ROWS = 64
_TEXT = re.compile(r"\\|###|</turn>")
_ROLE = re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
_ROLE_END = re.compile(r"\\(?:\\|###|</turn>|:)|(:\n)")
_TEXT_END = re.compile(r"\\(?:\\|###|</turn>)|(</turn>\n)")

FORMATTED = ("conv_id long, n_turns long, formatted string, ids array<int>, loss_mask array<boolean>, "
             "loss_spans array<struct<start:int,end:int>>")


def escape(text: str) -> str:
    return _TEXT.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans of the assistant's escaped texts."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{_ROLE.sub(r'\\\g<0>', role)}:\n", escape(text)
        if role == ASSISTANT:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, f"{CLOSE}\n"]
        at += len(head) + len(body) + len(CLOSE) + 1
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        role = next(m for m in _ROLE_END.finditer(formatted, at + len(OPEN)) if m[1])
        text = next(m for m in _TEXT_END.finditer(formatted, role.end()) if m[1])
        turns.append((unescape(formatted[at + len(OPEN):role.start()]), unescape(formatted[role.end():text.start()])))
        at = text.end()
    return turns


def align(offsets: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Mask of the tokens that meet a span, and the characters of the spans that those tokens cover."""
    mask, covered = np.zeros(len(offsets), bool), []
    starts, ends = (offsets[:, 0], offsets[:, 1]) if len(offsets) else (np.zeros(0, int),) * 2
    for start, end in spans:
        first, last = np.searchsorted(ends, start, "right"), np.searchsorted(starts, end, "left")
        mask[first:last] = True
        for a, b in zip(starts[first:last], ends[first:last], strict=True):
            a, b = max(int(a), start), min(int(b), end)
            if covered and a <= covered[-1][1] and covered[-1][0] >= start:
                covered[-1] = (covered[-1][0], max(b, covered[-1][1]))
            else:
                covered.append((a, b))
    return mask, covered


def format_conversations(rows: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """One row per conversation: formatted text, ids, token mask and masked character spans."""
    ship(rows.sparkSession)
    path = tokenizer_path or byte_tokenizer_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = load(path)
        tokenizer.encode_special_tokens = True
        out: list[tuple] = []

        def done(conv_id, turns: list) -> None:
            formatted, spans = render(turns)
            got = tokenizer.encode(formatted, add_special_tokens=False)
            mask, covered = align(np.array(got.offsets, np.int64).reshape(-1, 2), spans)
            out.append((conv_id, len(turns), formatted, got.ids, mask.tolist(),
                        [{"start": a, "end": b} for a, b in covered]))

        def rows() -> pd.DataFrame:
            names = [c.split()[0] for c in FORMATTED.split(", ")]
            return pd.DataFrame(out, columns=names).astype({"conv_id": "Int64"})

        now, turns = None, []
        for batch in batches:
            for conv_id, role, text in zip(batch["conv_id"], batch["role"], batch["text"], strict=True):
                conv_id = None if pd.isna(conv_id) else int(conv_id)
                if turns and conv_id != now:
                    done(now, turns)
                    turns = []
                    if len(out) >= OUT_ROWS:
                        yield rows()
                        out.clear()
                now = conv_id
                turns.append((role, text))
        if turns:
            done(now, turns)
        yield rows()

    return (rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
                        text_of("role").alias("role"), text_of().alias("text"))
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text").mapInPandas(run, FORMATTED))


DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long")


def digests(formatted: DataFrame) -> DataFrame:
    """What a reader gets back from formatted conversations, as digests."""
    ship(formatted.sparkSession)
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for conv_id, text, spans in zip(batch["conv_id"], batch["formatted"], batch["loss_spans"], strict=True):
                turns, heard, said, n = parse(text), hashlib.sha256(), hashlib.sha256(), 0
                for role, body in turns:
                    heard.update(f"{role}\n{body}\n".encode())
                for span in spans:
                    part = unescape(text[span["start"]:span["end"]])
                    n += len(part)
                    said.update(part.encode())
                out.append((conv_id, len(turns), heard.hexdigest(), n, said.hexdigest(), len(text)))
            names = [c.split()[0] for c in DIGESTS.split(", ")]
            yield pd.DataFrame(out, columns=names).astype({"conv_id": "Int64"})

    return formatted.select("conv_id", "formatted", "loss_spans").mapInPandas(run, DIGESTS)
