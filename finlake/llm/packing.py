"""Vector bin packing of token sequences by the dot-product heuristic.

A bin is a sequence with three limits: tokens, segments and loss-bearing
tokens.  Of the open items the next one into the bin is that with the largest
dot product of its demand with the bin's free room (both as shares of the
limits, weighted by the mean demand of the open items) among those that fit;
an exact fit is taken first.  Tasks pack their own rows from a pool of
``POOL`` items that is refilled as items are placed, so memory is bounded,
nothing is shuffled and a lost task is simply run again.

Where items may be cut (plain documents), room that no open item fits is
filled by cutting one, and what is left at the end of a task is dealt into
sequences whose lengths are powers of two, which need no padding.

Defined results: a null text is empty and has the end id only; repeated rows
are packed as often as they come; an empty table gives an empty result; other
columns do not matter.  Sequence ids are unique, not consecutive.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import ship, text_of
from finlake.llm.tokens import spaced_encoder, word_tokenizer_path

MAX_TOKENS = 2048
MAX_SEGMENTS = 128
POOL = 2048
END_ID = 1
SEQUENCES_PER_TASK = 1 << 40


class VectorBins:
    """Packs items (key, tokens, loss) from a pool; ``emit(sequence, offset, key, start, length)`` places a piece."""

    def __init__(self, emit: Callable, limits: tuple[int, int, int], cut: bool, first_sequence: int):
        self.emit, self.cut, self.sequence = emit, cut, first_sequence
        self.limits = np.array(limits, float)
        self.keys: list = [None] * POOL
        self.starts = np.zeros(POOL, np.int64)
        self.need = np.zeros((POOL, 3))          # tokens, segments, loss; zero segments: a free place
        self.free = list(range(POOL - 1, -1, -1))
        self.room = self.limits.copy()
        self.held: list[tuple[int, int, int]] = []   # slot content of the open bin: key, start, length

    def add(self, key, start: int, tokens: int, loss: int) -> None:
        if not self.free:
            self._close()
        at = self.free.pop()
        self.keys[at], self.starts[at], self.need[at] = key, start, (tokens, 1, loss)

    def _place(self, at: int, length: int) -> None:
        tokens, _, loss = self.need[at]
        self.held.append((self.keys[at], int(self.starts[at]), length))
        if length < tokens:
            self.starts[at] += length
            self.need[at] = (tokens - length, 1, max(0, loss - length))
            self.room -= (length, 1, min(loss, length))
        else:
            self.room -= self.need[at]
            self.keys[at], self.need[at] = None, 0
            self.free.append(at)

    def _fill(self) -> None:
        """Place items until none fits, cutting the last if that is allowed."""
        while self.room[0] > 0 and self.room[1] > 0:
            here = self.need[:, 1] > 0
            fits = here & (self.need <= self.room).all(axis=1)
            if not fits.any():
                if self.cut and here.any() and self.room[2] >= self.room[0]:
                    self._place(int(np.argmax(self.need[:, 0])), int(self.room[0]))
                return
            exact = fits & (self.need[:, 0] == self.room[0])
            if exact.any():
                self._place(int(np.argmax(exact)), int(self.room[0]))
                return
            weight = self.need[here].mean(axis=0) / self.limits ** 2
            score = np.where(fits, self.need @ (weight * self.room), -1.0)
            at = int(np.argmax(score))
            self._place(at, int(self.need[at, 0]))

    def _close(self) -> None:
        self._fill()
        offset = 0
        for key, start, length in self.held:
            self.emit(self.sequence, offset, key, start, length)
            offset += length
        self.sequence += 1
        self.held, self.room = [], self.limits.copy()

    def finish(self) -> None:
        while (self.need[:, 1] > 0).any():
            left = int(self.need[:, 0].sum())
            if self.cut and left < self.limits[0]:
                # the rest, in powers of two: no padding
                self.room[0] = 1 << (left.bit_length() - 1)
            self._close()


def pack_examples(df: DataFrame, key: str, tokens: str, loss: str, max_tokens: int = MAX_TOKENS,
                  max_segments: int = MAX_SEGMENTS, max_loss: int = MAX_TOKENS) -> DataFrame:
    """Instruction examples, never cut: key, sequence_id, offset, length.

    Counts that are null or negative count as 0; an example over a limit gets
    a sequence of its own.
    """
    ship(df.sparkSession)
    limits = (max_tokens, max_segments, max_loss)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        bins = VectorBins(lambda s, o, k, a, n: out.append((k, s, o, n)), limits, False,
                          TaskContext.get().partitionId() * SEQUENCES_PER_TASK)
        alone = bins.sequence + SEQUENCES_PER_TASK // 2
        for batch in batches:
            for k, n, x in zip(batch["key"], batch["tokens"], batch["loss"], strict=True):
                if n > max_tokens or x > max_loss:
                    out.append((k, alone, 0, int(n)))
                    alone += 1
                else:
                    bins.add(k, 0, int(n), int(x))
            yield pd.DataFrame(out, columns=["key", "sequence_id", "offset", "length"])
            out.clear()
        bins.finish()
        yield pd.DataFrame(out, columns=["key", "sequence_id", "offset", "length"])

    count = lambda c: F.greatest(F.coalesce(F.col(c).cast("long"), F.lit(0)), F.lit(0))
    items = df.select(F.col(key).cast("string").alias("key"), count(tokens).alias("tokens"), count(loss).alias("loss"))
    return items.mapInPandas(run, "key string, sequence_id long, offset long, length long")


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, max_tokens: int = MAX_TOKENS,
                   max_segments: int = MAX_SEGMENTS, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places; every id lies in one piece.

    A document's ids end with ``END_ID``.  Whole stretches of ``max_tokens``
    ids fill sequences of their own, the rest is packed with others.  All ids
    bear loss.  ``with_ids`` adds the ids as ``array<int>``.
    """
    ship(docs.sparkSession)
    path = tokenizer_path or word_tokenizer_path()
    schema = PIECES + (", ids array<int>" if with_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = spaced_encoder(path)
        end = np.array([END_ID], "<u4").tobytes()
        out: list[tuple] = []

        def emit(sequence: int, offset: int, key: tuple, start: int, length: int) -> None:
            doc_id, base, rest, total = key
            piece = rest[4 * (start - base):4 * (start - base + length)]
            row = (doc_id, start, length, zlib.crc32(piece), total, sequence, offset)
            out.append((*row, np.frombuffer(piece, "<u4").astype(np.int32)) if with_ids else row)

        first = TaskContext.get().partitionId() * SEQUENCES_PER_TASK
        bins = VectorBins(emit, (max_tokens, max_segments, max_tokens), True, first)
        alone = first + SEQUENCES_PER_TASK // 2
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = encoder.encode(text) + end
                total = len(ids) // 4
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                for start in range(0, total - max_tokens + 1, max_tokens):
                    emit(alone, 0, (doc_id, 0, ids, total), start, max_tokens)
                    alone += 1
                start = total - total % max_tokens
                if start < total:
                    bins.add((doc_id, start, ids[4 * start:], total), start, total - start, total - start)
            yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})
            out.clear()
        bins.finish()
        yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInPandas(run, schema)
