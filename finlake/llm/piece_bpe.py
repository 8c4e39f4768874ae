"""Piece encoding with a merge-type SentencePiece vocabulary, and decoding.

A text is normalised as the model says (an identity normaliser: one leading
space is added, spaces become ``MARK``) and cut into stretches ``MARK+ other*``,
and these between two characters that stand side by side in no piece.
No piece of the vocabulary continues past such a cut (for stretches this is
checked when the model is loaded), so the ids of a text are the ids of its
parts in order.

A part is encoded by an agenda of adjacent symbol pairs: every pair that
joins to a piece is entered under that piece's score; the best score is taken
first and the leftmost pair of equal scores; a merge enters the two pairs it
creates in place of those it ends.  What is no piece in the end becomes its
bytes.  The new parts of a batch run through it together, a row of a matrix
each; a part of over ``WIDE`` characters has a heap to itself.  Every stretch with a part that a task encodes is
compared, a batch of them at a time, with the ids that the sentencepiece
library gives it, and a difference fails the task.  Stretches and parts are
remembered within a worker, in tables of bounded size, so common words are
encoded once.

There is no shuffle: a row's ids depend on its text alone.

Defined results: null text is empty and has no ids; repeated rows give repeated
results; an empty table gives an empty one; other columns do not matter; a text
of any length is encoded whole, in time ``n log n`` for its longest stretch
without a space; control pieces' own strings in a text are ordinary text.
"""

from __future__ import annotations

import codecs
import re
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import groupby
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake.llm.common import ship, text_of

MARK = "▁"
STRETCHES, PARTS = 1 << 19, 1 << 16   # what a worker remembers of each, and as many again from before
CACHED_CHARS = 64        # longer ones are encoded anew
TEXT_CHARS = 1 << 20     # texts whose new stretches are encoded together
WIDE, TOGETHER = 24, 1 << 13   # parts of up to so many characters are encoded so many at a time
_STRETCH = re.compile(f"{MARK}+[^{MARK}]*")

# Piece types and the model type of the file format (fixed values).
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MERGES = 2


def piece_model_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def read_model(path: str):
    """The model at ``path``; one that this encoder can't follow exactly is an error."""
    from sentencepiece import sentencepiece_model_pb2 as model_pb2
    model = model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    norm, trained = model.normalizer_spec, model.trainer_spec
    kinds = {p.type for p in model.pieces}
    reasons = [why for why, wrong in (
        ("is no merge-type vocabulary", trained.model_type != MERGES),
        ("has no byte fallback", not trained.byte_fallback),
        ("marks spaces as suffixes", trained.treat_whitespace_as_suffix),
        ("rewrites characters", bool(norm.precompiled_charsmap)),
        ("rewrites decoded characters", bool(model.denormalizer_spec.precompiled_charsmap)),
        ("drops or keeps spaces otherwise",
         norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces),
        ("has user-defined or unused pieces", not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE}),
        ("has pieces that continue past a space",
         any(p.type == NORMAL and re.search(f"[^{MARK}]{MARK}", p.piece) for p in model.pieces)),
    ) if wrong]
    if reasons:
        raise ValueError(f"{path} {', '.join(reasons)}")
    return model


class Remembered(dict):
    """What was made of each key; at ``limit`` entries, those not used again for as long are forgotten."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.before = limit, {}

    def all(self, keys: set[str], make) -> dict[str, bytes]:
        """The value of every key; ``make`` gives those of the unknown ones."""
        if len(self) >= self.limit:
            self.before = dict(self)
            self.clear()
        unknown = keys - self.keys()
        if self.before:
            old = unknown & self.before.keys()
            self.update((k, self.before[k]) for k in old)
            unknown -= old
        made = make(unknown) if unknown else {}
        long = [k for k in made if len(k) > CACHED_CHARS]
        self.update(made)
        out = dict(zip(keys, map(self.get, keys)))
        for k in long:
            del self[k]
        return out


class Pieces:
    """Encodes texts to little-endian 32-bit ids.  Stretches are named without their first ``MARK``."""

    def __init__(self, path: str):
        import sentencepiece
        model = read_model(path)
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids, self.size = normal, len(model.pieces)
        self.costs = {p.piece: -p.score for p in model.pieces if p.type == NORMAL}
        self.joins = {p[i:i + 2] for p in normal for i in range(len(p) - 1)}
        self.bytes = [0] * 256
        for i, p in enumerate(model.pieces):
            if p.type == BYTE:
                self.bytes[int(p.piece[1:-1], 16)] = i
        # tables for many parts at once: id of a character, cost and id of two adjacent pieces
        self.of_char = np.full(sys.maxunicode + 1, self.size, np.int32)
        for p, i in normal.items():
            if len(p) == 1:
                self.of_char[ord(p)] = i
        pairs = sorted((normal[p[:k]] * (self.size + 1) + normal[p[k:]], self.costs[p], i) for p, i in normal.items()
                       for k in range(1, len(p)) if p[:k] in normal and p[k:] in normal)
        self.pair_keys, self.pair_costs, self.pair_ids = (
            np.array([x[k] for x in pairs], t) for k, t in enumerate((np.int64, np.float64, np.int64)))
        self.parts, self.stretches = Remembered(PARTS), Remembered(STRETCHES)

    def agenda(self, part: str) -> list[int]:
        """Ids of one part by merging its best pairs."""
        cost, ids = self.costs.get, self.ids
        symbols, n = list(part), len(part)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = [(c, i, i + 1, 2) for i in range(n - 1) if (c := cost(part[i:i + 2])) is not None]
        heapify(queue)
        while queue:
            _, left, right, size = heappop(queue)
            a, b = symbols[left], symbols[right]
            if not a or not b or len(a) + len(b) != size:
                continue
            symbols[left] = joined = a + b
            symbols[right] = ""
            beyond = after[left] = after[right]
            if beyond >= 0:
                before[beyond] = left
                piece = joined + symbols[beyond]
                if (c := cost(piece)) is not None:
                    heappush(queue, (c, left, beyond, len(piece)))
            first = before[left]
            if first >= 0:
                piece = symbols[first] + joined
                if (c := cost(piece)) is not None:
                    heappush(queue, (c, first, left, len(piece)))
        out = []
        for s in symbols:
            if s in ids:
                out.append(ids[s])
            elif s:
                out += [self.bytes[x] for x in s.encode()]
        return out

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cost and id of the pieces that two adjacent ones join to; infinite where they join to none."""
        key = left * (self.size + 1) + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        known = (self.pair_keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(known, self.pair_costs[at], np.inf), self.pair_ids[at]

    def agendas(self, parts: list[str]) -> list[bytes]:
        """The same for many parts of about one length: a row each, whose agenda is its row of pair costs."""
        width = max(map(len, parts))
        columns = np.arange(width)
        chars = np.array(parts, f"<U{width}").view(np.uint32).reshape(len(parts), width)
        ids = np.where(columns < np.fromiter(map(len, parts), np.int64, len(parts))[:, None], self.of_char[chars], -1).astype(np.int64)
        done, rows = np.full_like(ids, -1), np.arange(len(parts))
        costs, joined = self._pairs(ids[:, :-1], ids[:, 1:]) if width > 1 else (np.full((len(parts), 1), np.inf),) * 2
        while len(rows):
            best = costs.argmin(1)         # the leftmost of the best
            on = costs[np.arange(len(rows)), best] < np.inf
            done[rows[~on]] = ids[~on]
            rows, ids, costs, joined, best = rows[on], ids[on], costs[on], joined[on], best[on]
            if not len(rows):
                break
            every = np.arange(len(rows))
            ids[every, best] = joined[every, best]
            moved = columns + (columns > best[:, None])
            ids = np.take_along_axis(np.pad(ids, ((0, 0), (0, 1)), constant_values=-1), moved, 1)
            moved = moved[:, :-1]
            costs = np.take_along_axis(np.pad(costs, ((0, 0), (0, 1)), constant_values=np.inf), moved, 1)
            joined = np.take_along_axis(np.pad(joined, ((0, 0), (0, 1))), moved, 1)
            for at in (best, best - 1):    # the new piece with its neighbours
                there = (at >= 0) & (at < width - 1)
                r, c = every[there], at[there]
                costs[r, c], joined[r, c] = self._pairs(ids[r, c], ids[r, c + 1])
        data = done[done >= 0].astype("<i4").tobytes()
        ends = [0, *(4 * np.cumsum((done >= 0).sum(1))).tolist()]
        out = [data[a:b] for a, b in zip(ends, ends[1:])]
        for k in np.flatnonzero((done == self.size).any(1)).tolist():
            out[k] = array("i", self.agenda(parts[k])).tobytes()
        return out

    def encode_parts(self, parts: list[str]) -> list[bytes]:
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        out: list[bytes] = [b""] * len(parts)
        order = np.argsort(sizes, kind="stable")
        order = order[:np.searchsorted(sizes[order], WIDE, "right")].tolist()
        for k in range(0, len(order), TOGETHER):
            some = order[k:k + TOGETHER]
            for i, ids in zip(some, self.agendas([parts[i] for i in some]), strict=True):
                out[i] = ids
        for i in np.flatnonzero(sizes > WIDE).tolist():
            out[i] = array("i", self.agenda(parts[i])).tobytes()
        return out

    def encode_stretches(self, names: set[str]) -> dict[str, bytes]:
        """Ids of stretches by those of their parts; compared with the library's where a part is new."""
        joins, whole, cut = self.joins, [], {}
        for rest in names:
            text = MARK + rest
            if joins.issuperset(map(add, text, rest)):
                whole.append(text)
            else:
                at = [0, *(i for i in range(1, len(text)) if text[i - 1:i + 1] not in joins), len(text)]
                cut[rest] = [text[a:b] for a, b in zip(at, at[1:])]
        out = {text[1:]: ids for text, ids in zip(whole, self.encode_parts(whole), strict=True)}
        out.pop("", None)
        self.verify(out)
        new: set[str] = set()

        def make(parts: set[str]) -> dict[str, bytes]:
            new.update(parts)
            parts = list(parts)
            return dict(zip(parts, self.encode_parts(parts), strict=True))

        known = self.parts.all({p for parts in cut.values() for p in parts}, make)
        joined = {rest: b"".join([known[p] for p in parts]) for rest, parts in cut.items()}
        self.verify({rest: joined[rest] for rest, parts in cut.items() if not new.isdisjoint(parts)})
        out |= joined
        if "" in names:      # the library has no text that is the added space alone
            out[""] = array("i", self.agenda(MARK)).tobytes()
        return out

    def verify(self, encoded: dict[str, bytes]) -> None:
        """Compare with the library's ids; it adds the first space itself."""
        theirs = self.library.encode([rest.replace(MARK, " ") for rest in encoded], num_threads=1)
        for (rest, ours), ids in zip(encoded.items(), theirs, strict=True):
            if array("i", ids).tobytes() != ours:
                raise ValueError(f"the library encodes {rest[:200]!r} otherwise")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text."""
        names = []
        for text in texts:
            if not text:
                names.append([])
            elif "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
                names.append([s[1:] for s in _STRETCH.findall(MARK + text.replace(" ", MARK))])
            else:
                names.append(text.split(" "))
        known = self.stretches.all(set().union(*names), self.encode_stretches)
        return [b"".join(map(known.__getitem__, n)) for n in names]


@lru_cache(maxsize=2)
def _pieces(path: str) -> Pieces:
    return Pieces(path)


def encode(docs: DataFrame, model_path: str | None = None, back: bool = False) -> DataFrame:
    """doc_id and ids (``array<int>``) of every row, without begin or end ids.

    ``back`` adds ``decoded``, the text of the ids, in the same pass.
    """
    ship(docs.sparkSession)
    path = model_path or piece_model_path()
    names = ["doc_id", "ids", "decoded"][:2 + back]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, decoder = _pieces(path), Decoder(path)
        for batch in batches:
            texts, rows = batch.column("text").to_pylist(), []
            ends = np.cumsum([0, *map(len, texts)])
            cuts = np.searchsorted(ends, np.arange(0, ends[-1] + TEXT_CHARS, TEXT_CHARS)).tolist()
            for a, b in zip(cuts, [*cuts[1:], len(texts)]):
                rows += pieces.encode(texts[a:b])
            ends = np.cumsum([0, *map(len, rows)], dtype=np.int64) // 4
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(rows), np.int32)))
            columns = [batch.column("doc_id"), ids]
            if back:
                columns.append(decoder.column(ids))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return base.mapInArrow(run, "doc_id long, ids array<int>" + (", decoded string" if back else ""))


def _each_byte(e: UnicodeError) -> tuple[str, int]:
    return "\ufffd" * (e.end - e.start), e.end


class Decoder:
    """Texts of ids, by a table of the bytes that each id stands for."""

    def __init__(self, model_path: str | None = None):
        codecs.register_error("finlake_each_byte", _each_byte)
        pieces = read_model(model_path or piece_model_path()).pieces
        self.table = [self._bytes(p) for p in pieces]
        # ids whose leading space is no mark: the byte of a space and the unknown piece
        self.kept_space = frozenset(i for i, p in enumerate(pieces) if p.type != NORMAL and self.table[i][:1] == b" ")

    @staticmethod
    def _bytes(piece) -> bytes:
        if piece.type == BYTE:
            return bytes([int(piece.piece[1:-1], 16)])
        return {CONTROL: b"", UNKNOWN: " \u2047 ".encode()}.get(piece.type, piece.piece.replace(MARK, " ").encode())

    def text(self, ids: list[int]) -> str:
        """The text of ``ids``; bytes that are no UTF-8 become U+FFFD each.

        The leading space that encoding added goes, unless the first id that
        has a text is one of ``kept_space``.  Ids without a text (control
        pieces) part the bytes of a character.
        """
        shown = list(map(self.table.__getitem__, ids))
        if all(shown):
            out, first = b"".join(shown).decode("utf-8", "finlake_each_byte"), ids[:1]
        else:
            runs = [list(r) for some, r in groupby(ids, lambda i: bool(self.table[i])) if some]
            out = "".join([b"".join(map(self.table.__getitem__, r)).decode("utf-8", "finlake_each_byte") for r in runs])
            first = runs[0][:1] if runs else []
        return out[1:] if out[:1] == " " and first[0] not in self.kept_space else out

    def column(self, ids: pa.ListArray) -> pa.Array:
        values, ends = ids.values.to_numpy(), ids.offsets.to_numpy().tolist()
        known = ids.is_valid().to_pylist()
        return pa.array([self.text(values[a:b].tolist()) if k else None for k, a, b in zip(known, ends, ends[1:])], pa.string())


def decode(encoded: DataFrame, model_path: str | None = None) -> DataFrame:
    """``encoded`` with the column ``decoded``: the text of ``ids``; null ids have no text."""
    ship(encoded.sparkSession)
    path = model_path or piece_model_path()
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, decoder.column(batch.column("ids"))], names=schema.names)

    return encoded.mapInArrow(run, schema)
