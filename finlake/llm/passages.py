"""Repeated passages across documents by collinear chaining of shared k-mer seeds.

1. Seeds: the least k-mer of every window of ``WINDOW`` consecutive k-mers of
   ``SEED_WORDS`` words, so any common run of ``WINDOW + SEED_WORDS - 1`` words
   shares one.  All words of all texts are covered.
2. Match: every occurrence of a seed is matched with the occurrence in the
   least document that has it, never with all others; a passage that a third
   of all documents hold costs a row each.  Keys travel packed: a task's keys
   are dealt out to ``GROUPS`` groups by their last bits, Spark brings a group's
   arrays together, and the group is sorted by key and document, so the source
   is the first of its key.
3. Chains: per pair of documents, matches that ascend in both texts are
   chained at the best score of ``SEED_GAIN`` a seed less ``GAP_COST`` a word
   of gap in either text; a Fenwick tree of prefix maxima finds each match's
   best predecessor in logarithmic time.  Where a gap costs more than a seed
   gains, a chain is cut in two.
4. Alignment: each text travels once to the chains that need it, and its words
   around them are cut out.  Chains are extended over matching words at both ends, and kept as
   passages if a banded alignment finds at least ``SIMILARITY`` over at least
   ``MIN_WORDS`` words; a chain that fails is cut at its widest gap and its
   parts are tried again.
5. Exact repeats: where a passage's seeds first occur in different documents,
   its chains may all be too short.  So runs of ``MIN_WORDS`` words are keys of
   their own, winnowed over ``SPREAD`` runs, and around a key that two
   documents share every run of ``MIN_WORDS`` words is matched with the least
   document that has it: equal runs are passages by themselves, and every word
   of a common run of ``MIN_WORDS + SPREAD - 1`` words is covered.  Both kinds of
   key are made in one pass over the texts.

Defined results: null text is empty; a null ``doc_id`` takes no part; rows that
share a ``doc_id`` but not their text are documents of their own, the greater
texts later than all ids; rows with equal id and text are one; repetition
inside one document is no passage; texts of any length are read whole; an empty
table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finlake.llm.common import SPACE_CLASS, ids_of, materialise, rows_with_nodes, ship, text_nodes, text_of
from finlake.llm.wordhash import edits_within, hashed, mix, shingles

SEED_WORDS = 6
WINDOW = 12
SEED_GAIN = 6.0
GAP_COST = 0.05
MIN_SEEDS = 2
MIN_WORDS = 40
SIMILARITY = 0.8
SPREAD = 11               # exact runs of MIN_WORDS words of which one is a key
MARGIN = 64               # words around a chain that the extension may take
GROUPS = 1 << 10          # groups that keys are dealt out to
PACK = 1 << 20            # keys that a task holds before it deals them out
CHAINS, SOURCES = -1, -2  # kinds of cut-out words; kinds from 0 are groups of runs
MISMATCH, DROP = 2, 8     # extension: cost of a differing word, and the loss at which it ends

PASSAGES = ("doc_id long, start_word int, end_word int, n_words int, source_doc_id long, "
            "source_start int, source_end int, similarity double")


def window_minima(values: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions of a least value of each window; of the whole, if it is shorter.

    Of equal least values the last is taken, and where one value goes on
    (words repeated over and over) one position per window.
    """
    if not len(values):
        return np.zeros(0, np.int64)
    w = min(window, len(values))
    least, at, reach = values, np.arange(len(values)), 1
    while reach < w:              # windows of `reach` values, two of which make the next width
        step = min(reach, w - reach)
        later = least[step:] <= least[:-step]
        at = np.where(later, at[step:], at[:-step])
        least = np.where(later, least[step:], least[:-step])
        reach += step
    at = at[np.concatenate(([True], at[1:] != at[:-1]))]
    new = np.concatenate(([True], (values[at[1:]] != values[at[:-1]]) | (np.diff(at) >= window)))
    step = (at - np.maximum.accumulate(np.where(new, at, 0))) // window
    return at[new | np.concatenate(([True], step[1:] != step[:-1]))]


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``count`` whole numbers from each of ``first``, one after another."""
    return np.arange(int(count.sum())) + np.repeat(first - (np.cumsum(count) - count), count)


def minima_of_texts(values: np.ndarray, first: np.ndarray, count: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """``window_minima`` of the ``count`` values from each of ``first``: texts and positions in ``values``."""
    long = np.flatnonzero(count >= window)
    texts, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if len(long):
        least, at, reach = values, np.arange(len(values)), 1
        while reach < window:
            step = min(reach, window - reach)
            later = least[step:] <= least[:-step]
            at = np.where(later, at[step:], at[:-step])
            least = np.where(later, least[step:], least[:-step])
            reach += step
        windows = count[long] - window + 1
        at, text = at[_ranges(first[long], windows)], np.repeat(long, windows)
        differ = np.concatenate(([True], at[1:] != at[:-1]))
        at, text = at[differ], text[differ]
        new = np.concatenate(([True], (values[at[1:]] != values[at[:-1]]) | (np.diff(at) >= window)
                              | (text[1:] != text[:-1])))
        step = (at - np.maximum.accumulate(np.where(new, at, 0))) // window
        kept = new | np.concatenate(([True], step[1:] != step[:-1]))
        texts.append(text[kept])
        places.append(at[kept])
    for i in np.flatnonzero((count > 0) & (count < window)):
        at = window_minima(values[first[i]:first[i] + count[i]], window) + first[i]
        texts.append(np.full(len(at), i))
        places.append(at)
    return np.concatenate(texts), np.concatenate(places)


def seeds_of_texts(words: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts, seeds and positions in ``words`` of the texts that have ``count`` words from ``first``.

    A k-mer that a text's seeds repeat is a seed again under its occurrence
    number, so that the n-th repetition also meets the n-th of another text.
    """
    kmers = shingles(words, SEED_WORDS)
    text, at = minima_of_texts(kmers, first, np.maximum(count - SEED_WORDS + 1, 0), WINDOW)
    values = kmers[at]
    order = np.lexsort((at, values, text))
    ranked, of = values[order], text[order]
    index = np.arange(len(ranked))
    start = np.concatenate((np.ones(min(len(ranked), 1), bool), (ranked[1:] != ranked[:-1]) | (of[1:] != of[:-1])))
    occurrence = np.empty(len(values), np.uint64)
    occurrence[order] = index - np.maximum.accumulate(np.where(start, index, 0))
    again = occurrence > 0
    labelled = mix(values[again] + occurrence[again] * np.uint64(0x9E3779B97F4A7C15))
    return (np.concatenate((text, text[again])), np.concatenate((values, labelled)).view(np.int64),
            np.concatenate((at, at[again])))


def _narrow(values: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 in the fewest bytes each."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def _wide(values: bytes, n: int) -> np.ndarray:
    return np.frombuffer(values, f"u{len(values) // n}").astype(np.int64)


class _Packer:
    """Keys with their documents and positions, packed by kind and the keys' last bits."""

    FIELDS = "kind int, least long, keys binary, docs binary, places binary"

    def __init__(self, kind: int = 0) -> None:
        self.kind, self.held, self.n = kind, [], 0

    def add(self, keys: np.ndarray, docs: np.ndarray, places: np.ndarray) -> None:
        if len(keys):
            self.held.append((keys, docs, places))
            self.n += len(keys)

    def rows(self, last: bool) -> list[tuple]:
        """What is to be sent: nothing before ``PACK`` keys came, unless it is the ``last``."""
        if not self.n or not last and self.n < PACK:
            return []
        keys, docs, places = (np.concatenate(c) for c in zip(*self.held, strict=True))
        self.held, self.n = [], 0
        group = (keys & (GROUPS - 1)).astype(np.uint16)
        order = np.argsort(group, kind="stable")
        least = int(docs.min())
        keys, docs, places = keys[order], _narrow((docs - least)[order]), _narrow(places[order])
        ends = np.cumsum(np.bincount(group, minlength=GROUPS))
        return [(self.kind + g, least, keys[a:b].tobytes(), docs[a:b].tobytes(), places[a:b].tobytes())
                for g, (a, b) in enumerate(zip(np.concatenate(([0], ends[:-1])).tolist(), ends.tolist(), strict=True)) if a < b]


def _keys(base: DataFrame) -> DataFrame:
    """Seeds (kinds below ``GROUPS``) and winnowed runs of ``MIN_WORDS`` words (the kinds after them), packed."""
    names = [c.split()[0] for c in _Packer.FIELDS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seeds, runs = _Packer(), _Packer(GROUPS)
        for batch in batches:
            ids = batch["doc_id"].to_numpy(np.int64)
            for h in hashed(batch["text"].tolist()):
                count = h.lengths()
                count[count < MIN_WORDS] = 0
                if not count.any():
                    continue
                first, docs = h.first[:-1], ids[h.start:h.stop]
                text, keys, at = seeds_of_texts(h.words, first, count)
                seeds.add(keys, docs[text], at - first[text])
                values = long_runs(h.words)
                text, at = minima_of_texts(values, first, np.maximum(count - MIN_WORDS + 1, 0), SPREAD)
                runs.add(values[at].view(np.int64), docs[text], at - first[text])
                for packer in (seeds, runs):
                    if rows := packer.rows(False):
                        yield pd.DataFrame(rows, columns=names)
        for packer in (seeds, runs):
            if rows := packer.rows(True):
                yield pd.DataFrame(rows, columns=names)

    return base.mapInPandas(run, _Packer.FIELDS)


def _matches(packed: DataFrame) -> DataFrame:
    """``doc_id, source, pos, source_pos``: occurrences of a key beside the first one in the least document that has it.

    Of the kinds from ``GROUPS`` on, a row with ``doc_id`` as its own source for
    each occurrence of a key that two documents have.
    """
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        sizes = [len(k) // 8 for k in group["keys"]]
        keys = np.frombuffer(b"".join(group["keys"]), np.int64)
        docs = np.concatenate([_wide(d, n) + least for d, n, least in zip(group["docs"], sizes, group["least"], strict=True)])
        places = np.concatenate([_wide(p, n) for p, n in zip(group["places"], sizes, strict=True)])
        order = np.argsort(keys)
        same = keys[order[1:]] == keys[order[:-1]]
        several = order[np.concatenate((same, [False])) | np.concatenate(([False], same))]
        keys, docs, places = keys[several], docs[several], places[several]
        order = np.lexsort((places, docs, keys))
        keys, docs, places = keys[order], docs[order], places[order]
        start = np.flatnonzero(np.concatenate((np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1])))
        count = np.diff(np.append(start, len(keys)))
        source = np.repeat(docs[start], count)
        if key[0] < GROUPS:
            wanted = docs > source
            source_places = np.repeat(places[start], count)[wanted]
            source = source[wanted]
        else:
            wanted = np.repeat(docs[start] != docs[start + count - 1], count)
            source, source_places = docs[wanted], places[wanted]
        return pd.DataFrame({"doc_id": docs[wanted], "source": source, "pos": places[wanted].astype(np.int32),
                             "source_pos": source_places.astype(np.int32)})

    return packed.groupBy("kind").applyInPandas(run, "doc_id long, source long, pos int, source_pos int")


def best_chains(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Chains (indices into the matches, in order) of matches at ``x`` and ``y``, best first, disjoint.

    A match follows another only where both positions ascend.  Matches of equal
    ``x`` are scored before any of them enters the tree.
    """
    n = len(x)
    order = np.lexsort((y, x))
    rank = np.searchsorted(np.unique(y), y) + 1
    size = int(rank.max()) + 1
    tree = [(-np.inf, -1)] * (size + 1)
    score, before = [0.0] * n, [-1] * n
    xs, ys, rs = x.tolist(), y.tolist(), rank.tolist()
    waiting: list[int] = []
    for i in order.tolist():
        if waiting and xs[waiting[0]] != xs[i]:
            for j in waiting:
                entry = (score[j] + GAP_COST * (xs[j] + ys[j]), j)
                r = rs[j]
                while r <= size:
                    if entry > tree[r]:
                        tree[r] = entry
                    r += r & -r
            waiting = []
        top, r = (-np.inf, -1), rs[i] - 1
        while r > 0:
            if tree[r] > top:
                top = tree[r]
            r -= r & -r
        gain = top[0] - GAP_COST * (xs[i] + ys[i])
        if gain > 0:
            score[i], before[i] = SEED_GAIN + gain, top[1]
        else:
            score[i] = SEED_GAIN
        waiting.append(i)
    used, chains = [False] * n, []
    for i in sorted(range(n), key=lambda i: (-score[i], xs[i], ys[i])):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = before[i]
        chain = np.array(chain[::-1], np.int64)
        for part in np.split(chain, np.flatnonzero(_gaps(x[chain], y[chain]) * GAP_COST > SEED_GAIN) + 1):
            if len(part) >= MIN_SEEDS:
                chains.append(part)
    return chains


def _gaps(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.diff(x) + np.diff(y)


def _chains(matches: DataFrame) -> DataFrame:
    """Chains, and the places of a document's shared runs (a row with the document as its own source)."""
    columns = ["doc_id", "source", "xs", "ys"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by pair; a pair may go on in the next batch."""
        def rows(part: pd.DataFrame) -> list[tuple]:
            doc, source = part["doc_id"].to_numpy(np.int64), part["source"].to_numpy(np.int64)
            x, y = part["pos"].to_numpy(np.int64), part["source_pos"].to_numpy(np.int64)
            inside = (doc[1:] == doc[:-1]) & (source[1:] == source[:-1])
            cuts = np.flatnonzero(~inside) + 1
            first, last = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(doc)]))
            dx, dy = np.diff(x), np.diff(y)
            # where all matches ascend in both texts without a gap that cuts a chain, they are the one best chain
            bad = np.concatenate(([0], np.cumsum(inside & ~((dx > 0) & (dy > 0) & ((dx + dy) * GAP_COST < SEED_GAIN)))))
            plain = bad[last - 1] == bad[first]
            places = doc[first] == source[first]
            wanted = places | (last - first >= MIN_SEEDS)
            x32, y32, out = x.astype(np.int32), y.astype(np.int32), []
            for a, b, one, own in zip(first[wanted].tolist(), last[wanted].tolist(), plain[wanted].tolist(),
                                      places[wanted].tolist(), strict=True):
                pair = (int(doc[a]), int(source[a]))
                if own:
                    out.append((*pair, np.unique(x32[a:b]), y32[:0]))
                elif one:
                    out.append((*pair, x32[a:b], y32[a:b]))
                else:
                    out += [(*pair, x32[a:b][c], y32[a:b][c]) for c in best_chains(x[a:b], y[a:b])]
            return out

        kept = None
        for batch in batches:
            if kept is not None:
                batch = pd.concat([kept, batch], ignore_index=True)
            if not len(batch):
                continue
            last = (batch["doc_id"] == batch["doc_id"].iloc[-1]) & (batch["source"] == batch["source"].iloc[-1])
            kept = batch[last]
            if not last.all():
                yield pd.DataFrame(rows(batch[~last]), columns=columns)
        if kept is not None:
            yield pd.DataFrame(rows(kept), columns=columns)

    return (matches.repartition("doc_id").sortWithinPartitions("doc_id", "source", "pos", "source_pos")
            .mapInPandas(run, "doc_id long, source long, xs array<int>, ys array<int>"))


def _extend(a: np.ndarray, b: np.ndarray) -> int:
    """How many words of ``a`` and ``b`` to take from their beginnings, allowing single differing words."""
    n = min(len(a), len(b))
    if not n:
        return 0
    total = np.cumsum(np.where(a[:n] == b[:n], 1, -MISMATCH))
    stop = np.flatnonzero(total < np.maximum.accumulate(np.maximum(total, 0)) - DROP)
    total = total[:int(stop[0])] if len(stop) else total
    return int(np.argmax(total)) + 1 if len(total) and total.max() > 0 else 0


def aligned(a: np.ndarray, b: np.ndarray, xs: np.ndarray, ys: np.ndarray) -> list[tuple[int, int, int, int, float]]:
    """Passages (start and end in ``a``, in ``b``, similarity) of a chain of seeds at ``xs`` and ``ys``."""
    x0, x1, y0, y1 = int(xs[0]), int(xs[-1]) + SEED_WORDS, int(ys[0]), int(ys[-1]) + SEED_WORDS
    left = _extend(a[:x0][::-1][:MARGIN], b[:y0][::-1][:MARGIN])
    right = _extend(a[x1:x1 + MARGIN], b[y1:y1 + MARGIN])
    x0, x1, y0, y1 = x0 - left, x1 + right, y0 - left, y1 + right
    if x1 - x0 < MIN_WORDS:
        return []
    longer = max(x1 - x0, y1 - y0)
    edits = edits_within(a[x0:x1], b[y0:y1], int(longer * (1 - SIMILARITY) + 1e-9))
    if edits is not None:
        return [(x0, x1, y0, y1, 1 - edits / longer)]
    if len(xs) < 2:
        return []
    cut = int(np.argmax(_gaps(xs, ys))) + 1
    return aligned(a, b, xs[:cut], ys[:cut]) + aligned(a, b, xs[cut:], ys[cut:])


def _cut(base: DataFrame, chains: DataFrame) -> DataFrame:
    """What chains and shared runs need of the texts, by ``kind``.

    ``CHAINS``: a chain with its document's words around it; ``SOURCES``: the
    words ``first`` to ``last`` of a source; from 0: all runs around the places
    of shared ones, packed.  Each text is shuffled once.
    """
    pair = F.col("source") != F.col("doc_id")
    own = chains.groupBy("doc_id").agg(F.collect_list(F.when(pair, F.struct("source", "xs", "ys"))).alias("chains"),
                                       F.first(F.when(~pair, F.col("xs")), ignorenulls=True).alias("places"))
    parts = (chains.where(pair).select(F.col("source").alias("doc_id"), F.struct(*_ends("ys")).alias("part"))
             .groupBy("doc_id").agg(F.collect_set("part").alias("parts")))
    needed = own.join(parts, "doc_id", "full_outer")
    fields = "source long, xs array<int>, ys array<int>, first int, last int, part binary"
    fields = f"kind int, doc_id long, {fields}, " + _Packer.FIELDS.split(", ", 1)[1]
    columns = [c.split()[0] for c in fields.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        runs, nothing = _Packer(), [None] * 4

        def packed(rows: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame([(kind, *[None] * 7, *rest) for kind, *rest in rows], columns=columns, dtype=object)

        for batch in batches:
            for h in hashed(batch["text"].tolist()):
                part, first, count = batch.iloc[h.start:h.stop], h.first[:-1], h.lengths()
                ids, bounds, out = part["doc_id"].to_numpy(np.int64), h.places, []
                for doc, chained, parts, start, n in zip(ids.tolist(), part["chains"], part["parts"], first.tolist(),
                                                         count.tolist(), strict=True):
                    def words(a: int, b: int, start: int = start, n: int = n) -> bytes:
                        return h.data[bounds[start + a]:bounds[start + min(b, n)]]
                    for c in chained if chained is not None else ():
                        a, b = max(int(c["xs"][0]) - MARGIN, 0), int(c["xs"][-1]) + SEED_WORDS + MARGIN
                        out.append((CHAINS, doc, c["source"], c["xs"], c["ys"], None, None, words(a, b), *nothing))
                    out += [(SOURCES, None, doc, None, None, p["first"], p["last"], words(p["first"], p["last"]), *nothing)
                            for p in (parts if parts is not None else ())]
                if out:
                    yield pd.DataFrame(out, columns=columns, dtype=object)
                shared = [(i, np.asarray(p)) for i, p in enumerate(part["places"]) if p is not None]
                if shared:
                    total = np.maximum(count - MIN_WORDS + 1, 0)
                    at = np.concatenate([p for _, p in shared])
                    text = np.repeat([i for i, _ in shared], [len(p) for _, p in shared])
                    opened, closed = (np.bincount(first[text] + edge, minlength=len(h.words) + 1) for edge in (
                        np.maximum(at + 1 - SPREAD, 0), np.minimum(at + SPREAD, total[text])))
                    near = np.flatnonzero(np.cumsum(opened - closed) > 0)
                    text = np.searchsorted(first, near, "right") - 1
                    runs.add(long_runs(h.words)[near].view(np.int64), ids[text], near - first[text])
                    if rows := runs.rows(False):
                        yield packed(rows)
        if rows := runs.rows(True):
            yield packed(rows)

    return (base.join(needed, "doc_id").select("doc_id", "text", "chains", "places", "parts")
            .mapInPandas(run, fields))


def _ends(places: str) -> list:
    """The words around a chain's seeds, ``MARGIN`` more at both ends."""
    return [F.greatest(F.element_at(places, 1) - MARGIN, F.lit(0)).alias("first"),
            (F.element_at(places, -1) + SEED_WORDS + MARGIN).alias("last")]


def _align(cuts: DataFrame) -> DataFrame:
    chains = cuts.where(F.col("kind") == CHAINS).select("doc_id", "source", "xs", "ys", "part", *_ends("ys"))
    sources = cuts.where(F.col("kind") == SOURCES).select("source", "first", "last", F.col("part").alias("source_part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in PASSAGES.split(", ")]
        kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64()}
        schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in PASSAGES.split(", ")])
        for batch in batches:
            if not batch.num_rows:
                continue
            words = []
            for side in ("part", "source_part"):
                words.append([h.words[a:b] for h in hashed(batch.column(side).to_pylist())
                              for a, b in zip(h.first[:-1].tolist(), h.first[1:].tolist(), strict=True)])
            chain = []
            for side in ("xs", "ys"):
                lists = batch.column(side)
                values, ends = lists.flatten().to_numpy().astype(np.int64), np.cumsum(lists.value_lengths().to_numpy())
                chain.append(np.split(values, ends[:-1]))
            out = []
            for doc, source, part, source_part, xs, ys in zip(
                    batch.column("doc_id").to_pylist(), batch.column("source").to_pylist(), *words, *chain, strict=True):
                a_from, b_from = max(int(xs[0]) - MARGIN, 0), max(int(ys[0]) - MARGIN, 0)
                for x0, x1, y0, y1, same in aligned(part, source_part, xs - a_from, ys - b_from):
                    out.append((doc, x0 + a_from, x1 + a_from, x1 - x0, source, y0 + b_from, y1 + b_from, same))
            columns = zip(*out, strict=True) if out else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return (chains.join(sources, ["source", "first", "last"])
            .select("doc_id", "source", "xs", "ys", "part", "source_part").mapInArrow(run, PASSAGES))


def long_runs(words: np.ndarray) -> np.ndarray:
    """A hash per run of ``MIN_WORDS`` words; none for a shorter text."""
    n = len(words) - MIN_WORDS + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    part, total = shingles(words, 8), np.zeros(n, np.uint64)
    for i in [*range(0, MIN_WORDS - 8, 8), MIN_WORDS - 8]:
        total = mix(total + part[i:i + n])
    return total


def _exact(cuts: DataFrame, found: DataFrame) -> DataFrame:
    """Exact repeats that no passage of ``found`` holds whole."""
    runs = cuts.where(F.col("kind") >= 0).select(*[c.split()[0] for c in _Packer.FIELDS.split(", ")])
    matches = _matches(runs).select("doc_id", "source", "pos", (F.col("source_pos") - F.col("pos")).alias("ahead"))
    by = Window.partitionBy("doc_id", "source", "ahead").orderBy("pos")
    spans = (matches.withColumn("before", F.col("pos") - F.lag("pos").over(by))
             .withColumn("island", F.sum(F.when(F.col("before") <= MIN_WORDS, 0).otherwise(1)).over(by))
             .groupBy("doc_id", "source", "ahead", "island")
             .agg(F.min("pos").alias("start_word"), (F.max("pos") + MIN_WORDS).alias("end_word")))
    held = found.groupBy("doc_id").agg(F.collect_list(F.struct("start_word", "end_word")).alias("held"))
    spans = spans.join(held, "doc_id", "left").where(~F.coalesce(F.exists("held", lambda h: (
        h["start_word"] <= F.col("start_word")) & (h["end_word"] >= F.col("end_word"))), F.lit(False)))
    return spans.select("doc_id", "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"),
                        F.col("source").alias("source_doc_id"), (F.col("start_word") + F.col("ahead")).alias("source_start"),
                        (F.col("end_word") + F.col("ahead")).alias("source_end"), F.lit(1.0).alias("similarity"))


def repeated_passages(docs: DataFrame) -> DataFrame:
    """A row per passage that an earlier document (by id) has too; positions count words."""
    nodes, later = text_nodes(docs)
    return ids_of(_repeated(nodes), later, "doc_id", "source_doc_id")


def _repeated(base: DataFrame) -> DataFrame:
    ship(base.sparkSession)
    chains = materialise(_chains(_matches(_keys(base))), "chains")
    cuts = materialise(_cut(base, chains), "cuts")
    found = materialise(_align(cuts), "aligned")
    return found.unionByName(_exact(cuts, found))


_WORD = re.compile(f"[^{SPACE_CLASS}]+")


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of the spans and the white space behind them."""
    at = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    out, done = [], 0
    for start, end in sorted(spans):
        start, end = at[min(start, len(at) - 1)], at[min(end, len(at) - 1)]
        out.append(text[done:max(start, done)])
        done = max(done, end)
    out.append(text[done:])
    return "".join(out)


def drop_passages(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages cut from all documents but the first that has them.

    ``n_chars`` is counted anew where the column exists; a document of which no
    word is left goes.
    """
    nodes, later = text_nodes(docs)
    spans = materialise(_repeated(nodes), "passages").groupBy(F.col("doc_id").alias("node")).agg(
        F.collect_list(F.struct("start_word", "end_word")).alias("_passages"))

    @F.pandas_udf("string")
    def cut(text: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([t if f is None else cut_words(t, [(s["start_word"], s["end_word"]) for s in f])
                          for t, f in zip(text, found, strict=True)], dtype=object)

    # else the filter below is planned with a cut of its own: a second Python worker for each task, kept after the task
    cut = cut.asNondeterministic()
    joined = rows_with_nodes(docs, later).join(spans, "node", "left")
    left = joined.withColumn("_text", F.when(F.col("_passages").isNotNull(), cut(text_of("row.text"), "_passages"))
                             .otherwise(F.col("row.text")))
    left = left.where(F.col("_passages").isNull() | F.col("_text").rlike(f"[^{SPACE_CLASS}]"))
    changed = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        changed["n_chars"] = F.when(F.col("_passages").isNotNull(), F.length("_text").cast(kind)).otherwise(
            F.col("row.n_chars"))
    return left.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
