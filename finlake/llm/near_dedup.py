"""Near-duplicate classes by order MinHash and banded alignment.

A text's k-mers are its runs of ``SHINGLE`` words, each labelled with how often
it occurred before in the text.  A sketch takes the ``PICKS`` least labelled
k-mers under its own hash and keeps them in text order; ``SKETCHES`` sketches
make a document's keys.  Documents that share a key are candidates: every
member of a bucket is paired with the bucket's least and greatest member, not
with all others.  A pair is a link if a banded alignment of the whole texts
finds a word edit similarity (1 - edits / words of the longer text) of at
least ``SIMILARITY``.  Members that are in neither end's class meet two other
members of their buckets, drawn by a hash, in the next round, and so on while
rounds join many: these rounds make large groups of copies one class.

What is left is settled exactly.  In a bucket that still holds several classes
every pair of members of different classes counts, found by a prefix filter:
texts within the limit of edits share at least ``SHARED`` of each one's rarest
words, as many as the limit of edits and ``SHARED`` more, in any one order of
the words.  A word that at most ``LIST`` of these texts hold brings them
together.  Texts with a word that more of them hold meet in their buckets, by
blocks of about ``ROOM`` words: two are aligned if they have enough words in
common, and a link between two classes is enough for a pair of blocks.  Classes
are the connected components of the links.

Texts with the same words in the same order are one node from the start, so a
large group of copies costs a row each, and buckets are reduced before they
are shuffled.

Defined results: null text is empty, and texts without words are copies of
each other; rows that share a ``doc_id`` but not their text are documents of
their own, the greater texts later than all ids; a null ``doc_id``
is in no class (``class_id`` null, kept); repeated rows are repeated in the
result; texts of any length are compared whole; an empty table gives an empty
one; other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import ids_of, materialise, rows_with_nodes, ship, text_nodes, text_of
from finlake.llm.components import components
from finlake.llm.wordhash import edits_within, hashed, mix, shingles

SHINGLE = 5
PICKS = 2
SKETCHES = 20
SIMILARITY = 0.8
PIECE = 1 << 16           # k-mers hashed at a time
SHARED = 3                # rarest words that two texts must share before they are aligned
COUNTERS = 1 << 16        # counters of the words' frequencies; they only set the order
LIST = 128                # texts that hold a rare word at most; a word that more hold is left to blocks
PART = 1 << 15            # rare words of texts whose holders are paired together, about
STRIPE = 1 << 14          # words of a text that meets all others in one row
ROOM = 1 << 17            # words of a block's texts, about
EACH = 256                # words that a text counts for besides its own
_MOST = np.uint64(2**64 - 1)
FEW = 0.05                # share of the open members under which a round's links end the rounds


def occurrences(values: np.ndarray) -> np.ndarray:
    """The values labelled with how often each occurred before."""
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    first = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    run = np.arange(len(ranked)) - np.maximum.accumulate(np.where(first, np.arange(len(ranked)), 0))
    occurrence = np.empty(len(values), np.uint64)
    occurrence[order] = run
    return mix(values + occurrence * np.uint64(0x9E3779B97F4A7C15))


def order_sketches(words: np.ndarray, k: int = SHINGLE, picks: int = PICKS, sketches: int = SKETCHES) -> np.ndarray:
    """A key per sketch (``int64``); no key for a text without words."""
    kmers = shingles(words, k)
    if not len(kmers):
        return np.zeros(0, np.int64)
    labelled = occurrences(kmers)
    seeds = mix(np.arange(1, sketches + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    take = min(picks, len(kmers))
    best, at = np.zeros((0, sketches), np.uint64), np.zeros((0, sketches), np.int64)
    for start in range(0, len(labelled), PIECE):
        piece = labelled[start:start + PIECE, None]
        value = (piece ^ seeds) * (seeds | np.uint64(1))
        value ^= value >> np.uint64(32)
        n = min(take, len(value))
        low = np.argpartition(value, n - 1, axis=0)[:n] if n < len(value) else np.tile(
            np.arange(n)[:, None], (1, sketches))
        best = np.concatenate((best, np.take_along_axis(value, low, axis=0)))
        at = np.concatenate((at, low + start))
        keep = np.argsort(best, axis=0, kind="stable")[:take]
        best, at = np.take_along_axis(best, keep, axis=0), np.take_along_axis(at, keep, axis=0)
    at = np.sort(at, axis=0)
    key = seeds.copy()
    for row in at:
        key = mix(key + kmers[row])
    return key.view(np.int64)


def sketches_of_texts(words: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """``order_sketches`` of the texts with the words ``first[i]`` to ``first[i + 1]``, all texts at a time."""
    count = np.diff(first) - SHINGLE + 1
    usual = np.flatnonzero((count >= PICKS) & (count <= PIECE))
    keys = {i: order_sketches(words[first[i]:first[i + 1]]) for i in np.flatnonzero((count < PICKS) | (count > PIECE)).tolist()}
    if len(usual):
        count = count[usual]
        start = np.cumsum(count) - count
        text = np.repeat(np.arange(len(usual)), count)
        kmers = shingles(words, SHINGLE)[np.arange(len(text)) + np.repeat(first[:-1][usual] - start, count)]
        labelled = mix(kmers)
        marked = kmers ^ mix(text.astype(np.uint64) + np.uint64(1))      # equal where a text repeats a k-mer
        ranked = np.sort(marked)
        again = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
        if len(again):
            for i in np.unique(text[np.isin(marked, again)]).tolist():
                own = slice(start[i], start[i] + count[i])
                labelled[own] = occurrences(kmers[own])
        seeds = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
        found = np.empty((len(usual), SKETCHES), np.uint64)
        for k, seed in enumerate(seeds):
            value = (labelled ^ seed) * (seed | np.uint64(1))
            value ^= value >> np.uint64(32)
            at = np.empty((PICKS, len(usual)), np.int64)
            for pick in range(PICKS):
                least = np.flatnonzero(value == np.repeat(np.minimum.reduceat(value, start), count))
                at[pick] = least[np.searchsorted(least, start)]
                value[at[pick]] = _MOST
            key = np.full(len(usual), seed)
            for row in np.sort(at, axis=0):
                key = mix(key + kmers[row])
            found[:, k] = key
        keys.update(zip(usual.tolist(), found.view(np.int64), strict=True))
    return [keys[i] for i in range(len(first) - 1)]


def _sketch(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            digests, keys = [], []
            for h in hashed(batch["text"].tolist()):
                digests += [hashlib.blake2b(h.words[a:b].tobytes(), digest_size=16).digest()
                            for a, b in zip(h.first[:-1].tolist(), h.first[1:].tolist(), strict=True)]
                keys += sketches_of_texts(h.words, h.first)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "digest": digests, "keys": keys}).astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInPandas(
        run, "doc_id long, digest binary, keys array<long>")


def _labelled(df: DataFrame, column: str, classes: DataFrame | None, label: str) -> DataFrame:
    """``df`` with the present class of the node in ``column``; a node in no class is its own."""
    if classes is None:
        return df.withColumn(label, F.col(column))
    known = classes.select(F.col("node").alias(column), F.col("class_id").alias("_class"))
    return df.join(known, column, "left").withColumn(label, F.coalesce("_class", column)).drop("_class")


def _hubs(members: DataFrame, turn: int) -> DataFrame:
    """Two members of each bucket: first the least and the greatest, in later turns two drawn by a hash."""
    by = F.col("node") if turn == 0 else F.xxhash64(F.col("node"), F.lit(turn))
    return (members.groupBy("key").agg(F.min_by("node", by).alias("low"), F.max_by("node", by).alias("high"))
            .where("low <> high"))


def _words(texts: list[str]) -> Iterator[np.ndarray]:
    """The word hashes of each text."""
    for h in hashed(texts):
        for a, b in zip(h.first[:-1].tolist(), h.first[1:].tolist(), strict=True):
            yield h.words[a:b]


def _verify(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose texts align well enough."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sides = []
            for side in ("a", "b"):
                # rows come by text, and each one's words are hashed once
                new = (batch[side] != batch[side].shift()).to_numpy()
                words = list(_words(batch.loc[new, f"text_{side}"].tolist()))
                sides.append([words[i] for i in np.cumsum(new) - 1])
            ok = []
            for a, b in zip(*sides, strict=True):
                # in whole edits, so that a similarity of exactly the limit counts
                limit = int(max(len(a), len(b)) * (1 - similarity) + 1e-9)
                ok.append(edits_within(a, b, limit) is not None)
            yield batch.loc[ok, ["a", "b"]]

    joined = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
              .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"))
    return joined.select("a", "b", "text_a", "text_b").mapInPandas(run, "a long, b long")


def _frequencies(texts: DataFrame) -> np.ndarray:
    """How many texts hold a word, by the word's counter; words that share a counter are counted together."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for words in _words(batch["text"].tolist()):
                if len(words):
                    total += np.bincount((occurrences(words) % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"at": at, "n": total[at]})

    found = texts.select("text").mapInPandas(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(COUNTERS, np.int64)
    counts[found["at"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return counts


def rarest(words: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """The labelled words of which any text of at least that similarity shares ``SHARED``."""
    labelled = occurrences(words) if len(words) else words
    order = np.lexsort((labelled, counts[(labelled % np.uint64(len(counts))).astype(np.int64)]))
    return labelled[order[:int(len(words) * (1 - similarity) + 1e-9) + SHARED]]


def overlaps(words: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """How many words each text has in common with each of the others, each word as often as in both."""
    every = np.concatenate([occurrences(w) if len(w) else w for w in others])
    whose = np.repeat(np.arange(len(others)), [len(w) for w in others])
    order = np.argsort(every)
    every, whose = every[order], whose[order]
    common = np.zeros((len(words), len(others)), np.int64)
    for i, w in enumerate(words):
        labelled = occurrences(w) if len(w) else w
        low, high = np.searchsorted(every, labelled), np.searchsorted(every, labelled, "right")
        times = high - low
        at = np.arange(times.sum()) + np.repeat(low - (np.cumsum(times) - times), times)
        common[i] = np.bincount(whose[at], minlength=len(others))
    return common


def _by_rare_words(words: DataFrame, parts: int, similarity: float) -> DataFrame:
    """Pairs that share ``SHARED`` of the given rows' words, each of which few texts hold.

    The words are dealt out in parts; what an open text meets in a part travels as one row.
    """
    def meet(part: pd.DataFrame) -> pd.DataFrame:
        word = part["word"].to_numpy(np.int64)
        order = np.argsort(word, kind="stable")
        word = word[order]
        node, own, n_words = (part[c].to_numpy(np.int64)[order] for c in ("node", "own", "n_words"))
        is_open = part["open"].to_numpy(bool)[order]
        x = np.flatnonzero(is_open)
        low = np.searchsorted(word, word[x])
        times = np.searchsorted(word, word[x], "right") - low
        other = np.arange(times.sum()) + np.repeat(low - (np.cumsum(times) - times), times)
        x = np.repeat(x, times)
        longer, shorter = np.maximum(n_words[x], n_words[other]), np.minimum(n_words[x], n_words[other])
        ok = ((own[x] != own[other]) & (~is_open[other] | (node[x] > node[other]))
              & (longer - shorter <= longer * (1 - similarity) + 1e-9))
        x, other = x[ok], node[other[ok]]
        # what a long text meets is dealt out in stripes of the others
        stripe = other % np.maximum(-(-n_words[x] // STRIPE), 1)
        order = np.lexsort((stripe, node[x]))
        x, other, stripe = node[x][order], other[order], stripe[order]
        new = np.ones(len(x), bool)
        new[1:] = (x[1:] != x[:-1]) | (stripe[1:] != stripe[:-1])
        edge = np.flatnonzero(new)
        return pd.DataFrame({"node": x[edge], "stripe": stripe[edge],
                             "met": [other[a:b].tobytes() for a, b in zip(edge, np.append(edge, len(x))[1:], strict=True)]})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for node, met in zip(batch["node"].tolist(), batch["met"], strict=True):
                others, common = np.unique(np.frombuffer(b"".join(met), np.int64), return_counts=True)
                b.append(others[common >= SHARED])
                a.append(np.full(len(b[-1]), node))
            a, b = np.concatenate(a), np.concatenate(b)
            yield pd.DataFrame({"a": np.maximum(a, b), "b": np.minimum(a, b)})

    return (words.groupBy(F.pmod("word", F.lit(parts))).applyInPandas(meet, "node long, stripe long, met binary")
            .groupBy("node", "stripe").agg(F.collect_list("met").alias("met")).select("node", "met")
            .mapInPandas(count, "a long, b long").distinct())


def _in_blocks(members: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links between members ``key, node, own, open, n_words`` of a bucket of which one is open, a link for two classes at least.

    Members are dealt out in blocks, and blocks meet: two texts are aligned if
    they have as many words in common as the limit of edits asks for, unless
    an earlier bucket holds both or their classes are linked already.
    """
    def room(which: Column) -> Column:
        return F.ceil(F.sum(F.when(which, F.col("n_words") + EACH).otherwise(0)) / ROOM).cast("int")

    blocks = members.groupBy("key").agg(room(F.col("open")).alias("opens"), room(~F.col("open")).alias("others"))
    dealt = F.xxhash64("node", "key")
    cells = (members.join(blocks.where("opens > 0"), "key")
             .withColumn("block", F.when(F.col("open"), F.pmod(dealt, F.col("opens")))
                         .otherwise(F.col("opens") + F.pmod(dealt, F.greatest("others", F.lit(1)))).cast("int"))
             .withColumn("with", F.explode(F.sequence(
                 F.lit(0), F.col("opens") - 1 + F.when(F.col("open"), F.col("others")).otherwise(0))))
             .select("key", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "node", "own"))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [w.tobytes() for w in _words(batch["text"].tolist())]
            yield pd.DataFrame({"node": batch["node"], "keys": batch["keys"], "words": words})

    keys = members.groupBy("node").agg(F.collect_set("key").alias("keys"))
    coded = materialise(texts.join(keys, "node").select("node", "keys", "text").mapInPandas(
        pack, "node long, keys array<long>, words binary"), "rest-words")

    def run(cell: pd.DataFrame) -> pd.DataFrame:
        key, same = cell["key"].iloc[0], cell["i"].iloc[0] == cell["j"].iloc[0]
        a = cell[cell["block"] == cell["i"]]
        b = cell[cell["block"] == cell["j"]]
        words, others = ([np.frombuffer(w, np.uint64) for w in side["words"]] for side in (a, b))
        nodes, other_nodes = a["node"].to_numpy(), b["node"].to_numpy()
        own, other_own = a["own"].to_numpy(), b["own"].to_numpy()
        n, m = (np.array([len(w) for w in side], np.int64) for side in (words, others))
        longer = np.maximum(n[:, None], m)
        limit = (longer * (1 - similarity) + 1e-9).astype(np.int64)
        meet = (own[:, None] != other_own) & (np.abs(n[:, None] - m) <= limit)
        if same:
            meet &= nodes[:, None] > other_nodes
        # an earlier bucket that holds both has them
        earlier = [[k[k < key] for k in side["keys"]] for side in (a, b)]
        every = np.unique(np.concatenate([*earlier[0], *earlier[1]]))
        held = [np.zeros((len(side), len(every)), np.float32) for side in earlier]
        for has, side in zip(held, earlier, strict=True):
            has[np.repeat(np.arange(len(side)), [len(k) for k in side]), np.searchsorted(every, np.concatenate(side))] = 1
        meet &= held[0] @ held[1].T == 0
        rows, columns = np.flatnonzero(meet.any(axis=1)), np.flatnonzero(meet.any(axis=0))
        links, joined = [], set()
        if len(rows):
            common = overlaps([words[i] for i in rows], [others[j] for j in columns])
            at = np.ix_(rows, columns)
            good = meet[at] & (longer[at] - common <= limit[at])
            x, y = np.nonzero(good)
            for k in np.argsort(-common[x, y], kind="stable"):
                i, j = rows[x[k]], columns[y[k]]
                classes = (own[i], other_own[j])
                if classes not in joined and edits_within(words[i], others[j], int(limit[i, j])) is not None:
                    joined.add(classes)
                    links.append((max(nodes[i], other_nodes[j]), min(nodes[i], other_nodes[j])))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return cells.join(coded, "node").groupBy("key", "i", "j").applyInPandas(run, "a long, b long").distinct()


def _rest(shared: DataFrame, classes: DataFrame | None, texts: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Pairs ``a, b`` to be aligned and links ``a, b``, which join all that members of different classes of a bucket join."""
    members = materialise(_labelled(shared, "node", classes, "own"), "bucket-classes")
    sizes = members.groupBy("key", "own").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("key").agg(F.max_by("own", F.struct("n", "own")).alias("main"), F.count(F.lit(1)).alias("classes"),
                                    F.sum("n").alias("size")).where("classes > 1 AND size > 3").select("key", "main")
    # of two members of different classes at least one is not in the bucket's main class
    members = members.join(main, "key").select("key", "node", "own", (F.col("own") != F.col("main")).alias("open"))
    left = materialise(members.groupBy("node", "own").agg(F.max("open").alias("open")), "rest")
    held = materialise(texts.join(left, "node"), "rest-texts")
    counts = _frequencies(held)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hashes = list(_words(batch["text"].tolist()))
            words = [rarest(h, counts, similarity).view(np.int64) for h in hashes]
            times = [len(w) for w in words]
            yield pd.DataFrame({
                "word": np.concatenate([*words, np.zeros(0, np.int64)]), "node": np.repeat(batch["node"].to_numpy(np.int64), times),
                "own": np.repeat(batch["own"].to_numpy(np.int64), times),
                "open": np.repeat(batch["open"].to_numpy(bool), times),
                "n_words": np.repeat(np.array([len(h) for h in hashes], np.int64), times)})

    words = materialise(held.mapInPandas(run, "word long, node long, own long, open boolean, n_words long"), "rare-words")
    frequent = materialise(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > LIST)
                           .select("word"), "frequent-words")
    # two texts share either SHARED words that few hold or a word that many hold
    few = words.join(frequent, "word", "left_anti")
    many = words.join(frequent, "word", "left_semi").groupBy("node").agg(F.first("n_words").alias("n_words"))
    met = materialise(members.join(many, "node"), "rest-members")
    return _by_rare_words(few, words.count() // PART + 1, similarity), _in_blocks(met, texts, similarity)


def near_classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per input row: doc_id, class_id (doc_id of the first document of the class), kept."""
    nodes, later = text_nodes(docs)
    classes = _classes(nodes, similarity)
    rows = rows_with_nodes(docs.select("doc_id", "text"), later).select(F.col("row.doc_id").cast("long").alias("doc_id"), "node")
    labelled = rows.join(classes, "node", "left").select(
        "doc_id", F.coalesce("class_id", "node").alias("class_id"),
        F.coalesce(F.coalesce("class_id", "node") == F.col("node"), F.lit(True)).alias("kept"))
    return ids_of(labelled, later, "class_id")


def _classes(docs: DataFrame, similarity: float) -> DataFrame:
    """(node, class_id) of the documents that are in a class with others; a class has its least node's number."""
    ship(docs.sparkSession)
    known = materialise(_sketch(docs), "sketches")
    nodes = known.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("keys").alias("keys"))
    members = materialise(nodes.select("node", F.explode(F.array_distinct("keys")).alias("key")), "members")
    shared = members.join(members.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"))
                          .where("low <> high").select("key"), "key", "left_semi").select("key", "node")
    shared = materialise(shared, "buckets")

    texts = materialise(
        docs.select(F.col("doc_id").cast("long").alias("node"), text_of().alias("text"))
        .join(shared.select("node").distinct(), "node", "left_semi")
        .groupBy("node").agg(F.min("text").alias("text")), "candidate-texts")

    # documents with the same words are links from the start
    links = known.join(nodes.select("digest", "node"), "digest").where("doc_id <> node").select(
        F.col("doc_id").alias("a"), F.col("node").alias("b")).distinct()
    tried, open_members, classes, turn = None, shared, None, 0
    while True:
        hubs = _hubs(shared, turn)
        met = open_members.join(hubs, "key").select("node", F.explode(F.array("low", "high")).alias("hub"))
        met = _labelled(_labelled(met.where("node <> hub").distinct(), "node", classes, "own"), "hub", classes, "other")
        pairs = met.where("own <> other").select(
            F.greatest("node", "hub").alias("a"), F.least("node", "hub").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = materialise(pairs, "pairs")
        found = materialise(_verify(pairs, texts, similarity), "found")
        joined = found.count()
        if joined:
            links = links.unionByName(found)
            classes = materialise(components(links), "classes")
        tried = pairs if tried is None else tried.unionByName(pairs)
        if turn and joined <= FEW * open_members.select("node").distinct().count():
            break
        ends = _labelled(_labelled(hubs, "low", classes, "low_class"), "high", classes, "high_class")
        open_members = materialise(
            _labelled(open_members, "node", classes, "own").join(ends, "key")
            .where("own <> low_class AND own <> high_class").select("key", "node"), "open")
        if open_members.isEmpty():
            break
        turn += 1
    pairs, found = _rest(shared, classes, texts, similarity)
    found = materialise(found, "rest-links")
    pairs = materialise(pairs.join(tried, ["a", "b"], "left_anti"), "rest-pairs")
    return materialise(components(links.unionByName(found).unionByName(_verify(pairs, texts, similarity))), "classes")


def drop_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without the documents whose class has an earlier one; of equal rows (id and text) one stays."""
    nodes, later = text_nodes(docs)
    lost = _classes(nodes, similarity).where("node <> class_id").select("node")
    left = rows_with_nodes(docs, later).join(lost, "node", "left_anti")
    if later is not None:
        left = left.where("node IS NULL").unionByName(left.where("node IS NOT NULL").dropDuplicates(["node"]))
    return left.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
