"""BPE encoding through a table of distinct words, and decoding through a table of pieces.

Words are the stretches that the byte-level tokenizer can't join: a run of
non-space characters with one leading space, or a run of white space.  Spark
groups the documents into content-addressed blocks of about ``BLOCK_CHARS``
characters.  Words go one of two ways, and give the same ids by either:

* the ``HOT_WORDS`` most frequent words of a bounded sample of documents are
  encoded once and broadcast (a bounded table; it only saves shuffling),
* every other word is sent once per block to the owner of the word (a hash of
  it), which encodes each distinct word once and returns ids to the blocks;
  both ways many words or ids go in a compressed row.  An owner's ids come in
  the order of the block's sorted words, so the words are not sent back.

A block then joins the ids back by position.  Decoding joins ids with the
vocabulary's pieces, a table of fixed size, in every task.

Defined results: null text is empty and has no ids; repeated rows give
repeated results; an empty table gives an empty one; other columns do not
matter; the special token's own string in a text becomes its id, as in the
library.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake.llm.common import ship, text_of
from finlake.llm.tokens import byte_letters, byte_tokenizer_path, load

BLOCK_CHARS = 4_000_000
HOT_WORDS = 1 << 18
SAMPLE_DOCS = 40_000
OWNER_CHARS, OWNERS = 16_000_000, 16   # characters of the corpus per owner of words, and owners besides

_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WORD = re.compile(rf" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


def split_words(text: str, special: tuple[str, ...] = ("<|endoftext|>",)) -> list[str]:
    """Words of a text in order; joined they are the text."""
    if not any(s in text for s in special):
        return _WORD.findall(text)
    out = []
    for part in re.split("(" + "|".join(map(re.escape, special)) + ")", text):
        out += [part] if part in special else _WORD.findall(part)
    return out


def _encode_words(tokenizer, words: list[str]) -> list[bytes]:
    got = tokenizer.encode_batch_fast(words, add_special_tokens=False)
    return [np.array(e.ids, "<u4").tobytes() for e in got]


def owner_of(word: str, owners: int) -> int:
    """The owner of a word, the same in every task."""
    return zlib.crc32(word.encode()) % owners


def _narrow(x: np.ndarray) -> np.ndarray:
    """Whole numbers in as few bytes each as the greatest needs."""
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


def _joined(words: list[str]) -> tuple[str, np.ndarray]:
    return "".join(words), _narrow(np.array([len(w) for w in words]))


def _split(text: str, lengths: np.ndarray) -> list[str]:
    ends = np.cumsum(lengths, dtype=np.int64).tolist()
    return [text[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def _hot_words(base: DataFrame, n_docs: int, path: str) -> dict[str, bytes]:
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                seen.update(split_words(text))
        yield pd.DataFrame({"word": list(seen), "n": list(seen.values())}).astype({"word": "object", "n": "int64"})

    share = n_docs // SAMPLE_DOCS + 1
    sample = base.where(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0).select("text")
    top = (sample.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "word").limit(HOT_WORDS).select("word"))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = load(path)
        for batch in batches:
            yield batch.assign(ids=_encode_words(tokenizer, list(batch["word"])))

    got = top.repartition(12).mapInPandas(encode, "word string, ids binary").toArrow()
    return dict(zip(got["word"].to_pylist(), got["ids"].to_pylist(), strict=True))


def encode(docs: DataFrame, tokenizer_path: str | None = None, back: bool = False) -> DataFrame:
    """doc_id and ids (``array<int>``) of every row, without added special tokens.

    ``back`` adds ``decoded``, the text of the ids, in the same pass.
    """
    ship(docs.sparkSession)
    import zstandard
    spark = docs.sparkSession
    path = tokenizer_path or byte_tokenizer_path()
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    size = base.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text").cast("long")).alias("chars")).first()
    hot = spark.sparkContext.broadcast(_hot_words(base, size["n"], path))
    by_id = spark.sparkContext.broadcast(pieces(path)) if back else None
    n_blocks, n_owners = (size["chars"] or 0) // BLOCK_CHARS + 1, (size["chars"] or 0) // OWNER_CHARS + OWNERS
    base = base.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compress = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            blocks, data = [], []
            for block, rows in batch.groupby("block"):
                ids = [None if pd.isna(x) else int(x) for x in rows["doc_id"]]
                blocks.append(block)
                data.append(compress(pickle.dumps((ids, list(rows["text"])))))
            yield pd.DataFrame({"block": blocks, "data": data}).astype({"block": "int64"})

    def rare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, compress = hot.value, zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            sent: dict[int, dict[int, list[str]]] = {}
            for block, texts in batch.groupby("block")["text"]:
                for w in sorted({w for t in texts for w in split_words(t) if w not in known}):
                    sent.setdefault(owner_of(w, n_owners), {}).setdefault(block, []).append(w)
            rows = [compress(pickle.dumps([(b, *_joined(w)) for b, w in blocks.items()])) for blocks in sent.values()]
            yield pd.DataFrame({"owner": list(sent), "data": rows}).astype({"owner": "int64"})

    loaded: list = []         # the tokenizer, once per task

    def answer(asked: pd.DataFrame) -> pd.DataFrame:
        """The ids of an owner's words for each block, in the order of the block's sorted words."""
        compress, expand = zstandard.ZstdCompressor(level=3).compress, zstandard.ZstdDecompressor().decompress
        words, blocks, times = [], [], []
        for data in asked["data"]:
            for block, text, lengths in pickle.loads(expand(data)):
                words += _split(text, lengths)
                blocks.append(block)
                times.append(len(words))
        distinct = sorted(set(words))
        if not loaded:
            loaded.append(load(path))
        ids = _encode_words(loaded[0], distinct)
        rank = {w: i for i, w in enumerate(distinct)}
        at = np.fromiter(map(rank.__getitem__, words), np.int64, len(words))
        pairs = np.unique(np.repeat(np.array(blocks, np.int64), np.diff(times, prepend=0)) * len(distinct) + at)
        block, at = np.divmod(pairs, len(distinct))
        starts = np.flatnonzero(np.diff(block, prepend=-1))
        rows = []
        for mine in np.split(at, starts[1:]):
            got = [ids[i] for i in mine.tolist()]
            rows.append(compress(pickle.dumps((_narrow(np.array([len(g) // 4 for g in got])),
                                               _narrow(np.frombuffer(b"".join(got), "<u4"))))))
        return pd.DataFrame({"block": block[starts], "owner": asked["owner"].iloc[0], "ids": rows})

    def join(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        expand = zstandard.ZstdDecompressor().decompress
        get, new, own = hot.value.get, set(), {}
        ids, parts, out, texts_back = [], [], [], []
        for data in left["data"]:
            doc_ids, texts = pickle.loads(expand(data))
            ids += doc_ids
            for text in texts:
                parts.append([get(w) or w for w in split_words(text)])     # ids, or the word itself
                new.update([w for w in parts[-1] if w.__class__ is str])
        mine: dict[int, list[str]] = {}
        for w in sorted(new):
            mine.setdefault(owner_of(w, n_owners), []).append(w)
        for owner, data in zip(right["owner"], right["ids"], strict=True):
            lengths, sent = pickle.loads(expand(data))
            sent, ends = sent.astype("<u4").tobytes(), (4 * np.cumsum(lengths, dtype=np.int64)).tolist()
            own.update({w: sent[a:b] for w, a, b in zip(mine[owner], [0, *ends[:-1]], ends, strict=True)})
        for part in parts:
            got = b"".join([own[w] if w.__class__ is str else w for w in part])
            out.append(np.frombuffer(got, "<u4").astype(np.int32))
            if back:
                texts_back.append(decoded(out[-1], by_id.value))
        rows = pd.DataFrame({"doc_id": pd.array(ids, "Int64"), "ids": out})
        return rows.assign(decoded=texts_back) if back else rows

    texts = base.select("doc_id", "text", "block").mapInPandas(pack, "block long, data binary")
    words = (base.select("text", "block").mapInPandas(rare, "owner long, data binary")
             .groupBy("owner").applyInPandas(answer, "block long, owner long, ids binary"))
    return (texts.groupBy("block").cogroup(words.groupBy("block"))
            .applyInPandas(join, "doc_id long, ids array<int>" + (", decoded string" if back else "")))


def pieces(tokenizer_path: str | None = None) -> list[bytes]:
    """The bytes that each id stands for."""
    tokenizer = load(tokenizer_path or byte_tokenizer_path())
    back = {c: b for b, c in byte_letters().items()}
    out = [b""] * tokenizer.get_vocab_size()
    for piece, i in tokenizer.get_vocab().items():
        out[i] = bytes(back[c] for c in piece) if all(c in back for c in piece) else piece.encode()
    return out


def decoded(ids: np.ndarray, table: list[bytes]) -> str:
    """Ids joined with the table of pieces."""
    return b"".join(map(table.__getitem__, ids.tolist())).decode("utf-8", "replace")


def decode(encoded: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """``encoded`` with the column ``decoded``: the text of ``ids``."""
    ship(encoded.sparkSession)
    table = encoded.sparkSession.sparkContext.broadcast(pieces(tokenizer_path))
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.array([decoded(x.values.to_numpy(), table.value) if x.is_valid else None
                             for x in batch.column("ids")], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, rows], names=schema.names)

    return encoded.mapInArrow(run, schema)
