"""Length-delimited binary records of token ids with an offset index.

Data file: per document ``u64 length | u32 masked crc(length) | ids | u32
masked crc(ids)``, little-endian; the ids are unsigned 16- or 32-bit integers,
whichever holds the vocabulary.  The checksum is CRC-32, masked as
``rotate_right(crc, 15) + 0xa282ead8`` so that a checksum of checksummed data
is no fixed point.  Index file: a fixed-size entry per record (offset, tokens
before it in the file, tokens, id, whether the id is null), so any record can
be read alone and in any order.

Files are written by Spark tasks straight to the shared folder: documents are
range-partitioned and sorted by id, a task streams its range into a file under
a name of its own and renames it at the end.  A task that runs again writes
the same bytes.

Defined results: null text is empty and has the end id only; a null id comes
first; repeated ids are all written, ordered by text; an empty table gives no
records; other columns do not matter.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.llm.common import ship, text_of
from finlake.llm.tokens import spaced_encoder, word_tokenizer_path

END_ID = 2
ENTRY = np.dtype([("offset", "<u8"), ("before", "<u8"), ("tokens", "<u4"), ("id", "<i8"), ("no_id", "u1")])
CHUNK_RECORDS = 4096      # records that one read task takes
OUT_ROWS = 256
MANIFEST = "part long, data string, index string, n_records long, n_tokens long"
RECORDS = "doc_id long, start long, n_tokens long, ids binary"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(data: bytes) -> bytes:
    size = struct.pack("<Q", len(data))
    return b"".join((size, struct.pack("<I", masked(size)), data, struct.pack("<I", masked(data))))


def unframe(block: bytes) -> bytes:
    """The data of one frame; raises where a checksum doesn't hold."""
    (length,) = struct.unpack_from("<Q", block)
    if struct.unpack_from("<I", block, 8)[0] != masked(block[:8]) or len(block) != length + 16:
        raise OSError("record length is damaged")
    data = block[12:12 + length]
    if struct.unpack_from("<I", block, 12 + length)[0] != masked(data):
        raise OSError("record data is damaged")
    return data


def _filesystem(uri: str):
    """File system and path of a folder that driver and executors share."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def write_records(docs: DataFrame, path: str, tokenizer_path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write the encoded documents under ``path``; a manifest row per file, kept as Parquet beside the files."""
    ship(docs.sparkSession)
    spark = docs.sparkSession
    tokenizer = tokenizer_path or word_tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = spaced_encoder(tokenizer)
        wide = encoder.tokenizer.get_vocab_size() > 1 << 16
        dtype = np.dtype("<u4" if wide else "<u2")
        end = np.array([end_id], "<u4").tobytes()
        context = TaskContext.get()
        filesystem, root = _filesystem(path)
        filesystem.create_dir(root, recursive=True)
        name = f"{root}/part-{context.partitionId():06d}"
        own = f"{root}/.attempt-{context.taskAttemptId()}-{context.partitionId():06d}"
        offset = before = count = 0
        with filesystem.open_output_stream(f"{own}.rec") as data, filesystem.open_output_stream(f"{own}.idx") as index:
            for batch in batches:
                for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                    doc_id = doc_id.as_py()
                    ids = np.frombuffer(encoder.encode(text.as_py()) + end, "<u4").astype(dtype)
                    block = frame(ids.tobytes())
                    data.write(block)
                    index.write(np.array([(offset, before, len(ids), doc_id or 0, doc_id is None)], ENTRY).tobytes())
                    offset, before, count = offset + len(block), before + len(ids), count + 1
        for kind in ("rec", "idx"):
            filesystem.move(f"{own}.{kind}", f"{name}.{kind}")
        base = path.rstrip("/") + name[len(root):]
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (
            context.partitionId(), f"{base}.rec", f"{base}.idx", count, before)],
            names=["part", "data", "index", "n_records", "n_tokens"])

    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
            .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    rows.mapInArrow(run, MANIFEST).write.parquet(f"{path}/_manifest")
    return spark.read.schema(MANIFEST).parquet(f"{path}/_manifest")


def read_records(spark: SparkSession, path: str, seed: int | None = None) -> DataFrame:
    """The records under ``path``: doc_id, start, n_tokens, ids (unsigned 32-bit, little-endian).

    ``start`` counts the ids of all records before it.  With ``seed`` each
    chunk of records is read in an order drawn from it, through the index.
    """
    ship(spark)
    # a row per file, as a file listing has; their token counts give each file's first position
    files = sorted((r for r in spark.read.schema(MANIFEST).parquet(f"{path}/_manifest").collect() if r["n_records"]),
                   key=lambda r: r["part"])
    chunks, start = [], 0
    for r in files:
        chunks += [(r["data"], r["index"], start, at, min(CHUNK_RECORDS, r["n_records"] - at))
                   for at in range(0, r["n_records"], CHUNK_RECORDS)]
        start += r["n_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, index, base, at, count in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                filesystem, place = _filesystem(index)
                with filesystem.open_input_file(place) as f:
                    f.seek(at * ENTRY.itemsize)
                    entries = np.frombuffer(f.read(count * ENTRY.itemsize), ENTRY)
                if seed is not None:
                    entries = np.random.default_rng([seed, base, at]).permutation(entries)
                out: list[tuple] = []
                with filesystem.open_input_file(_filesystem(data)[1]) as f:
                    head = struct.calcsize("<QI")
                    for e in entries:
                        f.seek(int(e["offset"]))
                        first = f.read(head)
                        block = first + f.read(struct.unpack_from("<Q", first)[0] + 4)
                        ids = unframe(block)
                        width = len(ids) // max(1, int(e["tokens"]))
                        ids = np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes() if width else b""
                        out.append((None if e["no_id"] else int(e["id"]), base + int(e["before"]), int(e["tokens"]), ids))
                        if len(out) == OUT_ROWS:
                            yield _rows(out)
                            out = []
                yield _rows(out)

    if not chunks:
        return spark.createDataFrame([], RECORDS)
    listing = spark.createDataFrame(chunks, "data string, index string, base long, at long, count long")
    return listing.repartition(len(chunks)).mapInArrow(run, RECORDS)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[], [], [], []]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
        names=["doc_id", "start", "n_tokens", "ids"])
