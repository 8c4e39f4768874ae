"""Line de-duplication by fingerprints of whole runs of lines.

Lines that hold a word are hashed without the white space around them; every
run of ``MIN_RUN`` consecutive lines is a fingerprint, so equal fingerprints
are a repeated run by themselves, whichever document is met.  Each occurrence
of a fingerprint is joined with its first occurrence in the corpus (least
document, then line), never with all others, and the match is extended line by
line both ways.  The later run is deleted.  Every line of every run of at least
``MIN_RUN`` lines that occurs earlier is found; where parts of a run first
occur in different documents, it is found as several runs that overlap.

Only hashes are shuffled, eight bytes a line, never texts.

Defined results: null text has no lines; blank lines are neither counted nor
deleted; a null ``doc_id`` takes no part; rows that share a ``doc_id`` but not
their text are documents of their own, the greater texts later than all ids;
rows with equal id and text are one; texts of any length are read whole; an
empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import SPACE_CLASS, ids_of, materialise, rows_with_nodes, ship, text_nodes, text_of
from finlake.llm.wordhash import shingles

MIN_RUN = 3

RUNS = "doc_id long, start_line int, end_line int, n_lines int, source_doc_id long, source_line int"


def _line_hashes(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{SPACE_CLASS}]"))
    return F.transform(lines, lambda x: F.xxhash64(F.regexp_replace(x, f"^[{SPACE_CLASS}]+|[{SPACE_CLASS}]+$", "")))


def _prints(lines: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, prints, places = [], [], []
            for doc_id, hashes in zip(batch["doc_id"], batch["hashes"], strict=True):
                grams = shingles(np.asarray(hashes, np.int64).view(np.uint64), MIN_RUN)
                ids.append(np.full(len(grams), doc_id, np.int64))
                prints.append(grams.view(np.int64))
                places.append(np.arange(len(grams), dtype=np.int32))
            if ids:
                yield pd.DataFrame({"print": np.concatenate(prints), "doc_id": np.concatenate(ids),
                                    "pos": np.concatenate(places)})

    return lines.where(F.size("hashes") >= MIN_RUN).mapInPandas(run, "print long, doc_id long, pos int")


def extended(a: np.ndarray, b: np.ndarray, at: int, to: int) -> tuple[int, int, int]:
    """Start and end in ``a``, and start in ``b``, of the equal lines around ``a[at] == b[to]``."""
    n = min(len(a) - at, len(b) - to)
    ahead = a[at:at + n] == b[to:to + n]
    right = n if ahead.all() else int(np.argmin(ahead))
    n = min(at, to)
    back = a[at - n:at][::-1] == b[to - n:to][::-1]
    left = n if back.all() else int(np.argmin(back))
    return at - left, at + right, to - left


def repeated_runs(docs: DataFrame) -> DataFrame:
    """A row per run of lines that occurs earlier; positions count lines that hold a word."""
    nodes, later = text_nodes(docs)
    return ids_of(_repeated(nodes), later, "doc_id", "source_doc_id")


def _repeated(nodes: DataFrame) -> DataFrame:
    ship(nodes.sparkSession)
    lines = materialise(nodes.select("doc_id", _line_hashes(F.col("text")).alias("hashes")), "lines")
    prints = materialise(_prints(lines), "line-prints")
    first = (prints.groupBy("print").agg(F.min(F.struct("doc_id", "pos")).alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("print", F.col("first.doc_id").alias("source"), F.col("first.pos").alias("to")))
    matches = (prints.join(first, "print").where("doc_id <> source OR pos <> to")
               # fingerprints of one run lie on one diagonal: a match of each is enough to extend
               .groupBy("doc_id", "source", (F.col("pos") - F.col("to")).alias("diagonal"))
               .agg(F.sort_array(F.collect_list("pos")).alias("at")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in RUNS.split(", ")]
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                a, b, end = np.asarray(r.hashes), np.asarray(r.source_hashes), -1
                for at in r.at:
                    if at < end:
                        continue
                    start, end, source = extended(a, b, int(at), int(at - r.diagonal))
                    if end - start >= MIN_RUN:
                        out.append((r.doc_id, start, end, end - start, r.source, source))
            yield pd.DataFrame(out, columns=names)

    joined = (matches.join(lines, "doc_id")
              .join(lines.select(F.col("doc_id").alias("source"), F.col("hashes").alias("source_hashes")), "source"))
    return joined.mapInPandas(run, RUNS)


def drop_runs(docs: DataFrame) -> DataFrame:
    """``docs`` without the later repeated runs of lines; blank lines stay."""
    nodes, later = text_nodes(docs)
    runs = materialise(_repeated(nodes), "line-runs").groupBy(F.col("doc_id").alias("node")).agg(
        F.collect_list(F.struct("start_line", "end_line")).alias("_runs"))

    @F.pandas_udf("string")
    def cut(text: pd.Series, found: pd.Series) -> pd.Series:
        out = []
        for t, f in zip(text, found, strict=True):
            kept, at = [], -1
            for line in t.split("\n"):
                at += bool(line.strip(" \t\n\x0b\x0c\r"))
                if not line.strip(" \t\n\x0b\x0c\r") or not any(s["start_line"] <= at < s["end_line"] for s in f):
                    kept.append(line)
            out.append("\n".join(kept))
        return pd.Series(out, dtype=object)

    joined = rows_with_nodes(docs, later).join(runs, "node", "left")
    text = F.when(F.col("_runs").isNotNull(), cut(text_of("row.text"), F.coalesce("_runs", F.array()))).otherwise(
        F.col("row.text"))
    return joined.select(*[(text if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
