"""Quality scores by nearest-neighbour voting in a latent-semantic space.

Texts are hashed byte trigrams (``BUCKETS`` counts, logarithmic, weighted by
inverse document frequencies over all documents).  A truncated singular value
decomposition of at most ``PER_CLASS`` labelled rows of each class gives the
latent space; the labelled vectors (at most ``2 * PER_CLASS`` rows of ``DIMS``
floats) and the projection are broadcast.  Every document is projected in
blocks, its cosines with all labelled vectors are computed exactly, and its
``NEIGHBOURS`` nearest vote with their label, weighted by similarity and by
how many rows of their class the bound left out.

Labels are learned only from rows whose ``crc32(doc_id as text) mod 3`` is not
1; labels, lang, source and doc_id are no input of a score.

Defined results: null text is empty; an empty text has no neighbours and gets
the share of label 1 among the labelled rows; without any labelled row every
score is 0.5; null labels teach nothing; repeated rows give repeated results;
an empty table gives an empty one; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import ship, text_of

BUCKETS = 4096
DIMS = 64
PER_CLASS = 1500
NEIGHBOURS = 25
BLOCK_DOCS = 256
PIECE = 1 << 20           # bytes of a text that are counted at a time
SHARPNESS = 6
PRIOR_WEIGHT = 0.05


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def trigram_counts(texts: list[str]) -> np.ndarray:
    """Counts of hashed byte trigrams, a row per text; long texts in pieces."""
    out = np.zeros((len(texts), BUCKETS), np.float32)
    for row, text in zip(out, texts, strict=True):
        data = np.frombuffer(text.encode(), np.uint8).astype(np.uint32)
        for at in range(0, max(len(data) - 2, 0), PIECE):
            d = data[at:at + PIECE + 2]
            code = (d[:-2] * np.uint32(0x9E3779B1) + d[1:-1] * np.uint32(0x85EBCA6B) + d[2:] * np.uint32(0xC2B2AE35))
            row += np.bincount((code >> np.uint32(20)), minlength=BUCKETS)
    return out


def _document_frequencies(base: DataFrame) -> np.ndarray:
    """Inverse document frequencies over all documents: one row of ``BUCKETS`` sums per task, added by Spark."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            texts = list(batch["text"])
            for i in range(0, len(texts), BLOCK_DOCS):
                total += (trigram_counts(texts[i:i + BLOCK_DOCS]) > 0).sum(axis=0)
            n += len(texts)
        yield pd.DataFrame({"bucket": np.arange(BUCKETS + 1), "n": np.append(total, n)})

    rows = (base.select("text").mapInPandas(count, "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    n = np.zeros(BUCKETS + 1)
    for r in rows:
        n[r["bucket"]] = r["n"]
    return np.log((1 + n[-1]) / (1 + n[:-1])).astype(np.float32) + 0.1


def _vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    x = np.log1p(trigram_counts(texts)) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _latent(x: np.ndarray, dims: int) -> np.ndarray:
    """The leading right singular vectors of ``x`` by subspace iteration."""
    q = np.random.default_rng(0).standard_normal((x.shape[1], dims + 16)).astype(np.float32)
    for _ in range(4):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, v = np.linalg.svd(x @ q, full_matrices=False)
    return (q @ v.T)[:, :dims].astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> dict:
    """The labelled latent vectors, their labels and vote weights, and the projection."""
    ship(docs.sparkSession)
    base = docs.select(F.col("doc_id"), text_of().alias("text"))
    idf = _document_frequencies(base)
    known = (labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("y"))
             .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id"))).distinct())
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    picks = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(PER_CLASS) for y in (0, 1)]
    chosen = picks[0].unionByName(picks[1])          # at most 2 * PER_CLASS ids: broadcast
    rows = base.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("y", "text")

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _vectors(list(batch["text"]), idf).astype(np.float16)
            yield pd.DataFrame({"y": batch["y"], "x": [r.tobytes() for r in x]})

    got = rows.mapInPandas(features, "y int, x binary").toPandas()
    if not len(got):
        return {"idf": idf, "projection": np.zeros((BUCKETS, 1), np.float32),
                "vectors": np.zeros((0, 1), np.float32), "y": np.zeros(0), "weight": np.zeros(0), "prior": 0.5}
    got = got.sort_values(["y", "x"])
    x = np.stack([np.frombuffer(b, np.float16) for b in got["x"]]).astype(np.float32)
    y = got["y"].to_numpy(np.float64)
    v = _latent(x, min(DIMS, len(x)))
    z = x @ v
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)
    weight = np.array([sizes[int(c)] / max(1, (y == c).sum()) for c in y])
    return {"idf": idf, "projection": v, "vectors": z.astype(np.float32), "y": y, "weight": weight / weight.max(),
            "prior": sizes.get(1, 0) / max(1, sum(sizes.values()))}


def vote(texts: list[str], model: dict) -> np.ndarray:
    """Scores of a block of texts."""
    z = _vectors(texts, model["idf"]) @ model["projection"]
    norm = np.linalg.norm(z, axis=1, keepdims=True)
    z = z / np.maximum(norm, 1e-9)
    prior = model["prior"]
    if not len(model["y"]):
        return np.full(len(texts), prior)
    cosine = z @ model["vectors"].T
    k = min(NEIGHBOURS, cosine.shape[1])
    near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
    w = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64) ** SHARPNESS * model["weight"][near]
    w[norm[:, 0] < 1e-6] = 0
    return ((w * model["y"][near]).sum(axis=1) + PRIOR_WEIGHT * prior) / (w.sum(axis=1) + PRIOR_WEIGHT)


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = list(batch["text"])
            got = [vote(texts[i:i + BLOCK_DOCS], shared.value) for i in range(0, len(texts), BLOCK_DOCS)]
            yield batch[["doc_id"]].assign(score=np.concatenate(got) if got else np.zeros(0)).astype({"doc_id": "Int64"})

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInPandas(
        run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
