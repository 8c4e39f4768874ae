"""Quality votes by held-out accuracy, and the whole pipeline on a planted corpus."""

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

import corpus_pipeline
from finlake.llm import quality_votes
from tests.llm.cases import awkward, edited, frame, words
from tests.llm.test_native import english

SF = "/root/testdata/sf0.001"


def test_votes_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality_votes.score(docs, quality_votes.fit(docs, labels)).toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()
    assert (got.predicted == (got.score >= 0.5)).all()
    test = got[got.held_out].merge(labels.toPandas(), on="doc_id")
    rank = test.score.rank()
    good = test.quality == 1
    auc = (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert auc > 0.97 and (test.predicted == test.quality).mean() > 0.95


def test_votes_never_see_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").unionByName(
        spark.createDataFrame([(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int"))
    wrong = labels.withColumn("quality", F.when(quality_votes.held_out(F.col("doc_id")), 1 - F.col("quality"))
                              .otherwise(F.col("quality")))
    a, b = (quality_votes.score(docs, quality_votes.fit(docs, x)).orderBy("doc_id").toPandas() for x in (labels, wrong))
    pd.testing.assert_frame_equal(a, b)


def test_votes_on_awkward_documents(spark):
    docs = frame(spark, awkward())
    labels = spark.createDataFrame([(6, 1), (8, 0), (9, 0), (2, 0)], "doc_id long, quality int")
    model = quality_votes.fit(docs, labels)
    got = quality_votes.score(docs, model).toPandas()
    assert len(got) == len(awkward()) and got.score.between(0, 1).all()
    none = quality_votes.fit(docs, labels.limit(0))
    assert quality_votes.score(docs, none).toPandas().score.eq(0.5).all()
    assert quality_votes.score(docs.limit(0), model).count() == 0
    assert np.allclose(quality_votes.vote([""], model), model["prior"])


def test_pipeline_on_planted_cases(spark, tmp_path):
    clean = [(i, english(150 + i, i)) for i in range(30)]
    copies = [(100 + i, clean[i][1].replace(" ", "  ")) for i in range(5)]
    near = [(200 + i, " ".join(edited(clean[10 + i][1].split(), 4, i))) for i in range(5)]
    passage = english(70, 999)
    holders = [(300 + i, english(120, 400 + i) + " " + passage + " " + english(90, 500 + i)) for i in range(4)]
    junk = [(400, "#$ " * 100), (401, "few words"), (402, None), (403, "AAA!! BBB!! " * 60)]
    rows = clean + copies + near + holders + junk
    docs = frame(spark, rows).withColumn("lang", F.lit("en"))
    stages = corpus_pipeline.STAGES
    left = docs
    kept = []
    for name, stage in stages[:-1]:
        left = stage(spark, left, SF)
        left.write.parquet(path := str(tmp_path / name))
        left = spark.read.parquet(path)
        assert left.columns == docs.columns
        kept.append({r.doc_id for r in left.select("doc_id").collect()})
    ids = lambda rows: {i for i, _ in rows}
    assert kept[0] == ids(rows) - ids(junk)
    first = kept[1]
    assert all((i in first) != (100 + i in first) for i in range(5)) and len(first) == len(kept[0]) - 5
    assert kept[2] == first - ids(near)
    texts = {r.doc_id: r.text for r in left.collect()}
    assert passage in texts[300] and not any(passage in texts[300 + i] for i in (1, 2, 3))
    pieces = stages[-1][1](spark, left, SF).toPandas()
    assert set(pieces.doc_id) == set(texts)
    assert pieces.groupby("doc_id").length.sum().eq(pieces.groupby("doc_id").doc_tokens.first()).all()


def test_pipeline_on_empty_and_awkward_tables(spark):
    for docs in (frame(spark, awkward()), frame(spark, []).limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, SF).count() >= 0


def test_pipeline_runs_over_documents(spark):
    got = corpus_pipeline.run(spark, SF).toPandas()
    assert got.groupby("sequence_id").length.sum().max() <= 2048 and got.doc_id.nunique() > 50
