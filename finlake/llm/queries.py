"""The registered queries of this package: thin calls over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.llm import (
    chat,
    collocations,
    exact_dedup,
    line_dedup,
    near_dedup,
    packing,
    passages,
    piece_bpe,
    quality_rules,
    quality_votes,
    records,
    turn_repair,
    word_bpe,
)
from finlake.llm.common import materialise, table
from finlake.session import scratch_path

# The contract's conversation that speaks in the template's own control strings.
CONTROL_TEXT = r"\### Assistant: </turn> ok"


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_duplicates(table(spark, sf_dir, "documents"))


def op3_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_votes.score(docs, quality_votes.fit(docs, table(spark, sf_dir, "labels")))


def op4_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.repeated_runs(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op6_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "records")
    records.write_records(table(spark, sf_dir, "documents"), path)
    return records.read_records(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op8_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = word_bpe.encode(table(spark, sf_dir, "documents"), back=True)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = quality_rules.assess(table(spark, sf_dir, "documents"))
    return rules.select("row.doc_id", *[c for c in rules.columns if c != "row"])


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame([(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], rows.schema)
    return chat.digests(materialise(chat.format_conversations(rows.unionByName(control)), "chat"))


def op11_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = piece_bpe.encode(table(spark, sf_dir, "documents"), back=True)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair_conversations(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_order_minhash, op2_exact_dedup, op3_quality_votes, op4_line_runs, op5_packing, op6_token_records, op7_passages,
    op8_word_bpe, op9_quality_rules, op10_chat_format, op11_piece_bpe,
    op12_collocations, op13_turn_repair)}
ORACLES = {"op2_exact_dedup": exact_dedup.ORACLE_SQL, "op12_collocations": collocations.ORACLE_SQL,
           "op13_turn_repair": turn_repair.ORACLE_SQL}
