"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import (
    conversations, divergence, flatgraph, lines, mixing, neighbours, oracles, packing, quality, secrets, sharding, simhash, spelling, warc,
)
from millrace.llm.common import table

def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    found = neighbours.nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0), 20)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), packing.tokenizer_path(), keep_ids=False)
    return pieces.select(
        "doc_id", "start", "length", F.col("checksum").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    voters = quality.train(docs, table(spark, sf_dir, "labels"))
    rated, score = quality.scored(docs, voters)
    return rated.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        F.col(score).alias("score"),
        (F.col(score) >= 0.5).cast("int").alias("predicted"),
    )


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, dropped = lines.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "text", F.col(dropped).alias("dropped_lines"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_pages(table(spark, sf_dir, "pages"), min_bytes=0)
    return records.select(
        warc.page_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_of(F.col("refers_to")).alias("refers_to"),
    )


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("doc", "doc_id")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"), words=4, max_bits=4)
    return groups.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, names = mixing.mixed(table(spark, sf_dir, "documents").select("doc_id", "source"))
    return placed.select("doc_id", "source", names["block"], names["slot"], names["in_block"])


def op9_flatgraph(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = flatgraph.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)
    return found.select(
        F.col("id").alias("vec_id"),
        "n_links",
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_rows(table(spark, sf_dir, "documents"), 16)
    return placed.select(
        F.col("id").alias("doc_id"),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judged(table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = spelling.word_counts(table(spark, sf_dir, "documents"), min_length=7, slips=31)
    return spelling.variants(counts, min_count=2, ratio=10)


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, stays = conversations.damaged(table(spark, sf_dir, "conversations"))
    return conversations.repaired(rows, keep=F.col(stays))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_neighbours": op1_neighbours,
    "op2_packing": op2_packing,
    "op3_quality": op3_quality,
    "op4_lines": op4_lines,
    "op5_warc": op5_warc,
    "op6_secrets": op6_secrets,
    "op7_simhash": op7_simhash,
    "op8_mixing": op8_mixing,
    "op9_flatgraph": op9_flatgraph,
    "op10_sharding": op10_sharding,
    "op11_divergence": op11_divergence,
    "op12_spelling": op12_spelling,
    "op13_conversations": op13_conversations,
    "pipeline": corpus_pipeline.run,
}
ORACLE_SQL: dict[str, str] = {"op5_warc": oracles.OP5, "op11_divergence": oracles.OP11, "op12_spelling": oracles.OP12, "op13_conversations": oracles.OP13}
if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
