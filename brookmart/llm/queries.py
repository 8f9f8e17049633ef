"""The registered queries of this subpackage and the DuckDB SQL of those that have one."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, chat, exact_dedup, hard_negatives, mixing, near_vectors, packing, phrase_dedup, quality, sharding, simhash, suffix_dedup, topk
from .common import table
from .sql import SQL  # noqa: F401


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, folder, "documents"))


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, folder, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, folder, "documents"))


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), packing.contract_bpe, keep_ids=False).select(*packing.COLUMNS)


def op6_phrase_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return phrase_dedup.phrase_dedup(table(spark, folder, "documents"))


def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, folder, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        "source", "lang")
    placed = sharding.shard(rows, ["doc_id", "text_crc32"], ["source", "lang"], ["size"], 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op8_chat(spark: SparkSession, folder: str) -> DataFrame:
    said = F.lit("</s>[INST] ok [/INST]")
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    chats = chat.format_chats(given.unionByName(probe))
    back = chats.select("conv_id", "formatted", chat.read_back().alias("turns"), chat.loss_text().alias("loss"))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select(
        "doc_id", "source", "size", "source_size", "target", "taken")


def op10_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"))


def op11_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, folder, "embeddings"))


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(table(spark, folder, "documents"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    moved = F.when(F.pmod("vec_id", F.lit(7)) == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", moved))


QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_simhash, op3_suffix_dedup, op4_quality, op5_packing, op6_phrase_dedup, op7_sharding, op8_chat,
                                   op9_mixing, op10_topk, op11_near_vectors, op12_alignment, op13_hard_negatives)}
