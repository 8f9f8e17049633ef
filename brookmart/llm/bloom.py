"""A blocked Bloom filter as a table, built and tested with Spark expressions only.

A hash picks a block of 2**15 slots and two slots in it, so one look-up by block tests both. The
table has at most `blocks` rows of at most 512 words of 64 slots: its size is bounded by the
number of bits, and it may be broadcast.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

BLOCK = 1 << 15
SLOTS = 2


def blocks_for(rows: int, bits_per_row: int, max_bits: int) -> int:
    """Number of blocks for so many rows."""
    return -(-min(max_bits, max(BLOCK, rows * bits_per_row)) // BLOCK)


def places(h: Column, blocks: int) -> dict[str, Column]:
    """Block and slots (0 to BLOCK - 1) of a 64-bit hash."""
    first = F.shiftrightunsigned(h, 49).cast("int")
    second = F.shiftrightunsigned(F.shiftleft(h, 15), 49).cast("int")
    return {"block": F.pmod(h, F.lit(blocks)), "slots": F.array(first, second)}


def set_slots(slots: DataFrame) -> DataFrame:
    """The filter with the given slots (block, slot) set, as rows (block, words)."""
    words = slots.groupBy("block", F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, slot & 63)")).alias("mask"))
    filled = words.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("word", "mask"))).alias("words"))
    return materialise(filled, "bloom")


def test(rows: DataFrame, filled: DataFrame) -> DataFrame:
    """`rows` (with block and slots) and `maybe`: whether all their slots are set."""
    found = rows.join(F.broadcast(filled), "block", "left")  # at most blocks * BLOCK / 8 bytes
    maybe = F.lit(True)
    for i in range(SLOTS):
        bit = F.expr(f"shiftrightunsigned(words[shiftright(slots[{i}], 6)], slots[{i}] & 63) & 1")
        maybe = maybe & F.coalesce(bit == 1, F.lit(False))
    return found.withColumn("maybe", maybe).drop("block", "slots", "words")


def may_hold(rows: DataFrame, column: str, keys: DataFrame, bits_per_row: int = 12, max_bits: int = 1 << 28) -> DataFrame:
    """`rows` and `maybe`: false only where `column` is none of the values of `keys` (one column)."""
    key = keys.columns[0]
    blocks = blocks_for(keys.count(), bits_per_row, max_bits)
    listed = keys.select(places(F.xxhash64(key), blocks)["block"].alias("block"),
                         F.explode(places(F.xxhash64(key), blocks)["slots"]).alias("slot"))
    return test(rows.withColumns(places(F.xxhash64(column), blocks)), set_slots(listed))


def without(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """The rows whose `column` is none of `keys` (one column, materialised).

    Rows that the filter tells apart pass straight through; only the others are shuffled. Columns
    of `rows` may have any names.
    """
    key = keys.toDF("key")
    flagged = may_hold(rows.select(F.struct(*rows.columns).alias("held"), F.col(column).alias("key")), "key", key)
    passed = flagged.where("not maybe").select("held.*")
    return passed.unionByName(flagged.where("maybe").join(key, "key", "left_anti").select("held.*"))
