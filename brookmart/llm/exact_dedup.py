"""Exact deduplication by two-pass Bloom filtering. [native]

Pass 1 counts, per slot of a blocked Bloom filter, the rows that fall on it. Only slot
numbers with partial counts are shuffled: equal texts of one input partition meet before the
shuffle. Slots with two or more rows are set in the filter. Pass 2 looks every row up: a row
with an unset slot has a text of its own and passes straight through. The others, which hold
all true copies and the filter's few false positives, are shuffled by the SHA-256 of the text.

The filter's size is bounded by `max_bits` (32 MB by default), so it may be broadcast. With
more rows than it can separate, more rows are shuffled; the result stays exact.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import SPACE, keyed, materialise

def fingerprint(text):
    """SHA-256 (lowercase hex) of a text whose white space runs are single spaces; null is empty."""
    spaced = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACE, " ")
    return F.sha2(spaced.cast("binary"), 256)


def flag_repeats(hashed: DataFrame, blocks: int) -> DataFrame:
    """`hashed` and `maybe`: whether the filter of repeated slots holds the row's digest."""
    rows = hashed.withColumns(bloom.places(F.xxhash64("text_sha256"), blocks))
    repeated = rows.select("block", F.explode("slots").alias("slot")).groupBy("block", "slot").count().where("count > 1")
    return bloom.test(rows, bloom.set_slots(repeated))


def exact_dedup(docs: DataFrame, bits_per_row: int = 16, max_bits: int = 1 << 28) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row of `docs` (doc_id, text).

    A null text is an empty one. Of equal texts the row with the smallest doc_id stays; rows
    that repeat this doc_id too all stay, as nothing tells them apart. A null doc_id is larger
    than any other; a text that has only such rows keeps them, with a null keep_id. Other
    columns are ignored. An empty table gives an empty result.
    """
    hashed = materialise(docs.select("doc_id", fingerprint(F.col("text")).alias("text_sha256")), "digests")
    flagged = flag_repeats(hashed, bloom.blocks_for(docs.count(), bits_per_row, max_bits))
    single = flagged.where("not maybe").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")
    rows = flagged.where("maybe").select("doc_id", "text_sha256")
    # Grouped by the digest and its first half: the join then has an exchange of its own on
    # both sides, and adaptive execution can split the rows of a text with very many copies.
    groups = (rows.groupBy("text_sha256", F.substring("text_sha256", 1, 32).alias("half"))
              .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).drop("half"))
    matched = rows.join(groups, "text_sha256").select(
        "doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"), "text_sha256")
    return single.unionByName(matched)


def drop_copies(docs: DataFrame, bits_per_row: int = 16, max_bits: int = 1 << 28) -> DataFrame:
    """The rows of `docs`, all columns: of equal texts the one with the smallest doc_id.

    A null text is an empty one. Rows are told apart by a key of their own: of equal texts exactly
    one row stays, also where doc_ids are repeated or null (a null one is larger than any other), and
    a row never goes because another text has its doc_id. An empty table gives an empty one.
    """
    held = keyed(docs)
    hashed = materialise(held.select("row", F.col("doc.doc_id").alias("doc_id"), fingerprint(F.col("doc.text")).alias("text_sha256")), "digests")
    rows = flag_repeats(hashed, bloom.blocks_for(hashed.count(), bits_per_row, max_bits)).where("maybe").select("row", "doc_id", "text_sha256")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("first")
    groups = rows.groupBy("text_sha256", F.substring("text_sha256", 1, 32).alias("half")).agg(first).drop("half")
    dropped = rows.join(groups, "text_sha256").where("row != first.row").select("row")
    return bloom.without(held, "row", materialise(dropped, "copies")).select("doc.*")
