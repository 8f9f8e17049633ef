"""Sharding along a Hilbert curve.

Several metadata dimensions are quantised, a row's cell gets its index on a Hilbert curve, rows
are sorted by the index, and the order is cut into runs of equal row counts. Neighbours on the
curve are neighbours in every dimension, so each shard covers a small box and statistics per
file prune on all dimensions.

Text dimensions are quantised by rank: the values are summed up, put in order, and a value's
place is the share of rows before it. Number dimensions are quantised by half octaves.
"""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keyed, materialise

BITS = 6


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of integer points (rows of `cells`, each below 2**bits).

    The points are turned into transposed Gray code, bit plane by bit plane: in each plane a set
    bit inverts the lower bits of the first dimension, a clear bit swaps them with those of the
    dimension looked at. The interleaved bits are the index.
    """
    x = [cells[:, d].astype(np.int64) for d in range(cells.shape[1])]
    for plane in reversed(range(1, bits)):
        low = (1 << plane) - 1
        for d in range(len(x)):
            bit = (x[d] >> plane) & 1
            swap = np.where(bit == 0, (x[0] ^ x[d]) & low, 0)
            x[0] = x[0] ^ swap ^ np.where(bit == 1, low, 0)
            if d:
                x[d] = x[d] ^ swap
    for d in range(1, len(x)):
        x[d] = x[d] ^ x[d - 1]
    flip = np.zeros_like(x[0])
    for plane in reversed(range(1, bits)):
        flip ^= np.where((x[-1] >> plane) & 1, (1 << plane) - 1, 0)
    index = np.zeros_like(x[0])
    for plane in reversed(range(bits)):
        for d in range(len(x)):
            index = (index << 1) | (((x[d] ^ flip) >> plane) & 1)
    return index


def by_rank(rows: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """(column, cell): the values' cells, with about as many rows each; nulls come last."""
    counts = rows.groupBy(column).count()
    order = Window.orderBy(F.col(column).asc_nulls_last())  # one row per value
    before = F.coalesce(F.sum("count").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("count").over(Window.partitionBy())
    return counts.select(column, F.floor(before * (1 << bits) / total).cast("int").alias(f"{column}_cell"))


def by_size(column, bits: int = BITS) -> Column:
    """Cell of a number that is not negative: two cells per power of two."""
    steps = [math.ceil(2 ** (i / 2)) for i in range(1, 1 << bits)]
    cell = F.lit(0)
    for low in sorted(set(steps)):
        cell = cell + F.when(column >= F.lit(low), 1).otherwise(0)
    return F.least(cell, F.lit((1 << bits) - 1))


def shard(rows: DataFrame, key: list[str], text_dims: list[str], size_dims: list[str], shards: int) -> DataFrame:
    """`rows` with curve (index), shard (0 to shards - 1) and slot (gapless from 0 in the shard).

    Shards' row counts differ by one at most. Rows of one cell are ordered by `key`; rows that
    agree in all of it are interchangeable and each get a slot. Nulls are quantised as the last
    value of a text dimension and as size 0. An empty table gives an empty result.
    """
    celled = rows
    for name in text_dims:
        # Read from a file: broadcast only where the values are few enough for it.
        cells = materialise(by_rank(rows, name), f"cells-{name}").withColumnRenamed(name, "_value")
        celled = celled.join(cells, F.col(name).eqNullSafe(F.col("_value")), "left").drop("_value")
    for name in size_dims:
        celled = celled.withColumn(f"{name}_cell", by_size(F.coalesce(F.col(name), F.lit(0))))
    cell_columns = [f"{c}_cell" for c in [*text_dims, *size_dims]]

    @F.pandas_udf("long")
    def index(cells: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert_index(cells.to_numpy(), BITS))

    curved = celled.withColumn("curve", index(F.struct(*cell_columns))).drop(*cell_columns)
    # Written once, so that places do not change when a task is run again.
    ordered = curved.repartitionByRange("curve", *key).sortWithinPartitions("curve", *key)
    ordered = materialise(ordered.withColumn("_part", F.spark_partition_id()).withColumn(
        "_nth", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "curve")
    parts = ordered.groupBy("_part").count()  # one row per partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("_part").alias("_p"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"),
                         F.sum("count").over(Window.partitionBy()).alias("_rows"))
    ranked = ordered.join(F.broadcast(parts), F.col("_part") == F.col("_p"))
    return (ranked.withColumn("_rank", F.col("_before") + F.col("_nth"))
            .withColumn("shard", F.expr(f"(_rank * {shards}) div _rows").cast("int"))
            .withColumn("slot", F.expr(f"_rank - ((shard * _rows + {shards - 1}) div {shards})").cast("long"))
            .select(*rows.columns, "curve", "shard", "slot"))


def write_shards(docs: DataFrame, path: str, text_dims: list[str], size_dims: list[str], shards: int) -> DataFrame:
    """Write `docs`, all columns, as one folder per shard, in curve order; returns them as read back.

    Rows are told apart by a key of their own: doc_ids may be null or repeated. The folders are
    named by `shard`, with an underscore more where `docs` has such a column.
    """
    held = keyed(docs)
    dims = [F.col(f"doc.{c}").alias(f"dim_{c}") for c in (*text_dims, *size_dims)]
    placed = shard(held.select("row", *dims), ["row"], [f"dim_{c}" for c in text_dims], [f"dim_{c}" for c in size_dims], shards)
    folder = "shard"
    while folder in docs.columns:
        folder += "_"
    rows = held.join(placed.select("row", F.col("shard").alias("to"), "slot"), "row")
    dealt = rows.repartition("to").sortWithinPartitions("to", "slot")
    dealt.select("doc.*", F.col("to").alias(folder)).write.partitionBy(folder).parquet(path)
    return docs.sparkSession.read.parquet(path)
