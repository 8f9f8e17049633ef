"""First visits of a day and session starts."""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from brookmart.functions.timecols import day_of


def first_of_day(df, keys, ts="ts", flag="is_first", ties=(), slices=1, ttl_ms=None):
    """Flag (1/0) the first row of each key on each day.

    `ts` is in milliseconds; `ties` orders rows of the same time. In batch the rank
    is taken in two steps: first among the rows of one key, day and input
    partition, then among those winners. A hot key is therefore ranked in pieces
    no larger than an input partition, and the second step sees one row per piece.

    A stream keeps the days seen per key, for ever or until they were not written for
    `ttl_ms`. With `slices` above 1 it works in the same two steps, over that many
    slices of each key, for streams with hot keys.
    """
    if df.isStreaming:
        from brookmart.streaming.state import first_of_day_stream
        return first_of_day_stream(df, keys, ts, flag, slices, ttl_ms=ttl_ms)
    order = [F.col(ts), *[F.col(c) for c in ties]]
    df = df.withColumn("_day", day_of(F.col(ts))).withColumn("_piece", F.spark_partition_id())
    local = Window.partitionBy(*keys, "_day", "_piece").orderBy(*order)
    df = df.withColumn("_local", F.row_number().over(local) == 1)
    winners = Window.partitionBy(*keys, "_day", F.when(~F.col("_local"), F.col("_piece"))).orderBy(*order)
    first = F.col("_local") & (F.row_number().over(winners) == 1)
    return df.withColumn(flag, first.cast("bigint")).drop("_day", "_piece", "_local")


def session_flag(df, flag="sv_ct"):
    """Flag rows that start a session: no previous page, or the text "null"."""
    starts = F.coalesce(F.col("last_page_id"), F.lit("null")) == "null"
    return df.withColumn(flag, starts.cast("bigint"))
