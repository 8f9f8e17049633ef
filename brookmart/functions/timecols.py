"""Event time and window bounds."""
from __future__ import annotations

from pyspark.sql import functions as F

STAMP = "yyyy-MM-dd HH:mm:ss"
DAY = "yyyy-MM-dd"


def with_event_time(df, column="ts", unit="ms", delay="0 seconds", name="et"):
    """Add event time from an epoch column and, on a stream, its watermark.

    `unit` is "s" or "ms". The default delay means ascending time; rows behind
    the watermark are dropped by the stateful operators downstream.
    """
    ts = F.col(column).cast("bigint")
    df = df.withColumn(name, F.timestamp_seconds(ts) if unit == "s" else F.timestamp_millis(ts))
    return df.withWatermark(name, delay) if df.isStreaming and delay is not None else df


def gate(df, condition, event_time="et"):
    """Filter that lets filtered-out rows still advance the watermark.

    The optimizer moves a plain filter below the watermark, so a branch that
    matches nothing would stop event time for the whole query. A condition that
    mentions the event time stays above it. On batch data the plain condition is
    kept, so that it reaches the scan.
    """
    if df.isStreaming and event_time in df.columns:
        condition = F.when(F.col(event_time).isNotNull(), condition).otherwise(F.lit(False))
    return df.filter(condition)


def window_texts(df, window="window"):
    """Replace a window struct by `stt`, `edt` and `cur_date` (day of the start)."""
    start, end = F.col(f"{window}.start"), F.col(f"{window}.end")
    rest = [c for c in df.columns if c != window]
    return df.select(F.date_format(start, STAMP).alias("stt"), F.date_format(end, STAMP).alias("edt"),
                     F.date_format(start, DAY).alias("cur_date"), *rest)


def day_of(ms):
    """Day (a date in the session zone) of an epoch-millisecond column."""
    return F.timestamp_millis(ms).cast("date")
