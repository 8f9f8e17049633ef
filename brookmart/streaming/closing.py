"""Tumbling windows that event time closes, without a state store.

An append-mode aggregate keeps a row of state for every group of every open window, on local disk and in the
checkpoint. Here the rows themselves wait, as they came, in a keyed store (`brookmart.sinks.store`), and only those
whose window is open when their batch ends; a window that closes is aggregated once, as a batch. A batch that is run again
gives the same rows.
"""
from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookmart.operators.windows import window_start
from brookmart.sinks.store import Store
from brookmart.streaming.deltas import FOLD_EVERY


class ClosedWindows:
    """Rows (with event time `et`) of the windows that a batch closes, all rows of a window at once.

    Event time is the greatest that came, less `delay_s` seconds. A row whose window was closed before its batch is late
    and left out, as is one without event time; a window that never closes gives nothing.
    """

    def __init__(self, path, schema, seconds, delay_s=0, buckets=32, fold_every=FOLD_EVERY):
        self.columns, self.seconds, self.delay, self.fold_every = schema.fieldNames(), seconds, delay_s * 1000, fold_every
        own = [T.StructField("_start", T.LongType()), T.StructField("_top", T.LongType())]
        self.store = Store(path, T.StructType([*schema.fields, *own]), ["_start"], buckets)

    def _end_after(self, top):
        """Condition: the window is open at event time `top` (none before any row came)."""
        return F.lit(True) if top is None else F.col("_start") + self.seconds * 1000 > top - self.delay

    def closed(self, rows, batch_id):
        spark = rows.sparkSession
        if batch_id and batch_id % self.fold_every == 0:
            self.store.fold(spark, batch_id - 1, self._waiting)
        rows = rows.where("et is not null").withColumn("_start", window_start("unix_millis(et)", self.seconds))
        waiting = self.store.read(spark, upto=batch_id - 1, replay=batch_id)
        # The row with the greatest event time lies in an open window, so it is there.
        before = waiting.agg(F.max("_top")).first()[0]
        came = rows.agg(F.max(F.expr("unix_millis(et)"))).first()[0]
        top = max((t for t in (before, came) if t is not None), default=None)
        in_time = rows.where(self._end_after(before))
        self.store.append(in_time.where(self._end_after(top)).withColumn("_top", F.lit(top).cast("bigint")), batch_id)
        due = in_time.select(*self.columns, "_start").unionByName(waiting.where(self._end_after(before)).select(*self.columns, "_start"))
        return due.where(~self._end_after(top)).select(*self.columns)

    def _waiting(self, rows):
        """What of the store is still waiting."""
        return rows.where(self._end_after(rows.agg(F.max("_top")).first()[0]))
