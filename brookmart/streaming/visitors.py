"""Visitors of a stream, batch by batch, with built-in aggregates and joins only.

What is known of visitors lies in keyed stores (`brookmart.sinks.store`). A batch reduces each visitor to one
row before anything is shuffled by visitor, so one who sends a third of all rows costs a row for
each input partition; rows that must be marked are joined to what is known, a join whose hot
keys adaptive execution splits. Nothing waits in the memory of a task, and a batch that is run
again gives the same rows. Each function returns one of (rows of a batch, batch id).
"""
from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookmart.functions.timecols import day_of
from brookmart.operators.logs import first_marks, with_first_marks
from brookmart.operators.visits import first_of_day, session_flag
from brookmart.operators.windows import HOME_PAGES, TRAFFIC_DIMS, start_texts, window_start
from brookmart.schemas import HOME_DETAIL_WINDOW, TRAFFIC_WINDOW
from brookmart.sinks.store import Store
from brookmart.streaming.deltas import FOLD_EVERY, Totals


def fix_is_new_deltas(path, buckets=32, fold_every=FOLD_EVERY):
    """Reset `is_new` of visitors who are known from an earlier day (see `operators.logs.fix_is_new`).

    The batch that shows a visitor first decides, by the visitor's first record in it; rows of later
    batches change nothing, even if they are older. Dirty rows pass through.
    """
    store = Store(path, "_visitor string, _first bigint", ["_visitor"], buckets)

    def earliest(rows):
        return rows.groupBy("_visitor").agg(F.min(F.struct("batch_id", "_first")).alias("_m")).select("_visitor", "_m.batch_id", "_m._first")

    def results(logs, batch_id):
        spark = logs.sparkSession
        if batch_id and batch_id % fold_every == 0:
            store.fold(spark, batch_id - 1, earliest)
        store.append(first_marks(logs), batch_id)
        return with_first_marks(logs, earliest(store.around(spark, batch_id)))

    return results


def first_of_day_deltas(path, keys, ts="ts", flag="is_first", buckets=32, fold_every=FOLD_EVERY):
    """Flag (1/0) the first row of each key on each day: of the rows of the first batch that has any."""
    schema = T.StructType([*[T.StructField(k, T.StringType()) for k in keys], T.StructField("_day", T.DateType())])
    store = Store(path, schema, [*keys, "_day"], buckets)

    def earliest(rows):
        return rows.groupBy(*keys, "_day").agg(F.min("batch_id").alias("batch_id"))

    def results(rows, batch_id):
        spark = rows.sparkSession
        if batch_id and batch_id % fold_every == 0:
            store.fold(spark, batch_id - 1, earliest)
        flagged = first_of_day(rows, keys, ts, "_mine").withColumn("_day", day_of(F.col(ts)))
        store.append(rows.select(*keys, day_of(F.col(ts)).alias("_day")).distinct(), batch_id)
        fresh = earliest(store.batch(spark, batch_id).unionByName(store.before(spark, batch_id))).filter(F.col("batch_id") == batch_id).select(*[F.col(c).alias(f"_of_{c}") for c in (*keys, "_day")])
        same = F.col("_mine") == 1  # one row a key and day is looked up, so no key is hot
        for c in (*keys, "_day"):
            same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
        joined = flagged.join(fresh.withColumn("_fresh", F.lit(1)), same, "left")
        return joined.withColumn(flag, F.coalesce("_fresh", F.lit(0)).cast("bigint")).select(*rows.columns, flag)

    return results


def _totals(path, parts, groups, amounts, seconds, columns, batch_id, **options):
    typed = parts.select(*groups, *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in amounts])
    return start_texts(Totals(path, typed.schema, groups, amounts, **options).add(typed, batch_id), seconds).select(*columns)


def traffic_window_deltas(path, seconds=10, **options):
    """Visitors, sessions, views and time on page by version, channel, area, is_new, as they change.

    Gives the sums of every window that a batch changes; by `TRAFFIC_KEY` the newer replace the older.
    """
    first = first_of_day_deltas(f"{path}/days", ["mid"], flag="uv_ct", **options)

    def results(pages, batch_id):
        rows = session_flag(first(pages, batch_id)).withColumns({
            "_start": window_start("ts", seconds), "pv_ct": F.lit(1), "dur_sum": F.col("during_time")})
        return _totals(f"{path}/sums", rows, ["_start", *TRAFFIC_DIMS], ["uv_ct", "sv_ct", "pv_ct", "dur_sum"],
                       seconds, TRAFFIC_WINDOW, batch_id, **options)

    return results


TRAFFIC_KEY = ["stt", *TRAFFIC_DIMS]


def home_detail_window_deltas(path, seconds=10, **options):
    """First visits of the day to the home page and to product pages, as they change by `stt`."""
    first = first_of_day_deltas(f"{path}/days", ["mid", "page_id"], flag="uv", **options)

    def results(pages, batch_id):
        is_home = F.col("page_id") == "home"
        rows = first(pages.filter(F.col("page_id").isin(HOME_PAGES)), batch_id).withColumns({
            "_start": window_start("ts", seconds), "home_uv_ct": F.when(is_home, F.col("uv")), "good_detail_uv_ct": F.when(~is_home, F.col("uv"))})
        return _totals(f"{path}/sums", rows, ["_start"], ["home_uv_ct", "good_detail_uv_ct"], seconds, HOME_DETAIL_WINDOW, batch_id, **options)

    return results
