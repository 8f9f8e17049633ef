"""Tumbling event-time windows.

Streaming input is flagged row by row by the stateful operators and then summed.
The batch forms of the visitor windows skip the per-row flags: `GROUPING SETS`
computes, in one scan and one shuffle of partial aggregates, both the sums per
window and the first visit per visitor and day. No raw row is ever shuffled, so
neither a hot visitor nor a hot window ends up in one task.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from brookmart.functions.timecols import day_of, gate, window_texts, with_event_time
from brookmart.operators.retract import last_versions, retract_updates
from brookmart.operators.visits import first_of_day, session_flag
from brookmart.schemas import HOME_DETAIL_WINDOW, KEYWORD_WINDOW, TRAFFIC_WINDOW

HOME_PAGES = ["home", "good_detail"]
TRAFFIC_DIMS = ["vc", "ch", "ar", "is_new"]


def window_start(ms, seconds):
    return F.expr(f"{ms} - pmod({ms}, {seconds * 1000})")


def start_texts(df, seconds, start="_start"):
    bounds = F.struct(F.timestamp_millis(F.col(start)).alias("start"),
                      F.timestamp_millis(F.col(start) + seconds * 1000).alias("end"))
    return window_texts(df.withColumn("window", bounds).drop(start))


def _behind_state(df, unit, delay):
    """Event time and watermark of rows that came through a stateful step.

    A watermark before that step would end the query at the first row behind it.
    """
    return with_event_time(df, "ts", unit, delay)


def _without_watermark(df):
    """`df` as input of a stateful step, which must not have a watermark yet."""
    if "et" in df.columns and "spark.watermarkDelayMs" in df.schema["et"].metadata:
        raise ValueError("the window sets the watermark behind its stateful step: read the stream with delay=None")
    return df.drop("et")


def traffic_window(pages, seconds=10, slices=1, delay="0 seconds", ttl_ms=None):
    """Visitors, sessions, views and time on page by version, channel, area, is_new.

    For streams: `slices` spreads hot visitors and `ttl_ms` ends state (see
    `first_of_day`); `delay` is how long a window waits for late rows.
    """
    if pages.isStreaming:
        first = first_of_day(_without_watermark(pages), ["mid"], flag="uv_ct", slices=slices, ttl_ms=ttl_ms)
        flagged = session_flag(_behind_state(first, "ms", delay))
        sums = flagged.groupBy(F.window("et", f"{seconds} seconds"), *TRAFFIC_DIMS).agg(
            F.sum("uv_ct").alias("uv_ct"), F.sum("sv_ct").alias("sv_ct"),
            F.count(F.lit(1)).alias("pv_ct"), F.sum("during_time").alias("dur_sum"))
        return window_texts(sums).select(*TRAFFIC_WINDOW)

    rows = session_flag(pages).select(
        window_start("ts", seconds).alias("_start"), *TRAFFIC_DIMS,
        "mid", day_of(F.col("ts")).alias("_day"),
        F.struct("ts", *TRAFFIC_DIMS).alias("_visit"), "sv_ct", "during_time")
    by_window = [F.col("_start"), *[F.col(c) for c in TRAFFIC_DIMS]]
    by_visitor = [F.col("mid"), F.col("_day")]
    both = rows.groupingSets([by_window, by_visitor], *by_window, *by_visitor).agg(
        F.sum("sv_ct").alias("sv_ct"), F.count(F.lit(1)).alias("pv_ct"),
        F.sum("during_time").alias("dur_sum"), F.min("_visit").alias("_visit"),
        F.grouping("mid").alias("_is_window"))
    in_window = F.col("_is_window") == 1
    visit = F.col("_visit")
    parts = both.select(
        F.when(in_window, F.col("_start")).otherwise(window_start("_visit.ts", seconds)).alias("_start"),
        *[F.when(in_window, F.col(c)).otherwise(visit[c]).alias(c) for c in TRAFFIC_DIMS],
        F.when(in_window, 0).otherwise(1).alias("uv_ct"),
        *[F.when(in_window, F.col(c)).otherwise(0).alias(c) for c in ("sv_ct", "pv_ct", "dur_sum")])
    sums = parts.groupBy("_start", *TRAFFIC_DIMS).agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("uv_ct", "sv_ct", "pv_ct", "dur_sum")])
    return start_texts(sums, seconds).select(*TRAFFIC_WINDOW)


def home_detail_window(pages, seconds=10, slices=1, delay="0 seconds", ttl_ms=None):
    """First visits of the day to the home page and to product pages.

    Other pages of a stream only move its watermark. Parameters as for `traffic_window`.
    """
    is_home, wanted = F.col("page_id") == "home", F.col("page_id").isin(HOME_PAGES)
    if pages.isStreaming:
        from brookmart.streaming.state import first_of_day_stream
        marked = _without_watermark(pages).withColumn("_wanted", F.coalesce(wanted, F.lit(False)))
        first = first_of_day_stream(marked, ["mid", "page_id"], "ts", "uv", slices, "_wanted", ttl_ms)
        flagged = gate(_behind_state(first, "ms", delay), F.col("_wanted"))
        sums = flagged.groupBy(F.window("et", f"{seconds} seconds")).agg(
            F.sum(F.when(is_home, F.col("uv")).otherwise(0)).alias("home_uv_ct"),
            F.sum(F.when(is_home, 0).otherwise(F.col("uv"))).alias("good_detail_uv_ct"))
        return window_texts(sums).select(*HOME_DETAIL_WINDOW)

    rows = pages.filter(wanted).select(window_start("ts", seconds).alias("_start"), "mid", "page_id",
                        day_of(F.col("ts")).alias("_day"), "ts")
    by_window, by_visitor = [F.col("_start")], [F.col("mid"), F.col("page_id"), F.col("_day")]
    both = rows.groupingSets([by_window, by_visitor], *by_window, *by_visitor).agg(
        F.min("ts").alias("_first"), F.grouping("mid").alias("_is_window"))
    in_window = F.col("_is_window") == 1
    parts = both.select(
        F.when(in_window, F.col("_start")).otherwise(window_start("_first", seconds)).alias("_start"),
        F.when(in_window, 0).when(is_home, 1).otherwise(0).alias("home_uv_ct"),
        F.when(in_window, 0).when(is_home, 0).otherwise(1).alias("good_detail_uv_ct"))
    sums = parts.groupBy("_start").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("home_uv_ct", "good_detail_uv_ct")])
    return start_texts(sums, seconds).select(*HOME_DETAIL_WINDOW)


def sku_window(details, key, order, amounts, seconds=10, delay="0 seconds", ttl_ms=None):
    """Amounts by product and window, counting only the last version of a detail.

    A window all of whose rows were replaced stays in the result with sums of 0,
    as it would after adding each row and its negation. The batch form uses that
    these pairs cancel: it adds the last version of each key to zero rows for the
    (product, window) pairs that exist. Both come from aggregates that combine
    before their shuffle; the zero rows read three columns only.

    A stream waits `delay` for late rows; a negation whose window is closed by then is
    dropped with it. `ttl_ms` ends its state (see `retract_updates`).
    """
    if details.isStreaming:
        net = retract_updates(_without_watermark(details), key, order, amounts, ttl_ms)
        net = _behind_state(net, "s", delay)
        sums = net.groupBy(F.window("et", f"{seconds} seconds"), "sku_id").agg(
            *[F.sum(c).cast("decimal(38,4)").alias(c) for c in amounts])
        return window_texts(sums)

    order = [order] if isinstance(order, str) else list(order)
    start = window_start("(ts * 1000)", seconds).alias("_start")
    present = details.select(start, "sku_id").distinct().select(
        "*", *[F.lit(0).cast(details.schema[c].dataType).alias(c) for c in amounts])
    kept = last_versions(details.select(key, "sku_id", start, *order, *amounts), key, order)
    parts = present.unionByName(kept.select("_start", "sku_id", *amounts))
    sums = parts.groupBy("_start", "sku_id").agg(
        *[F.sum(c).cast("decimal(38,4)").alias(c) for c in amounts])
    return start_texts(sums, seconds)


#: A window with more texts than so many is not left to one task.
HOT_TEXTS = 20_000


def text_window(events, split, seconds=5, hot_texts=HOT_TEXTS):
    """Number of searches per word and window, of texts (`item`, `et`) that `split` turns into rows of `keyword`.

    A text is a fraction of the size of its words as rows with a window each, so texts are shuffled by window and split behind
    that, where all rows of a group lie together. Windows with over `hot_texts` texts are split first and
    summed before their shuffle, as their words repeat. Batch only.
    """
    rows = events.filter("et is not null").select("item", window_start("unix_millis(et)", seconds).alias("_start"))
    crowded = rows.groupBy("_start").count().filter(F.col("count") > hot_texts).agg(F.collect_set("_start")).scalar()
    hot = F.array_contains(crowded, F.col("_start"))
    counts = [split(part).groupBy("_start", "keyword").agg(F.count(F.lit(1)).alias("keyword_count"))
              for part in (rows.filter(~hot).repartition("_start"), rows.filter(hot))]
    return start_texts(counts[0].unionByName(counts[1]), seconds).select(*KEYWORD_WINDOW)


def keyword_window(words, seconds=5):
    """Number of searches per word and window."""
    counts = words.groupBy(F.window("et", f"{seconds} seconds"), "keyword").agg(
        F.count(F.lit(1)).alias("keyword_count"))
    return window_texts(counts).select(*KEYWORD_WINDOW)
