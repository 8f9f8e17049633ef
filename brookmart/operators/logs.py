"""App logs: cleaning, repair of the new-visitor mark, split into typed records."""
from __future__ import annotations

from pyspark.sql import functions as F

from brookmart.functions.timecols import day_of
from brookmart.schemas import LOG

KINDS = ["err", "start", "page", "display", "action"]


def parse_log(df_text):
    """Parse log text once; `_bad` holds the text of malformed records.

    The record is unpacked by a generator. As a projection, its parse would be
    repeated in every later filter that the optimizer moves below it. Null values
    give a row without content, which is neither clean nor dirty.
    """
    record = F.from_json("value", f"{LOG}, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    parsed = df_text.select("value", F.inline(F.array(record)))
    # As the only element of an array the text must be one record and nothing behind it.
    alone = F.json_array_length(F.concat(F.lit("["), F.col("value"), F.lit("]"))).eqNullSafe(F.lit(1))
    parsed = parsed.withColumn("_bad", F.when(F.col("value").isNotNull() & ~alone, F.col("value")).otherwise(F.col("_bad")))
    return parsed.withColumn("ts", F.expr("try_cast(ts AS bigint)"))


def _is_dirty():
    return (F.col("_bad").isNotNull() | F.col("common").isNull() | F.col("common")["mid"].isNull()
            | F.col("ts").isNull())


def mark_dirty(parsed):
    """Records with `_dirty`: malformed, or without visitor or time. Null values are left out."""
    return parsed.filter(F.col("value").isNotNull()).withColumn("_dirty", _is_dirty())


def split_dirty(parsed):
    """(clean records, dirty text). Dirty: malformed, or without visitor or time."""
    clean = parsed.filter(~_is_dirty()).drop("value", "_bad")
    return clean, parsed.filter(_is_dirty() & F.col("value").isNotNull()).select("value")


def with_is_new(common, fixed):
    """The `common` map with its `is_new` replaced."""
    others = F.map_filter(common, lambda k, _: k != "is_new")
    return F.when(fixed.isNull(), common).otherwise(F.map_concat(others, F.create_map(F.lit("is_new"), fixed)))


def fix_is_new(logs, ttl_ms=None):
    """Reset `is_new` of visitors who are known from an earlier day.

    A visitor's first record decides: if it says "new", every later "new" of that
    day stands; all other "new" marks become "0". Rows that do not claim to be new
    stay as they are. Among records of the same time, one marked new counts as first.

    In batch, time and mark of the first record are packed into one number so that
    the search is a plain hash aggregate with map-side combine. Only visitors who
    started as new are joined back, on visitor and day. The streaming form keeps
    the first day in state, for ever or until it was not written for `ttl_ms`. Rows
    marked `_dirty` pass through.
    """
    if logs.isStreaming:
        from brookmart.streaming.state import fix_is_new_stream
        return fix_is_new_stream(logs, ttl_ms)
    return with_first_marks(logs, first_marks(logs))


def _claims_new():
    return F.coalesce(F.col("common")["is_new"] == "1", F.lit(False))


def first_marks(logs):
    """(_visitor, _first): time and mark of each visitor's first record, packed into one number."""
    first = F.min(F.col("ts") * 2 + F.when(_claims_new(), 0).otherwise(1))
    known = logs.filter(~F.col("_dirty")) if "_dirty" in logs.columns else logs
    return known.groupBy(F.col("common")["mid"].alias("_visitor")).agg(first.alias("_first"))


def with_first_marks(logs, firsts):
    """`logs` with the marks that the first records of their visitors allow."""
    mid, mark, claims_new = F.col("common")["mid"], F.col("common")["is_new"], _claims_new()
    starters = firsts.filter(F.col("_first") % 2 == 0).select("_visitor", day_of(F.expr("_first DIV 2")).alias("_visitor_day"))
    joined = logs.join(starters, (mid == F.col("_visitor")) & (day_of(F.col("ts")) == F.col("_visitor_day")), "left")
    fixed = F.when(~claims_new, mark).when(F.col("_visitor").isNotNull(), "1").otherwise("0")
    return (joined.withColumn("common", with_is_new(F.col("common"), fixed))
            .drop("_visitor", "_visitor_day"))


def split_log(clean):
    """Typed records of cleaned logs, by kind.

    A record with a start is a start and nothing else, apart from its error; a page
    record also yields one row per display and per action, each with its context.
    """
    paged = clean.filter(F.col("start").isNull() & F.col("page").isNotNull())
    return {
        "err": clean.filter(F.col("err").isNotNull()).select("err"),
        "start": clean.filter(F.col("start").isNotNull()).select("common", "start", "ts"),
        "page": paged.select("common", "page", "ts"),
        "display": paged.select("common", "page", F.explode("displays").alias("display"), "ts"),
        "action": paged.select("common", "page", F.explode("actions").alias("action"), "ts"),
    }


def _json_of(**raw):
    """JSON object text from ready JSON texts; null members are left out."""
    members = [F.concat(F.lit(f'"{name}":'), text) for name, text in raw.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def log_records(clean, topics=None):
    """All records of a log in one pass: `topic, value` with the value as JSON.

    Each log row fans out to its records, so one write (routed by topic, or
    partitioned by it) feeds every output and the input is read once. Rows marked
    `_dirty` give their text to the topic "dirty".
    """
    topics = {**{kind: f"dwd_{kind}" for kind in [*KINDS, "dirty"]}, **(topics or {})}
    clean = clean.select("*", *[F.to_json(F.map_filter(m, lambda _, value: value.isNotNull())).alias(f"_{m}")
                                for m in ("common", "page")])
    common, page, ts = F.col("_common"), F.col("_page"), F.col("ts").cast("string")
    started, paged = F.col("start").isNotNull(), F.col("start").isNull() & F.col("page").isNotNull()

    def one(kind, condition, text):
        record = F.struct(F.lit(topics[kind]).alias("topic"), text.alias("value"))
        return F.when(condition, F.array(record))

    def many(kind, items):
        return F.when(paged & F.col(items).isNotNull(), F.transform(items, lambda item: F.struct(
            F.lit(topics[kind]).alias("topic"),
            _json_of(common=common, page=page, ts=ts, **{kind: item}).alias("value"))))

    records = [
        one("err", F.col("err").isNotNull(), F.col("err")),
        one("start", started, _json_of(common=common, start=F.col("start"), ts=ts)),
        one("page", paged, _json_of(common=common, page=page, ts=ts)),
        many("display", "displays"),
        many("action", "actions"),
    ]
    every = F.flatten(F.array_compact(F.array(*records)))
    if "_dirty" in clean.columns:
        every = F.when(F.col("_dirty"), one("dirty", F.lit(True), F.col("value"))).otherwise(every)
    return clean.select(F.inline(every))


def pages(df, page_ids=None):
    """Page records as flat columns, optionally only of some pages."""
    from brookmart.functions.timecols import gate
    if page_ids is not None:
        df = gate(df, F.col("page")["page_id"].isin(page_ids))
    keep = [c for c in ("ts", "et") if c in df.columns]
    return df.select(
        *[F.col("common")[c].alias(c) for c in ("mid", "vc", "ch", "ar", "is_new", "sid")],
        F.col("page")["page_id"].alias("page_id"), F.col("page")["last_page_id"].alias("last_page_id"),
        F.coalesce(F.expr("try_cast(page['during_time'] AS bigint)"), F.lit(0)).cast("bigint").alias("during_time"),
        *keep)


def search_events(page_log):
    """Searches: text and time of pages reached from the search page by keyword."""
    from brookmart.functions.timecols import gate
    page = F.col("page")
    found = gate(page_log, page["item"].isNotNull() & (page["last_page_id"] == "search")
                 & (page["item_type"] == "keyword"))
    return found.select(page["item"].alias("item"), "et")
