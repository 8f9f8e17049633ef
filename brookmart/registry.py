"""Registered queries: every operator and pipeline over the whole test tables."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from brookmart import testviews as V
from brookmart.functions.names import to_camel, to_snake_json
from brookmart.functions.text import register_split_word, split_keyword
from brookmart.functions.timecols import window_texts, with_event_time
from brookmart.operators import cdc, joins, logs, retract, rules, visits, windows
from brookmart.plans import routing, sku, trade, traffic
from brookmart.schemas import SKU_AMOUNTS
from brookmart.session import configure, stream_settings, work_folder
from brookmart.sinks import topics as topic_sinks
from brookmart.sinks.store import KeyedTable, folder_of
from brookmart.sources import rules as rule_sources
from brookmart.sources import topics
from brookmart.sources.tables import dictionary
from brookmart.sinks.tables import apply_rule_ddl
from brookmart.streaming import visitors
from brookmart.streaming.closing import ClosedWindows
from brookmart.streaming.jobs import (dims_to, looked_up, read_dims, records_to, routed_to,
                                     rows_to, rule_tables_to, rule_views_to, run_stream, upsert_to)

AMOUNTS = list(SKU_AMOUNTS.values())
ORDER_TABLES = ["order_detail", "order_info", "order_detail_activity", "order_detail_coupon"]
REFUND_TABLES = ["order_info", "order_refund_info"]
QUERIES = {}


def query(function):
    """Register a function of (spark, tables) under its name."""
    def run(spark, sf_dir):
        return function(configure(spark), V.Tables(spark, sf_dir))
    QUERIES[function.__name__] = run
    return function


# --- sources ------------------------------------------------------------------

def drain(spark, stream, name, mode="append", feed=None):
    """Run a stream over what is there (or over all pieces of its feed), and read back what it wrote."""
    folder = work_folder(spark, name)
    (feed or Feed(spark)).run(stream, rows_to(f"{folder}/out"), folder, mode)
    return spark.read.schema(stream.schema).parquet(f"{folder}/out/batch_id=*")


@query
def src_text_topic(spark, t):
    folder = work_folder(spark, "topic")
    V.log_text(t).write.mode("overwrite").parquet(folder)
    return drain(spark, topics.read_text_topic(spark, "topic_log", {"format": "parquet", "path": folder}), "src")


@query
def src_json_topic(spark, t):
    text = t.orders.select(F.to_json(F.struct("o_orderkey", "o_custkey", "o_orderpriority")).alias("value"))
    return topics.parse_json_topic(text, "o_orderkey bigint, o_orderpriority string, o_comment string")


@query
def ods_envelope(spark, t):
    text = V.cart_changes(t).select(F.to_json(F.struct("*")).alias("value"))
    return topics.read_ods_db(text).select(
        "database", "table", "type", F.col("data")["id"].alias("id"), F.col("data")["sku_num"].alias("sku_num"),
        F.col("old")["sku_num"].alias("old_num"), "ts", F.date_format("et", "yyyy-MM-dd HH:mm:ss").alias("et"))


@query
def page_log(spark, t):
    text = V.search_pages(t).select(F.to_json(F.struct("page", "ts")).alias("value"))
    return topics.read_page_log(text).select(
        F.col("page")["item"].alias("item"), F.col("page")["item_type"].alias("item_type"),
        F.col("page")["missing"].alias("missing"), "ts",
        F.date_format("et", "yyyy-MM-dd HH:mm:ss.SSS").alias("et"))


@query
def order_detail_source(spark, t):
    text = topic_sinks.upsert_records(trade.order_detail(V.ods(t, *ORDER_TABLES)), ["id"]).select("value")
    return topics.read_order_detail(text).select(
        "id", "order_id", "activity_id", "split_original_amount", "ts",
        F.date_format("et", "yyyy-MM-dd HH:mm:ss").alias("et"))


@query
def rule_changes(spark, t):
    return rule_sources.read_rule_changes(V.rule_change_text(t), "dwd")


@query
def rule_snapshot(spark, t):
    stored = t.part.selectExpr("concat('tbl_', p_partkey) as source_table", "'insert' as source_type",
                               "p_brand as sink_table", "'id,name' as sink_columns")
    return rule_sources.snapshot_as_changes(stored)


@query
def dim_dic(spark, t):
    names = t.orders.select("o_orderpriority").distinct()
    return names.select(*dictionary(F.substring("o_orderpriority", 1, 1), F.expr("substr(o_orderpriority, 3)"))).select(
        "dic_code", F.col("info.dic_name").alias("dic_name"))


# --- projections and filters ----------------------------------------------------

@query
def valid_changes(spark, t):
    changes = V.cart_changes(t).withColumns({
        "database": F.when(F.expr("ts div 86400 % 7 = 0"), "other").otherwise(F.col("database")),
        "type": F.when(F.expr("ts div 86400 % 5 = 0"), "query").otherwise(F.col("type")),
        "data": F.when(F.col("data")["sku_num"] == "7", F.create_map().cast("map<string,string>"))
                 .when(F.col("data")["sku_num"] != "8", F.col("data"))})
    return cdc.valid_changes(changes, V.DATABASE).select(
        "table", "type", F.col("data")["id"].alias("id"), F.col("data")["sku_num"].alias("sku_num"), "ts")


@query
def ods_branch(spark, t):
    return cdc.branch(V.ods(t), "order_info", "insert",
                      {"id": "id", "buyer": "user_id", "province_id": "province_id"}).drop("et")


@query
def status_transition(spark, t):
    return cdc.branch(V.ods(t), "order_info", "update", ["id", "operate_time", "order_status"],
                      where=cdc.changed_to("order_status", "1006", "1005") |
                      cdc.changed_to("order_status", "1003")).drop("et")


@query
def search_events(spark, t):
    return logs.search_events(V.search_pages(t)).select("item", F.date_format("et", "yyyy-MM-dd HH:mm:ss.SSS").alias("et"))


@query
def rule_project(spark, t):
    in_force = rules.current_rules(V.dim_rules(spark), ["source_table"])
    matched = rules.match_rules(V.part_changes(t), in_force, ["table"])
    return rules.project_by_rule(matched).select(
        "type", "seq", F.col("data")["p_partkey"].alias("p_partkey"), F.col("data")["p_name"].alias("p_name"),
        F.col("data")["p_brand"].alias("p_brand"), F.col("data")["p_size"].alias("p_size"),
        F.array_join(F.array_sort(F.map_keys("data")), ",").alias("columns"))


@query
def camel_columns(spark, t):
    return to_camel(t.supplier.selectExpr("s_suppkey as supp_key", "s_name as supp_long_name"))


@query
def sink_json_rows(spark, t):
    rows = t.orders.selectExpr("cast(o_orderkey as string) as orderKey", "o_orderstatus as orderStatus",
                               "o_custkey as custKey", "o_orderdate as ts")
    return to_snake_json(rows, ["orderKey", "orderStatus", "custKey"])


# --- logs -----------------------------------------------------------------------

@query
def log_dirty(spark, t):
    return traffic.split_logs(V.log_text(t))["dirty"]


@query
def log_clean(spark, t):
    clean, _ = logs.split_dirty(logs.parse_log(V.log_text(t)))
    return clean.select(
        *[F.col("common")[c].alias(c) for c in ("mid", "vc", "ch", "ar", "is_new", "sid")],
        F.col("page")["page_id"].alias("page_id"), "start", "err",
        F.array_join("displays", ";").alias("displays"), F.array_join("actions", ";").alias("actions"), "ts")


def _flat_page(df, *more):
    return df.select(F.col("common")["mid"].alias("mid"), F.col("common")["is_new"].alias("is_new"),
                     F.col("common")["sid"].alias("sid"), F.col("page")["page_id"].alias("page_id"),
                     F.col("page")["last_page_id"].alias("last_page_id"),
                     F.col("page")["during_time"].alias("during_time"), *more, "ts")


@query
def fix_is_new(spark, t):
    return traffic.cleaned_log(V.log_text(t)).select(
        F.col("common")["mid"].alias("mid"), F.col("common")["is_new"].alias("is_new"), "ts")


@query
def log_err(spark, t):
    return traffic.split_logs(V.log_text(t))["err"]


@query
def log_start(spark, t):
    return traffic.split_logs(V.log_text(t))["start"].select(
        F.col("common")["mid"].alias("mid"), F.col("common")["is_new"].alias("is_new"), "start", "ts")


@query
def log_page(spark, t):
    return _flat_page(traffic.split_logs(V.log_text(t))["page"])


@query
def log_display(spark, t):
    return _flat_page(traffic.split_logs(V.log_text(t))["display"], "display")


@query
def log_action(spark, t):
    return _flat_page(traffic.split_logs(V.log_text(t))["action"], "action")


@query
def log_records(spark, t):
    return logs.log_records(traffic.cleaned_log(V.log_text(t)))


# --- joins ----------------------------------------------------------------------

@query
def join_inner(spark, t):
    ods = V.ods(t, "order_detail", "order_info")
    detail = cdc.branch(ods, "order_detail", "insert", ["id", "order_id", "sku_id"]).drop("et")
    info = cdc.branch(ods, "order_info", "insert", {"oi_id": "id", "user_id": "user_id"}, keep=()).drop("et")
    return joins.fact_join(detail, info, [("order_id", "oi_id")]).drop("oi_id")


@query
def join_left(spark, t):
    ods = V.ods(t, "order_detail", "order_detail_coupon")
    detail = cdc.branch(ods, "order_detail", "insert", ["id", "sku_id"]).drop("et")
    coupon = cdc.branch(ods, "order_detail_coupon", "insert", {"cou_id": "order_detail_id", "coupon_id": "coupon_id"},
                        keep=()).drop("et")
    return joins.fact_join(detail, coupon, [("id", "cou_id")], "left").drop("cou_id")


@query
def interval_join(spark, t):
    ods = V.ods(t, "order_detail", "payment_info")
    detail = cdc.branch(ods, "order_detail", "insert", ["id", "order_id"])
    paid = (cdc.branch(ods, "payment_info", "update", {"pay_order": "order_id"}, keep=())
            .withColumnRenamed("et", "pay_et"))
    found = joins.interval_join(detail, paid, [("order_id", "pay_order")], -1800, 5, "et", "pay_et")
    return found.select("id", "order_id", F.unix_timestamp("et").alias("order_s"), F.unix_timestamp("pay_et").alias("pay_s"))


def _priorities(t):
    return t.orders.selectExpr("cast(o_orderkey as string) as id", "substr(o_orderpriority, 1, 1) as code")


@query
def lookup_inner(spark, t):
    return joins.lookup_inner(_priorities(t), V.dictionary(spark), "code", "dic_code", {"info.dic_name": "name"})


@query
def lookup_left(spark, t):
    return joins.lookup_left(_priorities(t), V.dictionary(spark), "code", "dic_code", {"info.dic_name": "name"})


@query
def lookup_chain(spark, t):
    rows = t.lineitem.selectExpr(f"{V.LINE_ID} as id", "cast(l_partkey as string) as sku_id", "l_suppkey")
    return joins.enrich_snowflake(rows, V.sku_dims(t), joins.SKU_CHAIN)


@query
def rule_connect_dim(spark, t):
    in_force = rules.current_rules(V.dim_rules(spark), ["source_table"])
    return rules.match_rules(V.part_changes(t), in_force, ["table"]).select(
        F.col("data")["p_partkey"].alias("p_partkey"), "type", "seq", "sink_table", "sink_row_key")


@query
def split_word(spark, t):
    name = register_split_word(spark)
    t.documents.select("doc_id", "text").createOrReplaceTempView("brookmart_documents")
    return spark.sql(f"SELECT doc_id, word FROM brookmart_documents, LATERAL {name}(text)")


@query
def split_keyword_counts(spark, t):
    return split_keyword(t.documents.select("text"), "text").groupBy("keyword").agg(F.count(F.lit(1)).alias("n"))


# --- aggregations -----------------------------------------------------------------

@query
def rules_current(spark, t):
    changes = rule_sources.read_rule_changes(V.rule_change_text(t), "dwd")
    return rules.current_rules(changes, ["source_table", "source_type"])


@query
def upsert_latest(spark, t):
    return topic_sinks.latest_per_key(V.sku_details(t), "id", V.VERSION)


def _page_rows(t):
    return logs.pages(traffic.split_logs(V.log_text(t))["page"])


@query
def uv_first_of_day(spark, t):
    return visits.first_of_day(_page_rows(t), ["mid"], flag="uv").select("mid", "ts", "uv")


@query
def uv_by_page(spark, t):
    rows = _page_rows(t).filter(F.col("page_id").isin("home", "good_detail"))
    return visits.first_of_day(rows, ["mid", "page_id"], flag="uv").select("mid", "page_id", "ts", "uv")


@query
def session_flag(spark, t):
    return visits.session_flag(_page_rows(t)).select("mid", "ts", "last_page_id", "sv_ct")


@query
def sku_retract(spark, t):
    rows = retract.to_amounts(V.sku_details(t), SKU_AMOUNTS)
    return retract.retract_updates(rows, "id", V.VERSION, AMOUNTS)


@query
def sku_window(spark, t):
    rows = retract.to_amounts(V.sku_details(t), SKU_AMOUNTS)
    return windows.sku_window(rows, "id", V.VERSION, AMOUNTS)


@query
def window_bounds(spark, t):
    rows = with_event_time(t.events.selectExpr("unix_millis(ts) as ts", "cast(value as decimal(16,2)) as value"))
    return window_texts(rows.groupBy(F.window("et", "10 seconds")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").cast("decimal(38,2)").alias("total")))


# --- pipelines ----------------------------------------------------------------------

@query
def dim_sync(spark, t):
    merged = routing.dim_sync(V.part_changes(t), V.dim_rules(spark), V.DATABASE)
    return merged.select("sink_table", "row_key", F.explode("data").alias("column_name", "value"))


@query
def dim_table(spark, t):
    merged = routing.dim_sync(V.part_changes(t), V.dim_rules(spark), V.DATABASE)
    return rules.dim_table(merged, "dim_part", ["p_name", "p_brand", "missing_col"])


@query
def base_db_route(spark, t):
    return routing.route_facts(V.source_changes(t), V.fact_rules(spark))


@query
def dwd_comment_info(spark, t):
    return trade.comments(V.ods(t, "comment_info"), V.dictionary(spark))


@query
def dwd_cart_add(spark, t):
    return trade.cart_additions(V.ods(t, "cart_info"))


@query
def dwd_order_detail(spark, t):
    return trade.order_detail(V.ods(t, *ORDER_TABLES))


def _detail_source(t):
    """The order-detail fact with event time, as its consumers read it."""
    return trade.order_detail(V.ods(t, *ORDER_TABLES)).withColumn("et", F.timestamp_seconds("ts"))


@query
def dwd_order_cancel(spark, t):
    return trade.order_cancel(_detail_source(t), V.ods(t, "order_info"))


@query
def dwd_pay_success(spark, t):
    return trade.pay_success(_detail_source(t), V.ods(t, "payment_info"), V.dictionary(spark))


@query
def dwd_order_refund(spark, t):
    return trade.order_refund(V.ods(t, *REFUND_TABLES), V.dictionary(spark))


@query
def dwd_refund_pay(spark, t):
    return trade.refund_pay(V.ods(t, *REFUND_TABLES), V.dictionary(spark))


@query
def dws_keyword_window(spark, t):
    return traffic.keyword_window(V.search_pages(t))


@query
def dws_keyword_window_10s(spark, t):
    return traffic.keyword_window(V.search_pages(t), 10)


@query
def dws_traffic_window(spark, t):
    return traffic.traffic_window(traffic.split_logs(V.log_text(t))["page"])


@query
def dws_home_detail(spark, t):
    return traffic.home_detail_window(traffic.split_logs(V.log_text(t))["page"])


@query
def dws_sku_order(spark, t):
    return sku.sku_order_window(V.sku_details(t), V.sku_dims(t), V.VERSION)


# --- streams --------------------------------------------------------------------------

#: Every stream reads its table in so many micro-batches.
PIECES = 4


class Feed:
    """Tables as streams that grow by a piece at a time.

    A table is written once, each row straight into the folder of its piece: no shuffle, no second
    copy. `run` puts the next piece of every table into its source and drains the stream, which goes on from
    its checkpoint, so a batch is a piece.
    """

    def __init__(self, spark):
        self.spark, self.folders = spark, []

    def stream(self, df, folder, by, closing=None):
        """`df` as a stream. `by` orders the rows over the pieces, or is a list of columns whose hash deals them.

        `df` may be a list of tables, which are written one after another: the shuffles of one are gone before the next begins.
        `closing` maps columns to SQL expressions: a last row like that ends the windows and joins that
        wait for time, and is no part of any result.
        """
        files, _ = folder_of(self.spark, folder)
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        parts = df if isinstance(df, list) else [df]
        df = reduce(lambda a, b: a.unionByName(b), parts)
        if isinstance(by, str):
            cuts = df.agg(F.percentile_approx(F.expr(by), [i / PIECES for i in range(1, PIECES)], 10_000)).first()[0] or []
            piece = sum((F.coalesce(F.expr(by) > F.lit(c), F.lit(False)).cast("int") for c in cuts), F.lit(0))
        else:
            piece = F.pmod(F.xxhash64(*by), F.lit(PIECES))
        # With a writer for each piece, no row is sorted by its piece.
        with stream_settings(self.spark, {"spark.sql.maxConcurrentOutputFileWriters": str(PIECES)}):
            for part in parts:
                part.withColumn("_piece", piece.cast("int")).write.mode("append").partitionBy("_piece").parquet(f"{folder}/whole")
        files.mkdirs(path(f"{folder}/in"))
        if not any(files.exists(path(f"{folder}/whole/_piece={i}")) for i in range(PIECES)):
            df.limit(0).coalesce(1).write.parquet(f"{folder}/whole/_piece=0")  # a table without rows is a batch too
        elif closing:
            whole = self.spark.read.schema(df.schema).parquet(f"{folder}/whole")
            last = whole.limit(1).crossJoin(whole.agg(F.max(F.expr(by)).alias("_last")))  # one row beside one row
            last.select(*[F.expr(closing[c]).cast(df.schema[c].dataType).alias(c) if c in closing else c for c in df.columns]).write.parquet(
                f"{folder}/whole/_piece={PIECES}")
        self.folders.append(folder)
        return self.spark.readStream.schema(df.schema).option("recursiveFileLookup", True).parquet(f"{folder}/in")

    def run(self, stream, write_batch, folder, mode="append"):
        """Drain the stream after each piece; where the pieces are used up already, once.

        A piece that was drained is removed, as a topic drops what its readers are past: the checkpoint holds that it was read.
        """
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        moves = [[(f"{place}/whole/_piece={i}", f"{place}/in/{i}") for place in self.folders if self._is_there(f"{place}/whole/_piece={i}")]
                 for i in range(PIECES + 1)]
        for pieces in [m for m in moves if m] or [[]]:
            for source, target in pieces:
                folder_of(self.spark, source)[0].rename(path(source), path(target))
            run_stream(stream, write_batch, f"{folder}/checkpoint", drain=True, mode=mode).awaitTermination()
            for _, target in pieces:
                folder_of(self.spark, target)[0].delete(path(target), True)

    def _is_there(self, place):
        files, place = folder_of(self.spark, place)
        return files.exists(place)


def _event_stream(t, feed):
    """The events table as a stream of log text."""
    return V.log_text(t, feed.stream(t.events, work_folder(t.spark, "events"), "ts"))


def _log_deltas(spark, t, write, clean=traffic.clean_log):
    """Run the log stream with repaired marks; `write(records, batch id, folder)` gets each batch."""
    folder = work_folder(spark, "logs")
    fix = visitors.fix_is_new_deltas(f"{folder}/visitors")

    def repaired(batch, batch_id):
        records = clean(batch).persist()
        write(fix(records, batch_id), batch_id, folder)
        records.unpersist()

    feed = Feed(spark)
    feed.run(_event_stream(t, feed), repaired, folder)
    return folder


def _page_deltas(spark, t, results, keys):
    """Windows over the page records of the log stream; newer sums of a window replace older ones."""
    held = {}

    def write(records, batch_id, folder):
        rows = logs.pages(logs.split_log(records)["page"]).persist()
        upsert_to(f"{folder}/out")(held.setdefault("results", results(f"{folder}/windows"))(rows, batch_id), batch_id)
        rows.unpersist()

    return topic_sinks.read_upsert(spark, f"{_log_deltas(spark, t, write)}/out", keys)


def _ended(spark, store):
    """Remove what a stream kept for batches to come: its topics have ended."""
    files, place = folder_of(spark, store)
    files.delete(place, True)


def _written(spark, folder):
    return spark.read.option("basePath", f"{folder}/out").parquet(f"{folder}/out").drop("batch_id")


@query
def stream_fix_is_new(spark, t):
    def write(records, batch_id, folder):
        rows_to(f"{folder}/out")(records.select(F.col("common")["mid"].alias("mid"), F.col("common")["is_new"].alias("is_new"), "ts"), batch_id)
    return _written(spark, _log_deltas(spark, t, write))


@query
def uv_stream(spark, t):
    held = {}

    def write(records, batch_id, folder):
        first = held.setdefault("first", visitors.first_of_day_deltas(f"{folder}/days", ["mid"], flag="uv"))
        rows = logs.pages(logs.split_log(records)["page"]).select("mid", "ts").persist()
        rows_to(f"{folder}/out")(first(rows, batch_id), batch_id)
        rows.unpersist()

    return _written(spark, _log_deltas(spark, t, write))


@query
def stream_traffic_window(spark, t):
    return _page_deltas(spark, t, visitors.traffic_window_deltas, visitors.TRAFFIC_KEY)


@query
def stream_home_detail(spark, t):
    return _page_deltas(spark, t, visitors.home_detail_window_deltas, ["stt"])


@query
def late_drop(spark, t):
    """Events with k = 13 come after all windows are closed, and are dropped."""
    rows = t.events.withColumn("_late", F.expr("get_json_object(props, '$.k') = '13'"))
    folder = work_folder(spark, "late")
    feed = Feed(spark)
    stream = feed.stream(rows.filter("not _late"), folder, "ts", {"ts": "_last + interval 1 day"})
    counts = with_event_time(stream.selectExpr("unix_millis(ts) as ts")).groupBy(F.window("et", "10 seconds")).agg(
        F.count(F.lit(1)).alias("n"))
    for _ in range(2):  # the second run goes on from the checkpoint of the first
        feed.run(window_texts(counts), rows_to(f"{folder}/out"), folder)
        rows.filter("_late").write.mode("append").parquet(f"{folder}/in")
    return spark.read.option("basePath", f"{folder}/out").parquet(f"{folder}/out").drop("batch_id")


def _stream_of(feed, t, *names):
    """The test tables, with the named ones read as streams."""
    tables = V.Tables(feed.spark, t.folder)
    for name in names:
        table = getattr(t, name)
        setattr(tables, name, feed.stream(table, work_folder(feed.spark, name), table.columns))
    return tables


def _sku_deltas(spark, t, enrich=lambda sums: sums):
    """Line items in any order, summed by differences; newer sums of a window replace older ones."""
    folder = work_folder(spark, "sku")
    sums = sku.sku_sums_deltas(f"{folder}/deltas", V.VERSION)

    def write(batch, batch_id):
        upsert_to(f"{folder}/out")(enrich(sums(batch, batch_id)), batch_id)

    feed = Feed(spark)
    feed.run(V.sku_details(_stream_of(feed, t, "lineitem")), write, folder)
    return topic_sinks.read_upsert(spark, f"{folder}/out", ["stt", "sku_id"])


@query
def stream_sku_window(spark, t):
    return _sku_deltas(spark, t)


@query
def stream_sku_order(spark, t):
    return _sku_deltas(spark, t, lambda sums: sku.with_products(sums, V.sku_dims(t)))


@query
def stream_keyword_window(spark, t):
    """A window is written when event time has passed it; a last row closes those that are open."""
    folder, feed = work_folder(spark, "search"), Feed(spark)
    pages = feed.stream(V.search_pages(t).drop("et"), f"{folder}/pages", "ts", {"ts": "_last + 86400000"})
    windows_of = ClosedWindows(f"{folder}/open", with_event_time(pages, delay=None).schema, 5)

    def write(batch, batch_id):
        rows_to(f"{folder}/out")(traffic.keyword_window(windows_of.closed(with_event_time(batch, delay=None), batch_id)), batch_id)

    feed.run(pages, write, folder)
    return _written(spark, folder)


@query
def stream_upsert_latest(spark, t):
    folder, feed = work_folder(spark, "upsert"), Feed(spark)
    feed.run(V.sku_details(_stream_of(feed, t, "lineitem")), upsert_to(f"{folder}/log", ["id"], V.VERSION), folder)
    return topic_sinks.latest_per_key(spark.read.parquet(f"{folder}/log").drop("batch_id"), ["id"], V.VERSION)


@query
def stream_keyed_table(spark, t):
    """The newest version of each detail, in a table that folds its batches while readers keep its path."""
    folder, feed = work_folder(spark, "table"), Feed(spark)
    details = V.sku_details(_stream_of(feed, t, "lineitem"))
    table = KeyedTable(f"{folder}/table", details.schema, ["id"], V.VERSION, across=True, fold_every=2)
    feed.run(details, table.upsert, folder)
    return table.current(spark)


@query
def stream_log_records(spark, t):
    def write(records, batch_id, folder):
        records_to({"format": "text", "path": f"{folder}/out"})(logs.log_records(records), batch_id)
    folder = _log_deltas(spark, t, write, lambda text: logs.mark_dirty(logs.parse_log(text)))
    return spark.read.text(f"{folder}/out").select("topic", "value")


@query
def stream_base_db_route(spark, t):
    folder, feed = work_folder(spark, "route"), Feed(spark)
    feed.run(V.source_changes(_stream_of(feed, t, "orders", "lineitem")),
             routed_to(lambda: V.fact_rules(spark), {"format": "text", "path": f"{folder}/out"}), folder)
    return spark.read.text(f"{folder}/out").select("topic", "value")


def _dim_changes_to(spark, t, folder):
    """A topic of part changes in the order of `seq`, written to the dimension changelog."""
    changes = V.part_changes(t)
    text = changes.select(F.to_json(F.struct(*[c for c in changes.columns if c != "seq"])).alias("value"), "seq")
    feed = Feed(spark)
    feed.stream(text, folder, "seq")
    topic = topics.read_text_topic(spark, "topic_db", {"format": "parquet", "path": f"{folder}/in", "schema": "value string, seq bigint",
                                                         "recursiveFileLookup": "true"}, order="seq")
    feed.run(topics.read_ods_db(topic), dims_to(lambda: V.dim_rules(spark), f"{folder}/log", V.DATABASE), folder)
    return f"{folder}/log"


@query
def stream_dim_sync(spark, t):
    log = _dim_changes_to(spark, t, work_folder(spark, "dims"))
    return read_dims(spark, log, V.dim_rules(spark)).select("sink_table", "row_key", F.explode("data").alias("column_name", "value"))


@query
def rule_views(spark, t):
    """Rules come before any row; their view follows the rows, and a later rule's new column shows older ones."""
    folder = work_folder(spark, "views")
    first = V.dim_rules(spark)
    later = first.withColumns({"op": F.lit("u"), "sink_columns": F.lit("p_name,p_size"), "seq": F.lit(2).cast("bigint")})
    database = f"views_{folder[-32:]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/tables'")
    views = rule_views_to(f"{folder}/log", database)
    views(first, 0)
    _dim_changes_to(spark, t, folder)
    views(later, 1)
    return spark.table(f"{database}.dim_part")


@query
def rule_ddl(spark, t):
    """A rule makes a table, its update adds a column; the table is filled anew from the changelog."""
    folder = work_folder(spark, "ddl")
    log = _dim_changes_to(spark, t, folder)
    first = V.dim_rules(spark)
    later = first.withColumns({"op": F.lit("u"), "sink_columns": F.lit("p_name,p_size"), "seq": F.lit(2).cast("bigint")})
    database = f"rules_{folder[-32:]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/tables'")
    apply_rule_ddl(spark, first, database)
    rule_tables_to(log, database)(later, 0)
    return spark.table(f"{database}.dim_part")


def _looked_up(spark, feed, stream, dims, enrich):
    """Run a stream whose rows are looked up in the dimensions of each batch, and read it back."""
    folder = work_folder(spark, "facts")
    feed.run(stream, looked_up(rows_to(f"{folder}/out"), dims, enrich), folder)
    return spark.read.option("basePath", f"{folder}/out").parquet(f"{folder}/out").drop("batch_id")


def _ods_stream(t, feed, *names):
    """Row changes as a topic in the order of time, then one of no table that ends all joins."""
    folder = work_folder(t.spark, "ods")
    text = V.ods(t, *names).drop("et").select(F.to_json(F.struct("*")).alias("value"), "ts")
    rows = feed.stream(text, folder, "ts", {
        "value": f"""concat('{{"database":"{V.DATABASE}","table":"none","type":"insert","ts":', _last + 86400 * 40000L, '}}')"""})
    return topics.read_ods_db(rows.select("value"))


def _slices(t, n=PIECES):
    """The tables by slices of the orders: an order is in one of them, with its line items and all that is derived of these."""
    for i in range(n):
        tables = V.Tables(t.spark, t.folder)
        for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
            setattr(tables, name, getattr(t, name).filter(F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(n)) == i))
        yield tables


def _delta_stream(spark, t, names, results, keys=None, enrich=lambda rows: rows):
    """Run the row changes of tables, in any order, through delta joins; rows of the same `keys` replace each other."""
    folder = work_folder(spark, "deltas")
    text = [V.ods(part, *names).drop("et").select(F.to_json(F.struct("*")).alias("value")) for part in _slices(t)]
    feed = Feed(spark)
    stream = feed.stream(text, folder, ["value"])
    joined = results(f"{folder}/joined")

    def write(batch, batch_id):
        rows = topics.read_ods_db(batch).persist()
        (upsert_to if keys else rows_to)(f"{folder}/out")(enrich(joined(rows, batch_id)), batch_id)
        rows.unpersist()

    feed.run(stream, write, folder)
    _ended(spark, f"{folder}/joined")
    if keys:
        return topic_sinks.read_upsert(spark, f"{folder}/out", keys)
    return spark.read.option("basePath", f"{folder}/out").parquet(f"{folder}/out").drop("batch_id")


@query
def stream_order_detail(spark, t):
    """Items appear at once and are corrected by activities and coupons that come later."""
    key = trade.DETAIL_KEY  # ids repeat in the test tables
    return _delta_stream(spark, t, ORDER_TABLES, lambda path: trade.order_detail_deltas(path, key), key)


def _details_and_changes(spark, t, table, results, write=lambda rows: rows):
    """Run the order-detail fact and the changes of a table, two topics in any order between them, through a delta join."""
    folder, feed = work_folder(spark, table), Feed(spark)
    details = [topic_sinks.upsert_records(trade.order_detail(V.ods(part, *ORDER_TABLES)), ["id"]).select("value", F.lit("detail").alias("topic"))
               for part in _slices(t)]
    changes = V.ods(t, table).drop("et").select(F.to_json(F.struct("*")).alias("value"), F.lit("ods").alias("topic"))
    stream = feed.stream([*details, changes], folder, ["value"])
    joined = results(f"{folder}/joined")

    def write_batch(batch, batch_id):
        facts, ods = (batch.where(F.col("topic") == name).select("value") for name in ("detail", "ods"))  # each is read once
        rows_to(f"{folder}/out")(write(joined(topics.read_order_detail(facts), topics.read_ods_db(ods), batch_id)), batch_id)

    feed.run(stream, write_batch, folder)
    _ended(spark, f"{folder}/joined")
    return spark.read.option("basePath", f"{folder}/out").parquet(f"{folder}/out").drop("batch_id")


@query
def stream_order_cancel(spark, t):
    return _details_and_changes(spark, t, "order_info", trade.order_cancel_deltas)


@query
def stream_order_refund(spark, t):
    return _delta_stream(spark, t, REFUND_TABLES, trade.refund_request_deltas,
                         enrich=lambda rows: trade.with_refund_names(rows, V.dictionary(spark)))


@query
def stream_refund_pay(spark, t):
    return _delta_stream(spark, t, REFUND_TABLES, trade.refunds_paid_deltas,
                         enrich=lambda rows: trade.with_refund_payment_names(rows, V.dictionary(spark)))


@query
def stream_comment_info(spark, t):
    feed = Feed(spark)
    return _looked_up(spark, feed, trade.comment_rows(_ods_stream(t, feed, "comment_info")), lambda: V.dictionary(spark), trade.with_appraisal_names)


@query
def stream_cart_add(spark, t):
    feed = Feed(spark)
    return drain(spark, trade.cart_additions(_ods_stream(t, feed, "cart_info")), "cart", feed=feed)


@query
def stream_pay_success(spark, t):
    return _details_and_changes(spark, t, "payment_info", trade.payment_deltas,
                                lambda rows: trade.with_payment_names(rows, V.dictionary(spark)))
