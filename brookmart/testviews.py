"""Row changes, logs, rules and dimensions derived from the test tables.

The test tables are a plain star schema, so the inputs of the pipelines are
projections of whole tables: order rows become inserts and status updates, line
items become order details, events become app logs.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from brookmart.sources.tables import literal_rows

DATABASE = "shop"
STAMP = "yyyy-MM-dd HH:mm:ss"


class Tables:
    """The parquet tables of one scale folder; NTZ times become UTC timestamps."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name):
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        times = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
        df = df.withColumns({c: F.col(c).cast("timestamp") for c in times}) if times else df
        setattr(self, name, df)
        return df


def change(df, table, type_, data, ts, old=None, extra=()):
    """Wrap rows as changes. `data` and `old` map column to SQL expression."""
    def as_map(columns):
        return F.create_map(*[x for k, e in columns.items() for x in (F.lit(k), F.expr(f"cast({e} as string)"))])
    return df.select(
        F.lit(DATABASE).alias("database"), F.lit(table).alias("table"),
        (F.lit(type_)).alias("type"), as_map(data).alias("data"),
        (as_map(old) if old else F.lit(None).cast("map<string,string>")).alias("old"),
        F.expr(ts).cast("bigint").alias("ts"), *extra)


def with_et(ods):
    return ods.withColumn("et", F.timestamp_seconds("ts"))


# --- orders -----------------------------------------------------------------

def order_rows(t):
    return t.orders.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))


def order_inserts(t):
    return change(order_rows(t), "order_info", "insert",
                  {"id": "o_orderkey", "user_id": "o_custkey", "province_id": "c_nationkey"},
                  "unix_timestamp(o_orderdate)")


def order_updates(t):
    rows = order_rows(t)
    data = {"id": "o_orderkey", "user_id": "o_custkey", "province_id": "c_nationkey",
            "operate_time": f"date_format(o_orderdate + interval 1 hour, '{STAMP}')"}
    first = change(rows, "order_info", "update",
                   {**data, "order_status": "case o_orderstatus when 'F' then '1003' when 'P' then '1005' else '1002' end"},
                   "unix_timestamp(o_orderdate) + 3600", {"order_status": "'1001'"})
    second = change(rows.filter("o_orderstatus = 'P' and o_orderkey % 2 = 0"), "order_info", "update",
                    {**data, "order_status": "'1006'"},
                    "unix_timestamp(o_orderdate) + 7200", {"order_status": "'1005'"})
    return first.unionByName(second)


LINE_ID = "concat(l_orderkey, '-', l_linenumber)"
PRICE = "cast(l_extendedprice as decimal(16,2))"
ACTIVITY_AMOUNT = f"case when l_discount >= 0.05 then {PRICE} * cast(l_discount as decimal(16,2)) end"
COUPON_AMOUNT = f"case when l_returnflag = 'R' then {PRICE} * cast(l_tax as decimal(16,2)) end"


def line_rows(t):
    """Line items as texts, with their part, and joined to their order by the text that changes hold.

    Texts are made before the join: the map of a change then holds plain columns, so the optimizer takes them out of
    it again, and a later join on `order_id` finds its rows in place.
    """
    parts = t.part.select("p_partkey", "p_name")
    orders = t.orders.select(F.col("o_orderkey").cast("string").alias("_order"), "o_orderdate")
    texts = {"id": LINE_ID, "order_id": "l_orderkey", "sku_id": "l_partkey", "sku_name": "p_name", "sku_num": "cast(l_quantity as int)", "price": PRICE,
             "activity_amount": ACTIVITY_AMOUNT, "coupon_amount": COUPON_AMOUNT}
    return (t.lineitem.join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .select("l_linenumber", *[F.expr(f"cast({e} as string)").alias(c) for c, e in texts.items()])
            .join(orders, F.col("order_id") == F.col("_order"))
            .withColumn("d_et", F.expr("o_orderdate + make_dt_interval(0, 0, 6 * l_linenumber, 0)")))


def detail_inserts(t):
    return change(line_rows(t), "order_detail", "insert", {
        "id": "id", "order_id": "order_id", "sku_id": "sku_id", "sku_name": "sku_name",
        "create_time": f"date_format(d_et, '{STAMP}')", "sku_num": "sku_num",
        "order_price": "price", "split_total_amount": "price",
        "split_activity_amount": "activity_amount", "split_coupon_amount": "coupon_amount"},
        "unix_timestamp(d_et)")


def activity_inserts(t):
    one = t.lineitem.filter("l_discount >= 0.05").groupBy(F.expr(LINE_ID).alias("id")).agg(F.min("l_suppkey").alias("a"))
    return change(one, "order_detail_activity", "insert",
                  {"order_detail_id": "id", "activity_id": "a", "activity_rule_id": "a % 3"}, "0")


def coupon_inserts(t):
    one = t.lineitem.filter("l_returnflag = 'R'").groupBy(F.expr(LINE_ID).alias("id")).agg(F.min("l_partkey").alias("p"))
    return change(one, "order_detail_coupon", "insert",
                  {"order_detail_id": "id", "coupon_id": "p % 7"}, "0")


def payment_updates(t):
    rows = t.orders.filter("o_orderstatus = 'O'").withColumn("p_et", F.expr(
        "o_orderdate + interval 36 minutes - make_dt_interval(0, 0, 0, if(o_orderkey % 2 = 1, 5, 0))"))
    return change(rows, "payment_info", "update", {
        "user_id": "o_custkey", "order_id": "o_orderkey", "payment_type": "substr(o_orderpriority, 1, 1)",
        "callback_time": f"date_format(p_et, '{STAMP}')", "payment_status": "'1602'"},
        "unix_timestamp(p_et)", {"payment_status": "'1601'"})


def _refund_rows(t):
    orders = t.orders.filter("o_orderstatus = 'P'")
    lines = t.lineitem.groupBy("l_orderkey", "l_partkey").agg(
        F.min("l_linenumber").alias("ln"), F.min("l_quantity").alias("qty"), F.min("l_extendedprice").alias("price"))
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))


REFUND = {"id": "concat(l_orderkey, '-', l_partkey)", "user_id": "o_custkey", "order_id": "l_orderkey",
          "sku_id": "l_partkey"}


def refund_inserts(t):
    return change(_refund_rows(t), "order_refund_info", "insert", {
        **REFUND, "refund_type": "substr(o_orderpriority, 1, 1)", "refund_reason_type": "ln % 3",
        "refund_reason_txt": "concat('line ', ln)", "refund_num": "cast(qty as int)",
        "refund_amount": "cast(price as decimal(16,2))",
        "create_time": f"date_format(o_orderdate + interval 2 hours, '{STAMP}')"},
        "unix_timestamp(o_orderdate) + 7200")


def refund_updates(t):
    rows = _refund_rows(t).filter("o_orderkey % 2 = 0")
    request = change(rows, "order_refund_info", "update",
                     {**REFUND, "refund_num": "cast(qty as int)", "refund_status": "'0705'"},
                     "unix_timestamp(o_orderdate) + 10800", {"refund_status": "'0701'"})
    payment = change(rows, "refund_payment", "update", {
        **REFUND, "payment_type": "substr(o_orderpriority, 1, 1)",
        "callback_time": f"date_format(o_orderdate + interval 3 hours, '{STAMP}')",
        "total_amount": "cast(price as decimal(16,2))", "refund_status": "'1602'"},
        "unix_timestamp(o_orderdate) + 10800", {"refund_status": "'1601'"})
    return request.unionByName(payment)


def cart_changes(t):
    data = {"id": LINE_ID, "user_id": "l_suppkey", "sku_id": "l_partkey", "sku_num": "cast(l_quantity as int)"}
    inserts = change(t.lineitem.filter("l_linenumber = 1"), "cart_info", "insert", data, "unix_timestamp(l_shipdate)")
    updates = change(t.lineitem.filter("l_linenumber <> 1"), "cart_info", "update", data,
                     "unix_timestamp(l_shipdate)",
                     {"sku_num": "case when l_partkey % 10 = 0 then null else l_partkey % 25 end"})
    return inserts.unionByName(updates)


def comment_inserts(t):
    rows = t.labels.join(t.documents.select("doc_id", "source"), "doc_id")
    return change(rows, "comment_info", "insert", {
        "id": "doc_id", "user_id": "doc_id % 100", "sku_id": "doc_id % 50", "appraise": "quality",
        "comment_txt": "source"}, "1700000000 + doc_id")


BRANCHES = {
    "order_info": [order_inserts, order_updates], "order_detail": [detail_inserts],
    "order_detail_activity": [activity_inserts], "order_detail_coupon": [coupon_inserts],
    "payment_info": [payment_updates], "order_refund_info": [refund_inserts, refund_updates],
    "cart_info": [cart_changes], "comment_info": [comment_inserts],
}


def ods(t, *names):
    """Row changes of the named source tables, or of all of them.

    A filter on `table` and `type` prunes the union to the branches it needs;
    naming the tables only saves building the others.
    """
    makers = [make for name in (names or BRANCHES) for make in BRANCHES[name]]
    return with_et(reduce(lambda a, b: a.unionByName(b), [make(t) for make in makers]))


def dictionary(spark):
    """Names of codes. Codes "4" and "0" are missing on purpose."""
    return literal_rows(spark, [("1", {"dic_name": "URGENT"}), ("2", {"dic_name": "HIGH"}),
                                ("3", {"dic_name": "MEDIUM"}), ("5", {"dic_name": "LOW"})],
                        "dic_code string, info struct<dic_name: string>")


# --- product details with versions --------------------------------------------

def sku_details(t):
    """Order details as sold, with versions of a detail ordered by `v1, v2, v3`."""
    return t.lineitem.selectExpr(
        f"{LINE_ID} as id", "cast(l_partkey as string) as sku_id",
        f"cast(cast(l_quantity as decimal(16,2)) * {PRICE} as string) as split_original_amount",
        f"cast({ACTIVITY_AMOUNT} as string) as split_activity_amount",
        f"cast({COUPON_AMOUNT} as string) as split_coupon_amount",
        f"cast({PRICE} as string) as split_total_amount",
        "unix_timestamp(date_trunc('year', l_shipdate)) + 2 * l_linenumber as ts",
        "unix_timestamp(l_shipdate) as v1", "l_partkey as v2", "l_suppkey as v3")


VERSION = ["v1", "v2", "v3"]


def sku_dims(t):
    suppliers = t.supplier.agg(F.count(F.lit(1))).scalar()
    text = lambda df, **cols: df.select(*[F.expr(f"cast({e} as string)").alias(c) for c, e in cols.items()])
    return {
        "dim_sku_info": text(t.part.withColumn("n", suppliers), id="p_partkey", sku_name="p_name", spu_id="p_type",
                             tm_id="p_brand", category3_id="p_partkey % n"),
        "dim_spu_info": text(t.part, id="p_type", spu_name="concat('spu ', p_type)").distinct(),
        "dim_base_trademark": text(t.part.filter("p_brand <> 'Brand#7'"), id="p_brand",
                                   tm_name="concat('tm ', p_brand)").distinct(),
        "dim_base_category3": text(t.supplier, id="s_suppkey", name="s_name", category2_id="s_nationkey"),
        "dim_base_category2": text(t.nation, id="n_nationkey", name="n_name", category1_id="n_regionkey"),
        "dim_base_category1": text(t.region, id="r_regionkey", name="r_name"),
    }


# --- logs -------------------------------------------------------------------

LOG_TEXT = """concat(
  '{"common":{"mid":"', user_id, '","vc":"v', k % 3, '","ch":"c', k % 2, '","ar":"', user_id % 5,
  '","is_new":"', k % 2, '","sid":"', user_id, '-', k % 4, '"}',
  case event_type when 'signup' then concat(',"start":{"entry":"icon","k":', k, '}')
    else concat(',"page":{"page_id":"',
      case event_type when 'click' then 'good_detail' when 'purchase' then 'payment' else 'home' end, '"',
      case when k < 20 then '' else ',"last_page_id":"home"' end,
      ',"during_time":"', cast(cast(value as decimal(16,2)) * 100 as bigint), '"}') end,
  case event_type when 'error' then concat(',"err":{"code":', k, '}') else '' end,
  case event_type when 'purchase'
    then concat(',"displays":[{"pos":0},{"pos":1}],"actions":[{"id":', k, '}]') else '' end,
  ',"ts":', ms, '}')"""


def log_text(t, events=None):
    """App log text. Every record with k = 13 is cut in half, hence malformed."""
    events = (t.events if events is None else events).selectExpr(
        "*", "cast(get_json_object(props, '$.k') as int) as k", "unix_millis(ts) as ms")
    return events.selectExpr("k", f"{LOG_TEXT} as full").selectExpr(
        "case when k = 13 then substr(full, 1, length(full) div 2) else full end as value")


def search_pages(t):
    """Page records of clicks; those with even k are searches for a document's text."""
    documents = t.documents.agg(F.count(F.lit(1))).scalar()
    clicks = (t.events.filter("event_type = 'click'").withColumn("n", documents)
              .selectExpr("event_id % n as doc", "cast(get_json_object(props, '$.k') as int) as k", "unix_millis(ts) as ts"))
    rows = clicks.join(t.documents.select("doc_id", "text"), F.col("doc") == F.col("doc_id"))
    return rows.selectExpr("""map('page_id', 'good_list', 'item', text,
        'last_page_id', if(k % 2 = 0, 'search', 'home'), 'item_type', if(k % 2 = 0, 'keyword', 'sku_id')) as page""",
        "ts", "timestamp_millis(ts) as et")


# --- rules ------------------------------------------------------------------

def rule_change_text(t):
    """Changes of fact rules as text, one per part; keys repeat, so rules get replaced."""
    rule = """struct(concat(lower(p_type), '_', p_size) as source_table,
        if(p_partkey % 2 = 0, 'insert', 'update') as source_type, p_brand as sink_table,
        concat('id,name,', lower(p_type)) as sink_columns)"""
    rows = t.part.selectExpr(
        "case p_partkey % 7 when 0 then 'd' when 1 then 'u' when 2 then 'r' else 'c' end as op",
        f"{rule} as rule", "p_partkey as seq")
    return rows.selectExpr("to_json(struct(op, if(op = 'd', rule, null) as before, "
                           "if(op = 'd', null, rule) as after, seq)) as value")


def dim_rules(spark):
    return literal_rows(spark, [("c", "part", "dim_part", "p_partkey,p_name,p_brand,missing_col", "info", "p_partkey", 1)],
                        "op string, source_table string, sink_table string, sink_columns string, "
                        "sink_family string, sink_row_key string, seq bigint")


def fact_rules(spark):
    """The update rule is deleted again by its last change."""
    return literal_rows(spark, [
        ("c", "orders", "insert", "t_orders", "o_orderkey,o_orderstatus,missing_col", 1),
        ("c", "orders", "update", "t_upd", "o_orderkey", 2),
        ("c", "lineitem", "insert", "t_items", "l_orderkey,l_linenumber,l_returnflag", 3),
        ("d", "orders", "update", "t_upd", "o_orderkey", 4)],
        "op string, source_table string, source_type string, sink_table string, sink_columns string, seq bigint")


def part_changes(t):
    """Changes of parts: inserts, updates with a null cell, deletes, and new inserts.

    The suppliers among them match no rule.
    """
    def rows(type_, where, data, step):
        return change(t.part.filter(where), "part", type_, data, "1700000000",
                      extra=[F.expr(f"p_partkey * 4 + {step}").alias("seq")])
    return reduce(lambda a, b: a.unionByName(b), [
        rows("insert", "true", {"p_partkey": "p_partkey", "p_name": "p_name", "p_brand": "p_brand", "p_size": "p_size"}, 0),
        rows("update", "p_partkey % 3 = 0", {"p_partkey": "p_partkey", "p_name": "null", "p_brand": "concat(p_brand, '-v2')"}, 1),
        rows("delete", "p_partkey % 5 = 0", {"p_partkey": "p_partkey"}, 2),
        rows("insert", "p_partkey % 10 = 0", {"p_partkey": "p_partkey", "p_name": "'again'", "p_brand": "null"}, 3),
        change(t.supplier, "supplier", "insert", {"s_suppkey": "s_suppkey"}, "1700000000",
               extra=[F.col("s_suppkey").alias("seq")]),
    ])


def source_changes(t):
    """Inserts and updates of orders, inserts of line items, under their own names."""
    orders = {"o_orderkey": "o_orderkey", "o_orderstatus": "o_orderstatus"}
    return (change(t.orders, "orders", "insert", orders, "unix_timestamp(o_orderdate)")
            .unionByName(change(t.orders, "orders", "update", orders, "unix_timestamp(o_orderdate) + 3600"))
            .unionByName(change(t.lineitem, "lineitem", "insert", {
                "l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber", "l_returnflag": "l_returnflag"},
                "unix_timestamp(l_shipdate)")))
