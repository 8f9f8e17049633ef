"""Hand-made rows for each rule of the operators; answers computed by hand."""
from decimal import Decimal

from helpers import DAY_MS, changes, log, rows_of, texts
from pyspark.sql import functions as F

from brookmart.functions.names import to_camel, to_snake_json
from brookmart.functions.text import split_keyword
from brookmart.operators import cdc, joins, logs, retract, rules, visits, windows
from brookmart.plans import traffic
from brookmart.sources.tables import literal_rows


def marks(spark, records):
    clean = traffic.cleaned_log(texts(spark, records))
    return [r[0] for r in clean.orderBy("ts").select(F.col("common")["is_new"]).collect()]


def test_is_new_same_day(spark):
    assert marks(spark, [log(ts=1), log(ts=2)]) == ["1", "1"]


def test_is_new_next_day(spark):
    assert marks(spark, [log(ts=1), log(ts=DAY_MS + 1)]) == ["1", "0"]


def test_is_new_after_old_visitor(spark):
    assert marks(spark, [log(ts=1, is_new="0"), log(ts=2)]) == ["0", "0"]


def test_is_new_missing_mark_is_left_alone(spark):
    assert marks(spark, [log(ts=1, is_new=None), log(ts=2)]) == [None, "0"]


def flags(spark, rows, keys):
    df = spark.createDataFrame(rows, "mid string, page_id string, ts bigint")
    out = visits.first_of_day(df, keys, flag="uv").orderBy("ts").collect()
    return [(r["page_id"], r["uv"]) for r in out]


def test_first_of_day(spark):
    rows = [("a", "home", 1), ("a", "home", 2), ("a", "home", DAY_MS), ("a", "home", DAY_MS + 1)]
    assert [f for _, f in flags(spark, rows, ["mid"])] == [1, 0, 1, 0]


def test_first_of_day_by_page(spark):
    rows = [("a", "home", 1), ("a", "good_detail", 2), ("a", "home", 3), ("a", "home", DAY_MS), ("a", "home", DAY_MS + 1)]
    assert flags(spark, rows, ["mid", "page_id"]) == [
        ("home", 1), ("good_detail", 1), ("home", 0), ("home", 1), ("home", 0)]


def test_first_of_day_flags_one_of_many_copies(spark):
    df = spark.range(1000, numPartitions=8).selectExpr("'a' as mid", "'home' as page_id", "5L as ts")
    assert visits.first_of_day(df, ["mid"], flag="uv").agg(F.sum("uv")).first()[0] == 1


def test_home_detail_window_keeps_windows_without_first_visits(spark):
    records = [log(ts=1), log(ts=2, page="good_detail"), log(ts=15_000), log(ts=3, page="payment")]
    out = traffic.home_detail_window(logs.split_log(traffic.cleaned_log(texts(spark, records)))["page"])
    assert rows_of(out, "stt", "home_uv_ct", "good_detail_uv_ct") == [
        ("1970-01-01 00:00:00", 1, 1), ("1970-01-01 00:00:10", 0, 0)]


def test_traffic_window(spark):
    records = [log(ts=1, during="7"), log(ts=2, last="home"), log(ts=3, last="null", during=None),
               log(mid="b", ts=9_999, last="x"), log(ts=10_000, last="x")]
    out = traffic.traffic_window(logs.split_log(traffic.cleaned_log(texts(spark, records)))["page"])
    assert rows_of(out, "stt", "edt", "cur_date", "uv_ct", "sv_ct", "pv_ct", "dur_sum") == [
        ("1970-01-01 00:00:00", "1970-01-01 00:00:10", "1970-01-01", 2, 2, 4, 17),
        ("1970-01-01 00:00:10", "1970-01-01 00:00:20", "1970-01-01", 0, 0, 1, 5)]


AMOUNTS = {"a": "amount", "b": "extra"}


def versions(spark, rows):
    df = spark.createDataFrame(rows, "id string, sku_id string, a string, b string, ts bigint, v int")
    return retract.to_amounts(df, AMOUNTS)


def test_retraction(spark):
    df = versions(spark, [("1", "s", "10", None, 1, 1), ("1", "s", "12", None, 2, 2), ("1", "s", "15", None, 3, 3)])
    out = retract.retract_updates(df, "id", "v", ["amount", "extra"])
    assert rows_of(out.select(F.col("amount").cast("int").alias("amount"), "ts"), "amount", "ts") == sorted(
        [(10, 1), (-10, 1), (12, 2), (-12, 2), (15, 3)], key=repr)
    net = windows.sku_window(df, "id", "v", ["amount", "extra"])
    assert rows_of(net, "sku_id", "amount", "extra") == [("s", Decimal("15.0000"), Decimal("0.0000"))]


def test_replaced_rows_leave_an_empty_window(spark):
    df = versions(spark, [("1", "s", "10", "1", 1, 1), ("1", "s", "12", "2", 25, 2)])
    net = windows.sku_window(df, "id", "v", ["amount", "extra"])
    assert [(r["stt"][-2:], int(r["amount"]), int(r["extra"])) for r in net.orderBy("stt").collect()] == [
        ("00", 0, 0), ("20", 12, 2)]


def test_log_outputs(spark):
    records = [log(start={"a": 1}, err={"code": 5}), log(ts=2, actions=[{"id": 9}], displays=[{"pos": 1}, {"pos": 2}]),
               "{bad", "{}", None, log(mid=None), '{"common":{"mid":"z"}}']
    parts = traffic.split_logs(texts(spark, records))
    assert rows_of(parts["err"], "err") == [('{"code":5}',)]
    assert rows_of(parts["start"], "start") == [('{"a":1}',)]
    assert parts["page"].count() == 1
    assert rows_of(parts["display"], "display") == [('{"pos":1}',), ('{"pos":2}',)]
    assert "display" not in parts["action"].columns and rows_of(parts["action"], "action") == [('{"id":9}',)]
    assert parts["dirty"].count() == 4


def test_log_records_one_pass(spark):
    records = [log(start={"a": 1}, err={"code": 5}, ts=7), log(ts=2, actions=[{"id": 9}], displays=[{"pos": 1}], last="x")]
    out = {(r["topic"], r["value"]) for r in logs.log_records(traffic.cleaned_log(texts(spark, records))).collect()}
    common = '"common":{"mid":"a","vc":"v1","ch":"c1","ar":"1","sid":"s","is_new":"1"}'
    page = '"page":{"page_id":"home","during_time":"5","last_page_id":"x"}'
    assert out == {
        ("dwd_err", '{"code":5}'), ("dwd_start", '{' + common + ',"start":{"a":1},"ts":7}'),
        ("dwd_page", '{' + common + ',' + page + ',"ts":2}'),
        ("dwd_display", '{' + common + ',' + page + ',"ts":2,"display":{"pos":1}}'),
        ("dwd_action", '{' + common + ',' + page + ',"ts":2,"action":{"id":9}}')}


def test_cart(spark):
    ods = changes(spark, [
        ("cart_info", "insert", {"id": "1", "sku_num": "4"}, None, 1),
        ("cart_info", "update", {"id": "2", "sku_num": "5"}, {"sku_num": "3"}, 1),
        ("cart_info", "update", {"id": "3", "sku_num": "2"}, {"sku_num": "3"}, 1),
        ("cart_info", "update", {"id": "4", "sku_num": "2"}, {"other": "3"}, 1),
        ("cart_info", "delete", {"id": "5", "sku_num": "2"}, None, 1)])
    assert rows_of(cdc.cart_add(ods), "id", "sku_num") == [("1", "4"), ("2", "2")]


def test_status_transition_needs_a_change(spark):
    ods = changes(spark, [
        ("t", "update", {"id": "1", "s": "1003"}, {"s": "1001"}, 1),
        ("t", "update", {"id": "2", "s": "1003"}, {"s": "1002"}, 1),
        ("t", "update", {"id": "3", "s": "1003"}, {"x": "1"}, 1)])
    assert rows_of(cdc.branch(ods, "t", "update", ["id"], where=cdc.changed_to("s", "1003")), "id") == [("1",), ("2",)]
    assert rows_of(cdc.branch(ods, "t", "update", ["id"], where=cdc.changed_to("s", "1003", "1001")), "id") == [("1",)]


def test_valid_changes(spark):
    ods = changes(spark, [("t", "insert", {"a": "1"}, None, 1), ("t", "insert", {}, None, 1),
                          ("t", "insert", None, None, 1), ("t", "query", {"a": "1"}, None, 1)])
    assert cdc.valid_changes(ods, "shop").count() == 1 and cdc.valid_changes(ods, "other").count() == 0


def test_interval_edges(spark):
    base = 1_700_000_000
    left = spark.createDataFrame([("o", base - 1800), ("o", base - 1801), ("o", base + 5), ("o", base + 6), ("p", base)],
                                 "order_id string, s bigint").withColumn("et", F.timestamp_seconds("s"))
    right = spark.createDataFrame([("o", base)], "pay string, p bigint").withColumn("pay_et", F.timestamp_seconds("p"))
    out = joins.interval_join(left, right, [("order_id", "pay")], -1800, 5, "et", "pay_et")
    assert sorted(r["s"] - base for r in out.collect()) == [-1800, 5]


def test_interval_join_equals_brute_force(spark):
    left = spark.range(3000).selectExpr("id", "cast(id % 3 as string) k", "timestamp_seconds(id * 37 % 20000) et")
    right = spark.range(300).selectExpr("id rid", "cast(id % 3 as string) rk", "timestamp_seconds(id * 71 % 20000) ret")
    got = joins.interval_join(left, right, [("k", "rk")], -600, 9, "et", "ret").select("id", "rid")
    want = left.join(right, F.expr("k = rk and et >= ret - interval 600 seconds and et <= ret + interval 9 seconds"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select("id", "rid").collect()))


def test_lookups(spark):
    rows = spark.createDataFrame([("1",), ("9",), (None,)], "code string")
    dim = literal_rows(spark, [("1", {"dic_name": "one"})], "dic_code string, info struct<dic_name: string>")
    assert rows_of(joins.lookup_inner(rows, dim, "code", "dic_code", {"info.dic_name": "n"}), "code", "n") == [("1", "one")]
    assert joins.lookup_left(rows, dim, "code", "dic_code", {"info.dic_name": "n"}).filter("n is null").count() == 2


RULE = "op string, source_table string, source_type string, sink_table string, sink_columns string, seq bigint"


def test_rule_delete_uses_the_full_key(spark):
    rule_log = literal_rows(spark, [("c", "t", "insert", "x", "a", 1), ("c", "t", "update", "y", "a", 2),
                                    ("d", "t", "insert", "x", "a", 3)], RULE)
    in_force = rules.current_rules(rule_log, ["source_table", "source_type"])
    ods = changes(spark, [("t", "insert", {"a": "1"}, None, 1), ("t", "update", {"a": "2"}, None, 1)])
    routed = rules.routed_payload(rules.project_by_rule(rules.match_rules(ods, in_force, ["table", "type"])))
    assert rows_of(routed, "topic", "value") == [("y", '{"type":"update","ts":"1","a":"2"}')]


def test_data_column_named_type_does_not_hide_the_operation(spark):
    rule_log = literal_rows(spark, [("c", "t", "insert", "x", "type,a", 1)], RULE)
    ods = changes(spark, [("t", "insert", {"a": "1", "type": "data"}, None, 1)])
    out = rules.project_by_rule(rules.match_rules(ods, rules.current_rules(rule_log, ["source_table", "source_type"]),
                                                  ["table", "type"])).first()
    assert out["type"] == "insert" and out["data"] == {"type": "data", "a": "1"}


def cells(spark, rows):
    return spark.createDataFrame([("d", "k", type_, data, seq) for seq, (type_, data) in enumerate(rows)],
                                 "sink_table string, row_key string, type string, data map<string,string>, seq int")


def test_dim_merge(spark):
    df = cells(spark, [("insert", {"a": "1", "b": "2"}), ("update", {"a": "3", "b": None})])
    assert rules.merge_cells(df).first()["data"] == {"a": "3", "b": "2"}


def test_dim_delete_does_not_resurrect(spark):
    df = cells(spark, [("insert", {"a": "1", "b": "2"}), ("delete", {"a": "1"}), ("insert", {"a": "5", "b": None})])
    assert rules.merge_cells(df).first()["data"] == {"a": "5"}
    gone = cells(spark, [("insert", {"a": "1"}), ("delete", {"a": "1"})])
    assert rules.merge_cells(gone).count() == 0


def test_names_and_json_rows(spark):
    df = spark.createDataFrame([("a", 1)], "uvCt string, durSum int")
    assert to_snake_json(df).first()[0] == '{"uv_ct":"a","dur_sum":1}'
    assert to_snake_json(df, ["durSum"]).first()[0] == '{"dur_sum":1}'
    assert to_camel(spark.createDataFrame([(1,)], "sku_long_name int")).columns == ["skuLongName"]


def test_split_keyword(spark):
    df = spark.createDataFrame([(1, "Red phone, red CASE"), (2, ""), (3, None)], "id int, item string")
    assert rows_of(split_keyword(df, "item"), "id", "keyword") == [(1, "case"), (1, "phone"), (1, "red")]
    plugged = split_keyword(df, "item", segmenter=lambda text: text.split(" "))
    assert rows_of(plugged.filter("id = 1"), "keyword") == [("CASE",), ("Red",), ("phone,",), ("red",)]


def test_tombstones(spark):
    assert cdc.drop_tombstones(texts(spark, ["a", None])).count() == 1
