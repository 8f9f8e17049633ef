"""Keyed stores, delta joins, delta sums and live dimensions over many batches."""
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from brookmart.plans import trade
from brookmart.sinks.store import KeyedTable, Store, finished
from brookmart.sinks.tables import apply_rule_views
from brookmart.sinks.topics import read_upsert
from brookmart.streaming import jobs
from brookmart.streaming.deltas import DeltaJoin, DeltaSums
from helpers import CDC, changes, rows_of


def order_rows(n=12):
    """Row changes of orders with items, some with activities and coupons, in any order."""
    rows = []
    for i in range(n):
        rows.append(("order_info", "insert", {"id": str(i), "user_id": f"u{i}", "province_id": "7"}, None, i))
        for j in range(i % 3 + 1):
            item = f"{i}-{j}"
            rows.append(("order_detail", "insert", {"id": item, "order_id": str(i), "sku_id": "s", "create_time": "2024-01-02 03:04:05",
                                                    "sku_num": "2", "order_price": "1.5"}, None, i))
            if j != 1:
                rows.append(("order_detail_activity", "insert", {"order_detail_id": item, "activity_id": "a", "activity_rule_id": "r"}, None, 0))
            if j == 0:
                rows.append(("order_detail_coupon", "insert", {"order_detail_id": item, "coupon_id": "c"}, None, 0))
    rows += [("order_detail", "insert", {"id": "x", "order_id": "none"}, None, 1), ("order_detail", "insert", {"order_id": "1"}, None, 1)]
    return rows


def test_an_item_appears_at_once_and_is_corrected_later(spark, tmp_path):
    results = trade.order_detail_deltas(str(tmp_path / "d"))
    detail = ("order_detail", "insert", {"id": "1", "order_id": "9", "create_time": "2024-01-02 03:04:05"}, None, 5)
    order = ("order_info", "insert", {"id": "9", "user_id": "u", "province_id": "p"}, None, 5)
    coupon = ("order_detail_coupon", "insert", {"order_detail_id": "1", "coupon_id": "c"}, None, 1)
    seen = lambda rows, n: rows_of(results(changes(spark, rows), n), "id", "user_id", "coupon_id")
    assert seen([detail, order], 0) == [("1", "u", None)]
    assert seen([("order_info", "insert", {"id": "8", "user_id": "v", "province_id": "p"}, None, 6)], 1) == []
    assert seen([coupon], 2) == [("1", "u", "c")]
    assert seen([coupon], 2) == [("1", "u", "c")]  # the batch is run again
    assert seen([("order_detail_activity", "insert", {"order_detail_id": "1", "activity_id": "a"}, None, 1)], 3) == [("1", "u", "c")]


@pytest.mark.parametrize("fold_every", [3, 100])
def test_order_details_over_many_batches(spark, tmp_path, fold_every):
    rows = order_rows()
    random.Random(fold_every).shuffle(rows)
    results, out = trade.order_detail_deltas(str(tmp_path / "d"), buckets=4, fold_every=fold_every), str(tmp_path / "out")
    for n in range(8):
        batch = changes(spark, rows[n::8])
        for _ in range(2 if n in (3, 6) else 1):  # some batches are run again, one after a fold
            jobs.upsert_to(out)(results(batch, n), n)
    got = read_upsert(spark, out, ["id"])
    want = trade.order_detail(changes(spark, rows)).where("id is not null")
    assert rows_of(got, *want.columns) == rows_of(want, *want.columns)


def test_refund_payments_keep_no_state(spark, tmp_path):
    """Three sides that come in batches far apart; the stream has no state operator."""
    paid = lambda i: ("refund_payment", "update", {"id": str(i), "order_id": str(i), "sku_id": "s", "refund_status": "1602", "total_amount": "1"},
                      {"refund_status": "1601"}, i)
    asked = lambda i: ("order_refund_info", "update", {"order_id": str(i), "sku_id": "s", "refund_num": "1", "refund_status": "0705"},
                       {"refund_status": "0702"}, i)
    order = lambda i: ("order_info", "update", {"id": str(i), "user_id": "u", "province_id": "p", "order_status": "1006"},
                       {"order_status": "1005"}, i)
    rows = [f(i) for f in (paid, asked, order) for i in range(20)]
    source, results, out = str(tmp_path / "in"), trade.refunds_paid_deltas(str(tmp_path / "d"), buckets=2, fold_every=4), str(tmp_path / "out")
    for n in range(12):
        changes(spark, rows[n * 5:n * 5 + 5]).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(CDC + ", et timestamp").option("maxFilesPerTrigger", 1).parquet(source)
    query = jobs.run_stream(stream, lambda batch, n: jobs.rows_to(out)(results(batch, n), n), str(tmp_path / "checkpoint"), drain=True)
    query.awaitTermination()
    assert len(query.recentProgress) >= 12 and not any(p["stateOperators"] for p in query.recentProgress)
    got = spark.read.parquet(out)
    assert rows_of(got, "id", "refund_num", "user_id") == rows_of(trade.refunds_paid(changes(spark, rows)), "id", "refund_num", "user_id")
    assert got.count() == 20


def test_delta_join_finds_every_pair_once(spark, tmp_path):
    """A key with many rows on both sides, and keys without a partner."""
    r = random.Random(1)
    left = [(f"k{r.choice([0, 0, 1, 2, 3])}", i) for i in range(60)]
    right = [(f"k{r.choice([0, 0, 1, 2, 9])}", i) for i in range(60)]
    join = lambda sides: sides["a"].join(sides["b"], F.col("ka") == F.col("kb"))
    pairs = []
    for n in range(5):
        sides = {"a": spark.createDataFrame(left[n::5], "ka string, x int"), "b": spark.createDataFrame(right[n::5], "kb string, y int")}
        delta = DeltaJoin(str(tmp_path / "j"), sides, {"a": {"k": "ka"}, "b": {"k": "kb"}}, join, buckets=3, fold_every=2)
        pairs += rows_of(delta.results(sides, n), "x", "y")
    assert sorted(pairs) == sorted((x, y) for k, x in left for m, y in right if k == m)


def test_store_reads_one_base_and_what_came_after(spark, tmp_path):
    store = Store(str(tmp_path / "s"), "k string, v int", ["k"], buckets=4)
    df = lambda *rows: spark.createDataFrame(rows, "k string, v int")
    assert store.read(spark).count() == 0 and finished(spark, str(tmp_path / "none"), "upto") == []
    for n in range(5):
        store.append(df(("a", n), (f"b{n}", n), (None, n)), n)
    store.fold(spark, 1)
    store.fold(spark, 3, lambda rows: rows.where("v > 1"))
    assert finished(spark, f"{store.path}/base", "upto") == [1, 3]
    assert finished(spark, f"{store.path}/tail", "batch") == [2, 3, 4]
    assert rows_of(store.read(spark), "k", "v") == sorted([(k, n) for n in (2, 3, 4) for k in ("a", f"b{n}", None)], key=repr)
    # Batch 3 is run again after the fold: it reads what it read before.
    assert rows_of(store.around(spark, 3), "k", "v") == sorted([("a", n) for n in range(4)] + [("b3", 3)] + [("", n) for n in ()] + [(None, n) for n in range(4)], key=repr)
    store.append(df(), 5)
    assert store.around(spark, 5).count() == 0


def test_scan_of_a_batch_is_pruned(spark, tmp_path):
    store = Store(str(tmp_path / "s"), "k string, v int", ["k"], buckets=8)
    store.append(spark.range(5000).selectExpr("cast(id as string) as k", "1 as v"), 0)
    store.fold(spark, 0)
    store.append(spark.createDataFrame([("17", 2)], "k string, v int"), 1)
    near = store.around(spark, 1)
    assert rows_of(near, "k", "v") == [("17", 1), ("17", 2)]
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = store.around(spark, 1)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(place", plan) and re.search(r"PushedFilters: .*(In|EqualTo)\(bucket", plan)


@pytest.mark.parametrize("fold_every", [2, 50])
def test_delta_sums_follow_the_newest_version(spark, tmp_path, fold_every):
    r = random.Random(fold_every)
    schema = "id string, v int, w string, sku string, amount decimal(38,4)"
    rows = [(r.choice(["hot", *map(str, range(12)), None]), n, r.choice("pq"), r.choice("xyz"), Decimal(r.randint(1, 99))) for n in range(150)]
    r.shuffle(rows)
    current = {}
    for n in range(6):
        part = rows[n * 25:n * 25 + 25]
        df = spark.createDataFrame(part, schema).repartition(3)
        sums = DeltaSums(str(tmp_path / "d"), df.schema, "id", "v", ["w", "sku"], ["amount"], buckets=3, fold_every=fold_every)
        for _ in range(2 if n in (2, 4) else 1):
            found = {(x["w"], x["sku"]): x["amount"] for x in sums.results(df, n).collect()}
        assert {(p[2], p[3]) for p in part} <= set(found)
        current |= found
        newest = {}
        for row in rows[:n * 25 + 25]:
            newest[row[0]] = max(newest.get(row[0], row), row, key=lambda x: x[1])
        want = {(p[2], p[3]): Decimal(0) for p in rows[:n * 25 + 25]}
        for _, _, w, sku, amount in newest.values():
            want[w, sku] += amount
        assert current == want


RULE = "op string, source_table string, sink_table string, sink_columns string, sink_family string, sink_row_key string, seq bigint"
PART = CDC.replace("`table`", "table") + ", seq bigint"


def test_views_of_rules_follow_the_rows(spark, tmp_path):
    known = [("c", "part", "dim_part", "id,name", "info", "id", 1)]
    path = str(tmp_path / "dims")
    rules = lambda: spark.createDataFrame(known, RULE)
    views = jobs.rule_views_to(path, "live_dims")
    views(rules(), 0)  # a rule before the first row
    shown = lambda *columns: rows_of(spark.table("live_dims.dim_part"), "row_key", *columns)
    assert shown("id", "name") == []
    assert jobs.read_dims(spark, path, rules()).count() == 0
    write = jobs.dims_to(rules, path, "shop", buckets=2, fold_every=2)
    rows = lambda *r: spark.createDataFrame([("shop", "part", t, d, None, 1, s) for t, d, s in r], PART)
    write(rows(("insert", {"id": "1", "name": "a", "size": "9"}, 1), ("insert", {"id": "2", "name": "it's \\ \"b\""}, 2)), 0)
    assert shown("id", "name") == [("1", "1", "a"), ("2", "2", "it's \\ \"b\"")]  # no rule has changed
    write(rows(("update", {"id": "1", "name": "c"}, 3), ("delete", {"id": "2"}, 4)), 1)
    assert shown("id", "name") == [("1", "1", "c")]
    views(spark.createDataFrame([("u", "part", "dim_part", "id,size", "info", "id", 2)], RULE), 1)
    assert shown("id", "size") == [("1", "1", "9")]
    write(rows(("insert", {"id": "2", "size": "4"}, 1)), 2)  # folds the batches before it
    write(rows(("insert", {"id": "2", "size": "4"}, 1)), 2)  # and is run again
    write(rows(("insert", {"id": "3"}, 1)), 3)
    assert finished(spark, f"{path}/base", "upto") == [-1, 1]
    assert shown("id", "size") == [("1", "1", "9"), ("2", "2", "4"), ("3", "3", None)]
    known.append(("u", "part", "dim_part", "id,size", "info", "id", 2))
    merged = {r["row_key"]: r["data"] for r in jobs.read_dims(spark, path, rules()).collect()}
    assert merged == {"1": {"id": "1", "size": "9"}, "2": {"id": "2", "size": "4"}, "3": {"id": "3"}}  # the name of 2 went with its delete
    views(spark.createDataFrame([("d", "part", "dim_part", "id", "info", "id", 3)], RULE), 2)
    assert not spark.catalog.tableExists("live_dims.dim_part")


def test_a_rule_table_before_the_first_change_is_empty(spark, tmp_path):
    rule = spark.createDataFrame([("c", "part", "dim_part", "id,name", "info", "id", 1)], RULE)
    jobs.rule_tables_to(str(tmp_path / "none"), "early_dims")(rule, 0)
    assert spark.table("early_dims.dim_part").columns == ["row_key", "id", "name"] and spark.table("early_dims.dim_part").count() == 0


def test_a_view_never_loses_its_rows(spark, tmp_path):
    """Readers between the changes of a rule, and while batches are folded, find all rows."""
    path = str(tmp_path / "dims")
    known = [("c", "part", "dim_part", "id", "info", "id", 1)]
    write = jobs.dims_to(lambda: spark.createDataFrame(known, RULE), path, "shop", buckets=2, fold_every=2)
    for n in range(6):
        write(spark.createDataFrame([("shop", "part", "insert", {"id": str(n)}, None, 1, 1)], PART), n)
        apply_rule_views(spark, spark.createDataFrame([("u", "part", "dim_part", "id", "info", "id", n)], RULE), "steady_dims", path)
        assert spark.table("steady_dims.dim_part").count() == n + 1


@pytest.mark.parametrize("fold_every", [2, 50])
def test_keyed_table_keeps_the_newest_row(spark, tmp_path, fold_every):
    table = KeyedTable(str(tmp_path / "t"), "k string, v int, seq int, _deleted boolean", ["k"], "seq", buckets=3, fold_every=fold_every)
    df = lambda *rows: spark.createDataFrame(rows, "k string, v int, seq int, _deleted boolean")
    r, want = random.Random(9), {}
    for n in range(6):
        rows = [(r.choice("abcdef"), r.randint(0, 99), s, r.random() < 0.2) for s in range(8)]
        for _ in range(2 if n in (2, 5) else 1):
            table.upsert(df(*rows), n)
        for k, v, _, gone in rows:
            want[k] = None if gone else v
    live = sorted((k, v) for k, v in want.items() if v is not None)
    assert rows_of(table.current(spark), "k", "v") == live
    asked = spark.createDataFrame([("a",), ("b",), ("zz",)], "k string")
    assert rows_of(table.among(spark, asked), "k", "v") == [x for x in live if x[0] in "ab"]
    assert table.among(spark, asked.limit(0)).count() == 0
