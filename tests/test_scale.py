"""Hot keys and plan shapes: what keeps the operators usable on large data."""
import pytest
from pyspark.sql import functions as F

from brookmart.operators import joins, logs, retract, rules, visits, windows
from brookmart.sinks.topics import latest_per_key

DAY_MS = 86_400_000


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
                "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_rows(spark, n=60_000):
    """A third of the rows belong to one key."""
    return spark.range(n, numPartitions=8).selectExpr(
        "id", "if(id % 3 = 0, 'hot', concat('k', id % 1000)) as mid", "id * 7919 % 400000000 as ts",
        "sha2(cast(id as string), 256) as pad")


def test_hot_key_of_a_fact_join_is_read_in_slices(spark, no_broadcast):
    left = hot_rows(spark)
    right = spark.range(1001).selectExpr("if(id = 1000, 'hot', concat('k', id)) as rid", "'u' as user_id")
    joined = joins.fact_join(left, right, [("mid", "rid")], "left")
    assert joined.filter("user_id = 'u'").count() == 60_000
    frame = joined.select("id", "pad", "user_id")
    frame.collect()
    assert "skew=true" in plan_of(frame)


def test_hot_visitor_is_repaired_in_slices(spark, no_broadcast):
    rows = hot_rows(spark).selectExpr("map('mid', mid, 'is_new', cast(id % 2 as string), 'pad', pad) as common",
                                      "ts % 86400000 as ts")
    fixed = logs.fix_is_new(rows)
    fixed.collect()
    assert "skew=true" in plan_of(fixed)
    first = rows.groupBy("common.mid").agg(F.min(F.struct("ts", F.when(F.col("common")["is_new"] == "1", 0).otherwise(1))).alias("f"))
    want = (rows.join(first.select(F.col("mid").alias("m"), F.col("f.col2").alias("old")), F.col("common")["mid"] == F.col("m"))
            .filter("common['is_new'] = '1' and old = 0").count())
    assert fixed.filter("common['is_new'] = '1'").count() == want and fixed.count() == 60_000


def test_no_plan_broadcasts_by_hint(spark, no_broadcast):
    left, dim = hot_rows(spark, 100), hot_rows(spark, 100).select(F.col("mid").alias("c"), F.col("pad").alias("n"))
    looked_up = joins.lookup_left(left, dim.distinct(), "mid", "c", {"n": "name"})
    assert "BroadcastHashJoin" not in plan_of(looked_up)


def test_hot_visitor_is_ranked_in_pieces(spark):
    out = visits.first_of_day(hot_rows(spark).select("mid", "ts"), ["mid"], flag="uv")
    want = hot_rows(spark).selectExpr("mid", "date(timestamp_millis(ts)) d").distinct().count()
    assert out.filter("uv = 1").count() == want and out.count() == 60_000
    firsts = out.filter("uv = 1").groupBy("mid", F.timestamp_millis("ts").cast("date").alias("d")).count()
    assert firsts.filter("count <> 1").count() == 0
    minimum = hot_rows(spark).filter("mid = 'hot'").agg(F.min("ts")).first()[0]
    assert out.filter(f"mid = 'hot' and ts = {minimum} and uv = 1").count() == 1


def test_visitor_windows_shuffle_only_partial_sums(spark):
    pages = hot_rows(spark).selectExpr("mid", "ts", "'v' vc", "'c' ch", "'a' ar", "'1' is_new", "'home' page_id",
                                       "cast(null as string) last_page_id", "1L during_time")
    for window in (windows.traffic_window, windows.home_detail_window):
        plan = plan_of(window(pages))
        assert "Window" not in plan and "Join" not in plan
        assert plan.count("hashpartitioning") == 2 and "partial_" in plan
    daily = windows.traffic_window(pages).agg(F.sum("uv_ct"), F.sum("pv_ct")).first()
    assert tuple(daily) == (hot_rows(spark).selectExpr("mid", "date(timestamp_millis(ts)) d").distinct().count(), 60_000)


def test_latest_of_a_hot_key_is_combined_before_the_shuffle(spark):
    newest = latest_per_key(hot_rows(spark), "mid", "id")
    assert "partial_max_by" in plan_of(newest)
    assert newest.filter("mid = 'hot'").first()["id"] == 59_997


def test_retraction_of_a_hot_key_equals_a_window(spark):
    rows = hot_rows(spark, 9000).selectExpr("mid as id", "mid as sku_id", "ts", "id as v", "cast(id as decimal(20,4)) as amount")
    out = retract.retract_updates(rows, "id", "v", ["amount"])
    last = rows.groupBy("id").agg(F.max_by("amount", "v").alias("want"))
    bad = out.groupBy("id").agg(F.sum("amount").alias("got")).join(last, "id").filter("got <> want")
    assert out.count() == 2 * 9000 - last.count() and bad.count() == 0
    assert "Window" not in plan_of(out)


def test_cells_of_a_hot_row_are_combined(spark):
    changes = hot_rows(spark, 9000).selectExpr("'d' sink_table", "mid row_key", "'update' type", "map('a', cast(id as string)) data", "id seq")
    merged = rules.merge_cells(changes)
    assert merged.filter("row_key = 'hot'").first()["data"] == {"a": "8997"} and "Window" not in plan_of(merged)


def test_log_text_is_parsed_once_per_pass(spark):
    text = spark.createDataFrame([("{}",)], "value string")
    clean, _ = logs.split_dirty(logs.parse_log(text))
    assert plan_of(logs.split_log(clean)["page"]).count("from_json") == 1


def test_branches_reach_the_scan(spark, tmp_path):
    from brookmart.operators.cdc import branch
    path = str(tmp_path / "ods")
    spark.sql("select 'shop' database, 't' table, 'insert' type, map('id', '1') data, "
              "cast(null as map<string,string>) old, 1L ts").write.parquet(path)
    plan = plan_of(branch(spark.read.parquet(path), "t", "insert", ["id"]))
    assert "EqualTo(table,t)" in plan and "EqualTo(type,insert)" in plan and "old" not in plan.split("ReadSchema")[1]


def test_hot_visitor_of_a_stream_is_spread_over_tasks(spark, no_broadcast, tmp_path):
    """A visitor with a third of a batch: one row of it is stored, its rows are joined in slices, days are ranked in pieces."""
    from brookmart.streaming import visitors
    rows = hot_rows(spark).selectExpr("map('mid', mid, 'is_new', cast(id % 2 as string), 'pad', pad) as common", "ts % 86400000 as ts")
    results = visitors.fix_is_new_deltas(str(tmp_path / "v"))
    for batch_id in (0, 1):
        fixed = results(rows, batch_id)
        where = fixed.select(F.col("common")["mid"].alias("mid"), F.spark_partition_id().alias("p"))
        assert where.filter("mid = 'hot'").select("p").distinct().count() > 2
        assert sorted(map(repr, fixed.collect())) == sorted(map(repr, logs.fix_is_new(rows).select(*fixed.columns).collect()))
    stored = spark.read.parquet(str(tmp_path / "v/tail/batch=0"))
    assert stored.count() == 1001 and stored.filter("_visitor = 'hot'").count() == 1
    first = visitors.first_of_day_deltas(str(tmp_path / "d"), ["mid"], flag="uv")
    plain = hot_rows(spark).select("mid", F.expr("ts % 86400000 as ts"))
    assert first(plain, 0).agg(F.sum("uv")).first()[0] == plain.select("mid").distinct().count()
    assert first(plain, 1).agg(F.sum("uv")).first()[0] == 0
    assert first(plain, 0).agg(F.sum("uv")).first()[0] == plain.select("mid").distinct().count()  # run again
