"""Nothing is dropped or zeroed without a trace."""
import pytest
from helpers import CDC, texts
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from brookmart.operators import cdc, joins, logs, retract
from brookmart.sinks import topics as sinks
from brookmart.sources import topics


def test_large_amounts_stay_and_bad_ones_fail(spark):
    rows = spark.createDataFrame([("1", "12345678901234567.5"), ("2", None)], "id string, a string")
    out = {r.id: str(r.amount) for r in retract.to_amounts(rows, {"a": "amount"}).collect()}
    assert out == {"1": "12345678901234567.5000", "2": "0.0000"}
    with pytest.raises(PySparkException, match="bad amount"):
        retract.to_amounts(rows.withColumn("a", F.lit("abc")), {"a": "amount"}).collect()


def test_a_version_with_nulls_is_not_negated(spark):
    rows = spark.createDataFrame([(None, 1, 5), ("a", None, 7), ("b", 1, 2), ("b", 2, 3)], "id string, v int, n int")
    out = sorted(r.n for r in retract.retract_updates(rows, "id", "v", ["n"]).collect())
    assert out == [-2, 2, 3, 5, 7]


def test_bad_cart_quantity_fails(spark):
    row = [("shop", "cart_info", "update", {"id": "1", "user_id": "u", "sku_id": "s", "sku_num": "x"}, {"sku_num": "1"}, 1)]
    ods = spark.createDataFrame(row, CDC).withColumn("et", F.timestamp_seconds("ts"))
    with pytest.raises(PySparkException, match="bad quantity"):
        cdc.cart_add(ods).collect()
    assert cdc.cart_add(ods.withColumn("table", F.lit("other"))).count() == 0


def test_malformed_changes_fail(spark):
    lines = texts(spark, ['{"database": "shop", "table": "t", "type": "insert", "ts": 1}', "{bad"])
    with pytest.raises((PySparkException, Py4JError)):
        topics.read_ods_db(lines).collect()
    assert topics.read_ods_db(lines, mode="PERMISSIVE").count() == 2


def test_text_behind_a_record_is_dirty(spark):
    good = '{"common": {"mid": "a"}, "ts": 1}'
    clean, dirty = logs.split_dirty(logs.parse_log(texts(spark, [good, good + " trailing", good + good, f" {good} "])))
    assert clean.count() == 2 and dirty.count() == 2


def test_a_delete_after_compaction_deletes(spark, tmp_path):
    log, compacted = str(tmp_path / "log"), str(tmp_path / "compacted")
    row = lambda i, v, gone: spark.createDataFrame([(i, v, gone)], "id string, v string, _deleted boolean")
    sinks.write_upsert(row("1", "a", False).unionByName(row("2", "b", False)), log, 0)
    sinks.compact(spark, log, ["id"], compacted)
    sinks.write_upsert(row("2", None, True), compacted, 1)
    assert [tuple(r) for r in sinks.read_upsert(spark, compacted, ["id"]).collect()] == [("1", "a")]


def test_interval_of_one_moment(spark):
    left = spark.createDataFrame([(1, 5), (1, 6)], "k int, s long").select("k", F.timestamp_seconds("s").alias("et"))
    right = spark.createDataFrame([(1, 5)], "rk int, s long").select("rk", F.timestamp_seconds("s").alias("right_et"))
    assert joins.interval_join(left, right, [("k", "rk")], 0, 0).count() == 1


def test_outer_stream_join_needs_a_gap(spark, tmp_path):
    side = spark.readStream.format("rate").load()
    left, right = side.select(F.col("value").alias("a"), F.col("timestamp").alias("et")), side.select(F.col("value").alias("b"), F.col("timestamp").alias("bt"))
    with pytest.raises(ValueError, match="gap"):
        joins.fact_join(left, right, [("a", "b")], "left", right_time="bt")
