"""Sinks and sources outside of streams."""
import json

from helpers import rows_of, texts
from pyspark.sql import functions as F

from brookmart.operators.rules import merge_cells
from brookmart.schemas import SKU_ORDER_WINDOW
from brookmart.session import work_folder
from brookmart.sinks import tables, topics
from brookmart.sources import rules as rule_sources
from brookmart.sources.tables import read_dim


def test_routed_batch_is_replaced_on_replay(spark, tmp_path):
    df = spark.createDataFrame([("a", "1"), ("b", "2"), ("a", "3")], "topic string, value string")
    conn = {"format": "text", "path": str(tmp_path)}
    topics.write_routed(df, conn, batch_id=4)
    topics.write_routed(df, conn, batch_id=4)
    assert rows_of(spark.read.text(str(tmp_path)), "topic", "value") == [("a", "1"), ("a", "3"), ("b", "2")]


def test_changelog_latest_deletes_and_compaction(spark, tmp_path):
    schema, log = "id string, v int, _deleted boolean", str(tmp_path / "log")
    topics.write_upsert(spark.createDataFrame([("1", 1, False), ("2", 1, False)], schema), log, 0)
    topics.write_upsert(spark.createDataFrame([("1", 2, False), ("1", 3, False)], schema), log, 1, "v", ["id"])
    topics.write_upsert(spark.createDataFrame([("2", None, True)], schema), log, 2)
    assert rows_of(topics.read_upsert(spark, log, "id"), "id", "v") == [("1", 3)]
    topics.compact(spark, log, "id", str(tmp_path / "new"))
    topics.write_upsert(spark.createDataFrame([("3", 1, False)], schema), str(tmp_path / "new"), 3)
    assert rows_of(topics.read_upsert(spark, str(tmp_path / "new"), "id"), "id", "v") == [("1", 3), ("3", 1)]


def test_keyed_topic_records(spark):
    df = spark.createDataFrame([("1", 5, False), ("2", 6, True)], "id string, v int, _deleted boolean")
    assert rows_of(topics.upsert_records(df, ["id"]), "key", "value") == [
        ('{"id":"1"}', '{"id":"1","v":5}'), ('{"id":"2"}', None)]


def test_json_rows_and_text_topic(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "pvCt int, ts string")
    topics.write_json_rows(df, "t", {"path": str(tmp_path)}, ["pvCt"])
    assert spark.read.text(str(tmp_path / "t")).first()[0] == '{"pv_ct":1}'


def test_jdbc_options_and_column_order(spark):
    options = tables.jdbc_options("t", {"url": "jdbc:x"}, 10)
    assert options == {"dbtable": "t", "batchsize": "10", "url": "jdbc:x"}
    df = spark.range(1).select(*[F.lit("1").alias(c) for c in reversed(SKU_ORDER_WINDOW)], F.lit(1).alias("ts"))
    assert tables.output_columns(df, SKU_ORDER_WINDOW).columns == SKU_ORDER_WINDOW


def test_write_table_replaces_its_batch(spark, tmp_path):
    for _ in range(2):
        tables.write_table(spark.range(3), "t", batch_id=7, path=str(tmp_path))
    assert read_dim(spark, str(tmp_path / "t"), ["id"]).count() == 3


def test_rule_changes_text_and_snapshot(spark, tmp_path):
    rule = {"source_table": "t", "source_type": "insert", "sink_table": "x", "sink_columns": "a"}
    lines = [json.dumps({"op": "c", "before": None, "after": rule, "seq": 1}),
             json.dumps({"op": "d", "before": rule, "after": None, "seq": 2}), None]
    out = rule_sources.read_rule_changes(texts(spark, lines), "dwd")
    assert rows_of(out, "op", "source_table", "sink_table") == [("c", "t", "x"), ("d", "t", "x")]
    spark.createDataFrame([rule]).write.parquet(str(tmp_path / "rules"))
    snapshot = rule_sources.load_rules_snapshot(spark, str(tmp_path / "rules"))
    assert rows_of(snapshot, "op", "source_table", "seq") == [("r", "t", -1)]


def test_rule_ddl_and_refill(spark):
    schema = "op string, source_table string, sink_table string, sink_columns string, seq bigint"
    merged = merge_cells(spark.createDataFrame(
        [("dim_a", "1", "insert", {"id": "1", "name": "x"}, 1)],
        "sink_table string, row_key string, type string, data map<string,string>, seq int"))
    rules = lambda *rows: spark.createDataFrame(list(rows), schema)
    fill = tables.apply_rule_ddl(spark, rules(("c", "a", "dim_a", "id,name", 1), ("r", "b", "dim_b", "id", 2)), "dims")
    assert sorted(fill) == ["dims.dim_a", "dims.dim_b"]
    for rule in fill.values():
        tables.refresh_dim_table(spark, merged, rule, "dims")
    assert rows_of(spark.table("dims.dim_a"), "row_key", "id", "name") == [("1", "1", "x")]
    fill = tables.apply_rule_ddl(spark, rules(("d", "b", "dim_b", "id", 3), ("u", "a", "dim_a", "id,name,size", 4)), "dims")
    assert list(fill) == ["dims.dim_a"] and not spark.catalog.tableExists("dims.dim_b")
    assert spark.table("dims.dim_a").count() == 0
    tables.refresh_dim_table(spark, merged, fill["dims.dim_a"], "dims")
    assert rows_of(spark.table("dims.dim_a"), "row_key", "name", "size") == [("1", "x", None)]


class Conf(dict):
    conf = property(lambda self: self)


def test_work_folder_follows_the_session():
    assert work_folder(Conf({"spark.checkpoint.dir": "/shared/area/"}), "x").startswith("/shared/area/x-")
