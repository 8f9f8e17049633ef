"""Streams that are fed piece by piece, and what a delta join reads of older batches."""
import os

from pyspark.sql import functions as F

from brookmart.operators.joins import fact_join
from brookmart.plans import trade
from brookmart.registry import PIECES, Feed
from brookmart.streaming.deltas import DeltaJoin
from helpers import changes, rows_of


def test_a_table_is_written_once_and_comes_in_order(spark, tmp_path):
    folder, feed, seen = str(tmp_path / "t"), Feed(spark), []
    stream = feed.stream(spark.range(100).withColumn("ts", F.col("id")), folder, "ts", {"ts": "_last + 1000"})
    feed.run(stream, lambda batch, n: seen.append(sorted(r.ts for r in batch.select("ts").collect())), folder)
    seen = [s for s in seen if s]
    assert len(seen) == PIECES + 1 and sum(seen, []) == [*range(100), 1099]
    assert not [f for _, _, files in os.walk(f"{folder}/whole") for f in files if f.endswith(".parquet")]


def test_older_rows_are_read_only_for_rows_of_another_side(spark, tmp_path):
    seen = {}

    def join(sides):
        seen.update({name: sorted(r[0] for r in df.select(df.columns[0]).collect()) for name, df in sides.items()})
        return fact_join(sides["a"], sides["b"], [("ka", "kb")])

    def frames(a, b):
        return {"a": spark.createDataFrame([(k,) for k in a], "ka string"), "b": spark.createDataFrame([(k,) for k in b], "kb string")}

    delta = DeltaJoin(str(tmp_path / "j"), frames("", ""), {"a": {"k": "ka"}, "b": {"k": "kb"}}, join, buckets=2)
    assert delta.results(frames("xy", ""), 0).count() == 0
    assert delta.results(frames("x", "y"), 1).count() == 1
    assert seen == {"a": ["x", "y"], "b": ["y"]}  # the older x meets no row of b


def test_payments_come_however_late(spark, tmp_path):
    results = trade.payment_deltas(str(tmp_path / "p"), buckets=2)
    detail = spark.createDataFrame([("d", "1")], "id string, order_id string").withColumn("et", F.timestamp_seconds(F.lit(1000)))
    paid = lambda order, ts: changes(spark, [("payment_info", "update", {"order_id": order, "payment_status": "1602", "payment_type": "1"},
                                              {"payment_status": "1601"}, ts)])
    assert results(detail, paid("2", 9_000_000), 0).count() == 0
    assert rows_of(results(detail.limit(0), paid("1", 2000), 1), "id", "pi_order_id") == [("d", "1")]
    assert results(detail.limit(0), paid("1", 5000), 2).count() == 0  # paid too late
