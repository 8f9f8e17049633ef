"""Replays, repeated deliveries, overlapping snapshots, and topics whose partitions run apart."""
import json
import time

from pyspark.sql import functions as F

from brookmart.functions.timecols import with_event_time
from brookmart.operators.rules import current_rules
from brookmart.sinks import tables
from brookmart.sinks import topics as sinks
from brookmart.sources import rules as rule_sources
from brookmart.sources import topics
from brookmart.streaming import jobs
from helpers import rows_of, write_files


def test_a_catalog_table_has_one_copy_of_a_batch(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS fenced")
    df = lambda *v: spark.createDataFrame([(x, f"n{x}") for x in v], "id int, `a name` string")
    tables.write_table(df(1, 2), "fenced.t", batch_id=0)
    tables.write_table(df(3), "fenced.t", batch_id=1)
    tables.write_table(df(3).select("a name", "id"), "fenced.t", batch_id=1)  # run again, columns in another order
    tables.write_table(df(4, 5), "fenced.t", batch_id=2)
    tables.write_table(df(4), "fenced.t", batch_id=2)
    tables.write_table(df(), "fenced.t", batch_id=3)
    assert rows_of(spark.table("fenced.t"), "id", "a name", "batch_id") == [(1, "n1", 0), (2, "n2", 0), (3, "n3", 1), (4, "n4", 2)]
    tables.write_table(df(9), "fenced.plain")
    tables.write_table(df(9), "fenced.plain")
    assert spark.table("fenced.plain").count() == 2


def test_changes_that_overlap_a_snapshot_are_ignored(spark, tmp_path):
    rule = lambda table, sink: {"source_table": table, "source_type": "insert", "sink_table": sink, "sink_columns": "id"}
    spark.createDataFrame([rule("a", "a_new"), rule("b", "b")]).write.parquet(str(tmp_path / "rules"))  # as it stands at position 4
    texts = [{"op": "c", "after": rule("a", "a_old"), "seq": 1}, {"op": "c", "after": rule("gone", "gone"), "seq": 2},
             {"op": "u", "before": rule("a", "a_old"), "after": rule("a", "a_new"), "seq": 3}, {"op": "d", "before": rule("gone", "gone"), "seq": 4},
             {"op": "u", "before": rule("b", "b"), "after": rule("b", "b_new"), "seq": 5}, {"op": "c", "after": rule("c", "c"), "seq": 6}]
    changes = rule_sources.read_rule_changes(spark.createDataFrame([(json.dumps(t),) for t in texts], "value string"), "dwd")
    snapshot = rule_sources.load_rules_snapshot(spark, str(tmp_path / "rules"))
    for delivered in (changes, changes.where("seq > 2"), changes.where("seq in (1, 2, 5, 6)"), changes.unionByName(changes)):
        fenced = rule_sources.fenced_rules(snapshot, delivered, 4)
        assert rows_of(current_rules(fenced, ["source_table", "source_type"]), "source_table", "sink_table") == [("a", "a_new"), ("b", "b_new"), ("c", "c")]
    assert rows_of(rule_sources.fenced_rules(snapshot, changes, 4), "op", "seq") == [("c", 6), ("r", 4), ("r", 4), ("u", 5)]


def _counts(spark, stream, folder):
    counted = stream.groupBy(F.window("et", "10 seconds")).agg(F.count(F.lit(1)).alias("n"))
    jobs.run_stream(counted, jobs.rows_to(f"{folder}/out"), f"{folder}/checkpoint", drain=True).awaitTermination()
    return {r["window"].start.timestamp(): r["n"] for r in spark.read.parquet(f"{folder}/out").collect()}


def _timed(text, delay=None):
    return with_event_time(text.select(F.col("value").cast("long").alias("ts")), "ts", "s", delay)


def test_partitions_an_hour_apart_lose_no_row(spark, tmp_path):
    """Partition 1 is an hour ahead from the first batch on; the rows of partition 0 still count."""
    source = str(tmp_path / "in")
    for p, begin in ((0, 0), (1, 3600)):
        write_files(f"{source}/partition={p}", [[str(begin + 30 * i + j) for j in range(1, 4)] for i in range(4)] + [["9000"]])
    conn = {"format": "text", "path": source, "maxFilesPerTrigger": 1}
    united = topics.read_partitions(spark, "t", conn, [0, 1], _timed)
    want = {float(begin + 30 * i): 3 for begin in (0, 3600) for i in range(4)}
    assert {t: n for t, n in _counts(spark, united, str(tmp_path / "a")).items() if t < 9000} == want
    # One watermark over both loses rows of the slower partition.
    whole = _timed(topics.read_text_topic(spark, "t", {**conn, "path": f"{source}/*", "maxFilesPerTrigger": 2}), "0 seconds")
    assert sum(n for t, n in _counts(spark, whole, str(tmp_path / "b")).items() if t < 9000) < sum(want.values())


def test_an_idle_partition_waits_or_follows_the_clock(spark, tmp_path):
    source, now = str(tmp_path / "in"), int(time.time()) // 2 * 2
    write_files(f"{source}/partition=0", [[str(now), str(now + 1)], [str(now + 2)], [str(now + 4)]])
    write_files(f"{source}/partition=1", [[]])
    conn = {"format": "text", "path": source}
    idle = lambda text: _timed(text.where("value != ''"))
    assert _counts(spark, topics.read_partitions(spark, "t", conn, [0, 1], idle), str(tmp_path / "a")) == {}  # held back, not lost
    beating = topics.read_partitions(spark, "t", conn, [0, 1], idle, idle_after="40 seconds")
    counted = beating.groupBy(F.window("et", "2 seconds")).agg(F.count(F.lit(1)).alias("n"))
    query = jobs.run_stream(counted, jobs.rows_to(str(tmp_path / "out")), str(tmp_path / "cp"), every="1 second")
    rows = lambda: sorted(r["n"] for r in spark.read.schema("n long").parquet(str(tmp_path / "out")).collect())
    try:
        for _ in range(100):
            query.awaitTermination(1)
            if (tmp_path / "out").exists() and len(rows()) >= 3:
                break
        assert rows() == [1, 1, 2]
    finally:
        query.stop()


def test_a_doubled_batch_counts_once(spark, tmp_path):
    """A topic that holds a batch twice, once in another order; equal records of a batch are records each."""
    conn = {"format": "parquet", "path": str(tmp_path / "topic")}
    batch = lambda *v: spark.createDataFrame([(x,) for x in v], "value string")
    first = ("5", "5", "7")
    sinks.write_text_topic(sinks.with_record_ids(batch(*first), 0), "t", conn)
    sinks.write_text_topic(sinks.with_record_ids(batch(*reversed(first)).repartition(3), 0), "t", conn)
    sinks.write_text_topic(sinks.with_record_ids(batch("5", "9"), 1), "t", conn)
    text = topics.read_text_topic(spark, "t", {**conn, "path": f"{conn['path']}/t", "maxFilesPerTrigger": 1}, keyed=True)
    timed = text.withColumn("et", F.timestamp_seconds(F.col("value").cast("long")))
    kept = topics.once(timed, "10 minutes").select("key", "value")
    jobs.run_stream(kept, jobs.rows_to(str(tmp_path / "out")), str(tmp_path / "cp"), drain=True).awaitTermination()
    assert rows_of(spark.read.parquet(str(tmp_path / "out")), "value") == [("5",), ("5",), ("5",), ("7",), ("9",)]
