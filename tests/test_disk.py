"""What streams leave on disk while they run, and how little of what is stored a batch shuffles."""
import os

import pytest
from pyspark.sql import functions as F

from brookmart import registry
from brookmart.functions.text import split_keyword
from brookmart.functions.timecols import with_event_time
from brookmart.operators import windows
from brookmart.operators.joins import SKU_CHAIN, enrich_snowflake, fact_join
from brookmart.plans import sku
from brookmart.schemas import KEYWORD_WINDOW, SKU_ORDER_WINDOW
from brookmart.sinks import store
from brookmart.streaming.closing import ClosedWindows
from brookmart.streaming.deltas import DeltaJoin
from brookmart.streaming.jobs import rows_to, run_stream
from helpers import rows_of


def shuffle_files(spark):
    manager = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def parquet_files(folder):
    return [f for _, _, files in os.walk(folder) for f in files if f.endswith(".parquet")]


def test_shuffles_of_a_stream_and_the_pieces_it_read_are_gone(spark, tmp_path):
    folder, feed, held, sizes = str(tmp_path / "t"), registry.Feed(spark), shuffle_files(spark), []

    def write(batch, batch_id):
        batch.groupBy((F.col("id") % 7).alias("k")).count().write.parquet(f"{folder}/out/batch_id={batch_id}")
        sizes.append(len(parquet_files(f"{folder}/in")) > 0)

    halves = [spark.range(50).repartition(3, "id"), spark.range(50, 100).repartition(3, "id")]
    feed.run(feed.stream(halves, folder, ["id"]), write, folder)
    assert shuffle_files(spark) <= held
    assert all(sizes) and len(sizes) == registry.PIECES
    assert not parquet_files(f"{folder}/in") and not parquet_files(f"{folder}/whole")
    assert spark.read.parquet(f"{folder}/out").agg(F.sum("count")).first()[0] == 100
    assert spark.conf.get("spark.sql.parquet.compression.codec") == "snappy"


def test_stream_settings_end_with_the_batch(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "in"))
    seen, key = [], "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    stream = spark.readStream.schema("id bigint").parquet(str(tmp_path / "in"))
    run_stream(stream, lambda batch, n: seen.append(batch.sparkSession.conf.get(key)), str(tmp_path / "c"), drain=True).awaitTermination()
    assert seen == ["true"] and spark.conf.get(key) == "false"


def test_filter_keeps_all_keys_and_few_others(spark):
    rows = spark.range(200_000).select(F.concat(F.lit("k"), "id").alias("place"), F.col("id").alias("v"))
    keys = rows.where("v % 10 = 3").select("place")
    kept = store.may_be_of(rows, "place", keys, 20_000)
    assert kept.columns == rows.columns
    assert kept.where("v % 10 = 3").count() == 20_000
    assert kept.count() < 20_000 + 180_000 * 0.1
    assert store.may_be_of(rows, "place", keys.limit(0), 0).count() == 0


@pytest.mark.parametrize("many", [1, 10_000])
def test_delta_join_with_many_keys_in_a_batch(spark, tmp_path, monkeypatch, many):
    monkeypatch.setattr(store, "MANY_KEYS", many)
    left = [("a", 1), ("a", 1), ("b", 2), (None, 3), ("c", 4)]
    right = [("a", "x"), ("c", "y"), ("d", "z"), (None, "n"), ("a", "w")]
    frame = lambda rows, names: spark.createDataFrame(rows, names)
    a, b = "ka string, v int", "kb string, w string"
    delta = DeltaJoin(str(tmp_path / "j"), {"a": frame([], a), "b": frame([], b)}, {"a": {"k": "ka"}, "b": {"k": "kb"}},
                      lambda sides: fact_join(sides["a"], sides["b"], [("ka", "kb")], "left"), buckets=2)
    batches = [(left[:3], []), ([], right[:3]), (left[3:], right[3:]), ([], [])]
    found = {}
    for n, (x, y) in enumerate(batches):
        for r in delta.results({"a": frame(x, a), "b": frame(y, b)}, n).collect():
            found.setdefault(n, []).append(tuple(r))
    order = lambda rows: sorted(rows, key=repr)
    assert order(found[0]) == order([("a", 1, None, None)] * 2 + [("b", 2, None, None)])
    assert order(found[1]) == order([("a", 1, "a", "x")] * 2)
    assert order(found[2]) == order([(None, 3, None, None), ("c", 4, "c", "y")] + [("a", 1, "a", "w")] * 2)
    assert 3 not in found


def test_slices_hold_every_order_once_with_its_items(spark, tmp_path):
    orders = [(k,) for k in (*range(20), 5, None)]
    lines = [(k, n) for k in (*range(25), None) for n in (1, 2)]
    for name, rows, names in (("orders", orders, "o_orderkey bigint"), ("lineitem", lines, "l_orderkey int, l_linenumber int")):
        spark.createDataFrame(rows, names).write.parquet(str(tmp_path / f"{name}.parquet"))
    slices = list(registry._slices(registry.V.Tables(spark, str(tmp_path))))
    found = [(rows_of(s.orders, "o_orderkey"), rows_of(s.lineitem, "l_orderkey", "l_linenumber")) for s in slices]
    assert sorted(sum((o for o, _ in found), []), key=repr) == sorted(orders, key=repr)
    assert sorted(sum((x for _, x in found), []), key=repr) == sorted(lines, key=repr)
    for o, x in found:
        assert not ({k for k, _ in x} & {k for other, _ in found if other is not o for (k,) in other})


def test_windows_that_event_time_closes_equal_sparks(spark, tmp_path):
    """Each file is a batch. "b" comes late for its window, "c" in time for its own; that of "e" is never closed."""
    batches = [[("a x", 1_000), ("a", 2_000)], [("x", 4_999), ("z", None), ("q", 12_000)], [("b", 3_000), ("c", 13_000), ("q q", 12_500), (None, 14_000)],
               [("late", 1)], [], [("end", 41_000)], [("d", 43_000), ("e", 90_000)]]
    schema = "item string, ts bigint"
    source = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    words = lambda rows: split_keyword(rows, "item")
    (tmp_path / "in").mkdir()
    for i, rows in enumerate(batches):  # each is drained by itself, so that Spark closes its windows before the next comes
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"w{i}"))
        for f in (tmp_path / f"w{i}").glob("*.parquet"):
            os.utime(f, (1_000_000 + i, 1_000_000 + i))
            f.rename(tmp_path / "in" / f"{i}.parquet")
        run_stream(windows.keyword_window(words(with_event_time(source())), 5), rows_to(str(tmp_path / "spark")), str(tmp_path / "c1"), drain=True).awaitTermination()
    expected = rows_of(spark.read.parquet(str(tmp_path / "spark")), *KEYWORD_WINDOW)

    closing = ClosedWindows(str(tmp_path / "open"), with_event_time(spark.createDataFrame([], schema)).schema, 5, buckets=2, fold_every=2)
    given = []

    def write(batch, batch_id):
        rows = with_event_time(batch, delay=None)
        again = [rows_of(windows.text_window(closing.closed(rows, batch_id), words, 5), *KEYWORD_WINDOW) for _ in range(2)]
        assert again[0] == again[1]
        given.append(again[0])

    run_stream(source(), write, str(tmp_path / "c2"), drain=True).awaitTermination()
    assert sorted(sum(given, []), key=repr) == expected
    assert len(given) == len(batches) and given[1] and not given[0] and len(set(sum(given, []))) == len(sum(given, []))
    assert [r[3:] for r in expected if r[3] in "abcdx"] == [("a", 2), ("x", 2), ("c", 1), ("d", 1)]
    waiting = closing.store.read(spark, replay=7).where("batch_id = 6")
    assert rows_of(waiting, "item") == [("e",)]


def test_products_are_looked_up_once_for_all_their_windows(spark):
    """The chain of look-ups runs over the products; rows, with repeated, missing and null keys, are those of the chain over the sums."""
    text = lambda rows, names: spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names.split()))
    dims = {"dim_sku_info": text([("1", "n1", "s1", "t1", "c1"), ("1", "n1b", None, "t2", "c1"), ("2", "n2", "s1", None, "cx"), (None, "n", "s1", "t1", "c1")],
                                 "id sku_name spu_id tm_id category3_id"),
            "dim_spu_info": text([("s1", "spu"), ("s1", "spu again")], "id spu_name"), "dim_base_trademark": text([("t1", "tm"), (None, "tm0")], "id tm_name"),
            "dim_base_category3": text([("c1", "c", "d1")], "id name category2_id"), "dim_base_category2": text([("d1", "d", "e1")], "id name category1_id"),
            "dim_base_category1": text([("e1", "e")], "id name")}
    amounts = [c for c in SKU_ORDER_WINDOW if c.endswith("amount")]
    sums = text([("w1", "1"), ("w2", "1"), ("w1", "2"), ("w1", "3"), ("w1", None)], "stt sku_id").select(
        "*", F.lit("e").alias("edt"), F.lit("d").alias("cur_date"), *[F.lit(1).cast("decimal(38,4)").alias(c) for c in amounts])
    found, chain = sku.with_products(sums, dims), enrich_snowflake(sums, dims, SKU_CHAIN).select(*SKU_ORDER_WINDOW)
    assert rows_of(found, *SKU_ORDER_WINDOW) == rows_of(chain, *SKU_ORDER_WINDOW) and found.count() == 2 * 3 + 2 + 2
    joins = lambda df: str(df._jdf.queryExecution().optimizedPlan().children().apply(0).children().apply(0).toString()).count("Join LeftOuter")
    assert joins(found) == 0 and joins(chain) > 0  # on the side of the sums


def test_a_delta_join_stores_its_key_once(spark, tmp_path):
    sides = {"a": spark.createDataFrame([("x", 1)], "ka string, v int"), "b": spark.createDataFrame([("x", 2)], "kb string, w int")}
    delta = DeltaJoin(str(tmp_path / "j"), sides, {"a": {"k": "ka"}, "b": {"k": "kb"}}, lambda s: fact_join(s["a"], s["b"], [("ka", "kb")]),
                      newest={"a": ["ka"]}, buckets=2, fold_every=1)
    assert [rows_of(delta.results(sides, n), "ka", "v", "w") for n in range(3)] == [[("x", 1, 2)], [("x", 1, 2)] * 2, [("x", 1, 2)] * 3]
    assert spark.read.parquet(str(tmp_path / "j/base/upto=1")).columns == ["side", "a", "b", "batch_id", "bucket", "place"]
