"""What the fact and keyword plans shuffle: plans without broadcasts, as on large tables."""
import re

import pytest
from pyspark.sql import functions as F

from brookmart.functions.text import split_keyword
from brookmart.operators import windows
from brookmart.registry import QUERIES
from helpers import rows_of

TABLES = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_items_are_shuffled_by_order_once(no_broadcast):
    plan = plan_of(QUERIES["dwd_order_detail"](no_broadcast, TABLES))
    assert len(re.findall(r"Exchange hashpartitioning\((?:order_id|l_orderkey)#", plan)) == 1


@pytest.mark.parametrize("name, above", [("dwd_order_cancel", "Join .*cou_id.*LeftOuter"), ("dwd_pay_success", "Join .*left_stretch.*Inner")])
def test_items_of_other_orders_are_left_out_first(no_broadcast, name, above):
    plan = plan_of(QUERIES[name](no_broadcast, TABLES))
    semi, join = re.search(r"Join .*LeftSemi", plan), re.search(above, plan)
    assert semi and join and semi.start() > join.start()  # below that join


def searches(spark):
    rows = [(f"a b{i % 3} c{i}", i * 700) for i in range(40)] + [("hot word", 100)] * 30 + [(None, 5), ("", 6)]
    return spark.createDataFrame(rows, "item string, ms bigint").select("item", F.timestamp_millis("ms").alias("et"))


@pytest.mark.parametrize("hot_texts", [0, 20, 1000])
def test_texts_by_window_count_as_words_do(spark, hot_texts):
    got = windows.text_window(searches(spark), lambda rows: split_keyword(rows, "item"), 5, hot_texts)
    want = windows.keyword_window(split_keyword(searches(spark), "item"), 5)
    assert rows_of(got, *want.columns) == rows_of(want, *want.columns)


def test_texts_not_words_are_shuffled(no_broadcast):
    plan = plan_of(QUERIES["dws_keyword_window"](no_broadcast, TABLES))
    cold = plan[:plan.index("REPARTITION_BY_COL")]
    assert "Exchange" not in cold.replace("Exchange hashpartitioning(_start#", "", 1)
