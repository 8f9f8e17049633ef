"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local
cores. Each query is planned and executed in full into the no-op sink: one warm-up,
then the mean of BENCH_RUNS (2) runs. Streams drain their whole table once, start and stop
included, and are given apart from the total, with the rows a second of their table.
"""
from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from brookmart.registry import QUERIES

HEADLINE = [
    "dwd_order_detail", "dwd_order_cancel", "dwd_pay_success", "dwd_order_refund", "dwd_refund_pay",
    "dwd_cart_add", "dwd_comment_info", "log_records", "dws_traffic_window", "dws_home_detail",
    "dws_keyword_window", "dws_sku_order", "dim_sync", "base_db_route", "upsert_latest", "sku_retract",
]
#: Streams and the table whose rows they read.
STREAMS = {"stream_sku_window": "lineitem", "stream_refund_pay": "orders", "stream_fix_is_new": "events"}


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "16g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    seconds = {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.mean(times[1:]), 3)
    streams = {}
    for name, table in STREAMS.items():
        if os.environ.get("BENCH_STREAMS", "1") == "1":
            rows = spark.read.parquet(f"{folder}/{table}.parquet").count()
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            streams[name] = {"sec": round(took, 3), "rows_per_sec": round(rows / took)}
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "streams": streams, "sf": os.path.basename(folder.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
