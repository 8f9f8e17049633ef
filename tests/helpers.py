"""Small builders for test rows."""
import json

from pyspark.sql import functions as F

DAY_MS = 86_400_000
CDC = ("database string, `table` string, type string, data map<string,string>, "
       "old map<string,string>, ts bigint")


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def log(mid="a", ts=0, is_new="1", page="home", last=None, during="5", **extra):
    record = {"common": {"mid": mid, "vc": "v1", "ch": "c1", "ar": "1", "is_new": is_new, "sid": "s"}, "ts": ts}
    if page:
        record["page"] = {"page_id": page, "during_time": during}
        if last:
            record["page"]["last_page_id"] = last
    record.update(extra)
    return json.dumps(record)


def changes(spark, rows):
    """Rows of (table, type, data, old, ts) as changes with event time."""
    full = [("shop", table, type_, data, old, ts) for table, type_, data, old, ts in rows]
    return spark.createDataFrame(full, CDC).withColumn("et", F.timestamp_seconds("ts"))


def rows_of(df, *columns):
    return sorted([tuple(r) for r in df.select(*columns).collect()], key=repr)


def write_files(folder, batches):
    """One text file per batch, named (and dated) in order."""
    import os
    import time
    os.makedirs(folder, exist_ok=True)
    now = time.time() - 1000
    for i, lines in enumerate(batches):
        path = f"{folder}/{i:03d}.txt"
        with open(path, "w") as out:
            out.write("\n".join(lines) + "\n")
        os.utime(path, (now + i * 10, now + i * 10))
