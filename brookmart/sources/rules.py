"""Routing rules: snapshot at start, then their change stream."""
from __future__ import annotations

from pyspark.sql import functions as F

from brookmart.operators.rules import rule_row
from brookmart.schemas import DIM_RULE, DWD_RULE

RULES = {"dim": DIM_RULE, "dwd": DWD_RULE}


def read_rule_changes(df_text, kind):
    """Parse rule changes `op, before, after`; an optional `seq` orders them."""
    rule = RULES[kind].replace(" string", ": string")
    schema = f"op string, before struct<{rule}>, after struct<{rule}>, seq bigint"
    record = F.from_json("value", schema)
    return rule_row(df_text.filter(F.col("value").isNotNull()).select(record.alias("r")).select("r.*"))


def snapshot_as_changes(rules, seq=-1):
    """Rules of a snapshot as reads (`op = 'r'`), older than any change."""
    return rules.select(F.lit("r").alias("op"), *rules.columns, F.lit(seq).cast("bigint").alias("seq"))


def load_rules_snapshot(spark, source):
    """The rule table at start: a parquet path, or JDBC options as a dict."""
    if isinstance(source, dict):
        from brookmart.sources.tables import read_jdbc
        conn = dict(source)
        rules = read_jdbc(spark, conn.pop("table"), conn)
    else:
        rules = spark.read.parquet(source)
    return snapshot_as_changes(rules)


def fenced_rules(snapshot, changes, position):
    """Rules of a snapshot and the changes that came after it, as one stream of changes.

    `position` is the end of the change topic when the snapshot was read, taken before reading
    it: changes up to it (by `seq`) are in the snapshot and would only bring older rules back, so
    they are left out. Later ones may be in the snapshot too; they are applied once more, in
    order, and give the same rules. The snapshot's rows stand at `position`.
    """
    fence = F.lit(position).cast("bigint")
    first = snapshot.select(*[fence.alias("seq") if c == "seq" else c for c in snapshot.columns])
    return first.unionByName(changes.filter(F.col("seq") > fence), allowMissingColumns=True)
