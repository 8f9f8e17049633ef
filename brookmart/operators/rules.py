"""Routing rules that arrive as a change stream, and rows projected by them."""
from __future__ import annotations

from pyspark.sql import functions as F


def rule_row(changes):
    """Flatten `op, before, after` into the rule's columns.

    A delete is described by the row before it, any other change by the row after.
    """
    rule = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    kept = [c for c in changes.columns if c not in ("before", "after", "op")]
    return changes.withColumn("_rule", rule).select("op", "_rule.*", *kept)


def current_rules(changes, keys, order="seq"):
    """Rules in force: the last change of every full key, unless it is a delete."""
    rest = [c for c in changes.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.col(order)).alias("_last")
    return (changes.groupBy(*keys).agg(last).select(*keys, "_last.*")
            .filter(F.col("op") != "d").drop("op", order))


def match_rules(changes, rules, keys):
    """Pair each row change with its rule; rows without a rule are dropped.

    `keys` is ["table"] (dimensions) or ["table", "type"] (facts). Rule tables are
    small, so this is a broadcast join unless Spark measures otherwise. The rule's
    column list is split here, once per rule, into `wanted`.
    """
    source = {"table": "source_table", "type": "source_type"}
    wanted = F.array_distinct(F.transform(F.split("sink_columns", ","), F.trim))
    side = rules.withColumnsRenamed({source[k]: f"_rule_{k}" for k in keys}).withColumn("wanted", wanted)
    condition = F.lit(True)
    for key in keys:
        condition = condition & (F.col(key) == F.col(f"_rule_{key}"))
    return changes.join(side, condition, "inner").drop(*[f"_rule_{k}" for k in keys])


def project_by_rule(matched):
    """Replace `data` by the columns the rule lists, as a map.

    A listed column that the row lacks is present with a null value.
    """
    pairs = F.transform("wanted", lambda c: F.struct(c, F.col("data")[c]))
    return matched.withColumn("data", F.map_from_entries(pairs)).drop("wanted")


def routed_payload(projected):
    """(topic, value): the JSON text of each projected row and where it goes.

    The payload carries the change type and time next to the data columns; columns
    without a value are left out of the text.
    """
    def entry(name, value):
        return F.struct(F.lit(name).alias("key"), value.alias("value"))

    extra = F.array(entry("type", F.col("type")), entry("ts", F.col("ts").cast("string")))
    data = F.filter(F.map_entries("data"), lambda e: e["value"].isNotNull() & ~e["key"].isin("type", "ts"))
    return projected.select(F.col("sink_table").alias("topic"),
                            F.to_json(F.map_from_entries(F.concat(extra, data))).alias("value"))


def merge_cells(changes, order="seq"):
    """Apply upserts and deletes to dimension rows, column by column.

    Input: `sink_table, row_key, type, data` and `order`, which must order the
    changes of a row. A null cell of an upsert leaves the older value in place; a
    delete removes everything before it. Output: `sink_table, row_key, data`.

    Cells are aggregated before and after the shuffle, so a row key with endless
    changes never collects in one task; what is gathered per row is one entry per
    column.
    """
    ordered = changes.withColumn("_at", F.struct(order))
    return rows_of_cells(cells(ordered, "_at"), "_at")


def cells(changes, *order):
    """The cells that row changes set, and a mark for each delete (without a column name)."""
    deleted = F.col("type") == "delete"
    flat = changes.select("sink_table", "row_key", *order, deleted.alias("deleted"), F.explode_outer(
        F.when(~deleted, F.map_filter("data", lambda _, v: v.isNotNull()))).alias("column_name", "value"))
    return flat.filter(F.col("deleted") | F.col("column_name").isNotNull())


def newest_cells(flat, *order):
    """The newest value of every cell and the newest delete of every row; nothing else decides a merged row."""
    keys = ["sink_table", "row_key", "column_name", "deleted"]
    newest = flat.groupBy(*keys).agg(F.max(F.struct(*order, "value")).alias("_newest"))
    return newest.select(*keys, "_newest.*").select(*flat.columns)


def rows_of_cells(flat, *order):
    """Current dimension rows of cells (see `merge_cells`): sink_table, row_key and data."""
    newest = flat.groupBy("sink_table", "row_key", "column_name").agg(
        F.max(F.when(~F.col("deleted"), F.struct(F.struct(*order).alias("_at"), "value"))).alias("_cell"),
        F.max(F.when(F.col("deleted"), F.struct(*order))).alias("_gone"))
    rows = newest.groupBy("sink_table", "row_key").agg(
        F.max("_gone").alias("_gone"),
        F.collect_list(F.when(F.col("column_name").isNotNull(), F.struct("column_name", "_cell"))).alias("_cells"))
    live = F.filter("_cells", lambda c: F.col("_gone").isNull() | (c["_cell"]["_at"] > F.col("_gone")))
    data = F.map_from_entries(F.transform(live, lambda c: F.struct(c["column_name"], c["_cell"]["value"])))
    return rows.select("sink_table", "row_key", data.alias("data")).filter(F.size("data") > 0)


def dim_changes(ods, rules, database, order="seq", project=True):
    """Dimension row changes selected, keyed and (unless `project` is false) projected by the rules."""
    from brookmart.operators.cdc import valid_changes
    matched = match_rules(valid_changes(ods, database), rules, ["table"])
    row_key = F.col("data")[F.trim("sink_row_key")]
    keyed = matched.withColumn("row_key", row_key)
    kept = project_by_rule(keyed) if project else keyed
    return kept.select("sink_table", "row_key", "type", "data", order)


def project_rows(merged, rules):
    """Merged rows of the dimensions that rules in force keep, cut to the columns they list."""
    wanted = F.transform(F.split("sink_columns", ","), F.trim)
    kept = merged.join(rules.select("sink_table", wanted.alias("wanted")), "sink_table")
    cut = kept.withColumn("data", F.map_filter("data", lambda k, _: F.array_contains("wanted", k)))
    return cut.drop("wanted").filter(F.size("data") > 0)


def dim_table(merged, sink_table, columns):
    """One dimension of the merged rows, with a column per attribute."""
    return merged.filter(F.col("sink_table") == sink_table).select(
        F.col("row_key"), *[F.col("data")[c].alias(c) for c in columns])
