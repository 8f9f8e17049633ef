"""Sinks that write tables, and table life cycle driven by rules."""
from __future__ import annotations

from pyspark.sql import functions as F

from brookmart.operators.rules import dim_table


def output_columns(df, columns):
    """The output fields, in insert order; working columns stay out."""
    return df.select(*columns)


def write_table(df, table, batch_id=None, path=None):
    """Append to a catalog table, or to a folder in which each batch owns a part.

    With a batch id, a catalog table is partitioned by `batch_id`, and a batch that is run again
    replaces its own partition; it is created by the first batch. Without one, rows are appended.
    """
    if path is not None:
        df.write.mode("overwrite").parquet(f"{path}/{table}/batch_id={batch_id or 0}")
    elif batch_id is None:
        df.write.mode("append").saveAsTable(table)
    else:
        spark = df.sparkSession
        if not spark.catalog.tableExists(table):
            df.limit(0).withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.partitionBy("batch_id").saveAsTable(table)
        columns = [c for c in spark.table(table).columns if c != "batch_id"]
        rows = ", ".join(f"`{c}`" for c in columns)
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (batch_id = {int(batch_id)}) SELECT {rows} FROM {{rows}}", rows=df)


def jdbc_options(table, conn, batchsize=1000):
    return {"dbtable": table, "batchsize": str(batchsize), **conn}


def write_jdbc(df, table, columns, conn, batchsize=1000):
    """Insert rows into a JDBC table: columns in declared order, sent in batches."""
    (output_columns(df, columns).write.format("jdbc")
     .options(**jdbc_options(table, conn, batchsize)).mode("append").save())


def write_console(df):
    """Print micro-batches (for debugging)."""
    return df.writeStream.format("console").option("truncate", "false")


def _columns_of(rule):
    names = list(dict.fromkeys(c.strip() for c in rule["sink_columns"].split(",") if c.strip()))
    return [c for c in names if c != "row_key"]


def apply_rule_ddl(spark, rule_changes, database):
    """Create and drop dimension tables as rules come and go.

    A new or initially read rule creates its table, a delete drops it, an update
    drops and creates it (its rows come back with `refresh_dim_table`). Rules are
    configuration written by hand, a row per table, so they are read on the driver;
    nothing else is. Returns the rules whose tables must be filled.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    to_fill = {}
    for rule in rule_changes.orderBy("seq").toLocalIterator():
        name = f"{database}.{rule['sink_table']}"
        if rule["op"] in ("d", "u"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            to_fill.pop(name, None)
        if rule["op"] in ("c", "r", "u"):
            columns = ", ".join(f"`{c}` STRING" for c in ["row_key", *_columns_of(rule)])
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")
            to_fill[name] = rule
    return to_fill


def refresh_dim_table(spark, merged, rule, database):
    """Overwrite one dimension table with the merged rows of the change log."""
    rows = dim_table(merged, rule["sink_table"], _columns_of(rule))
    rows.write.mode("overwrite").insertInto(f"{database}.{rule['sink_table']}")


def rule_view_sql(rule, path):
    """The rows of one dimension by row key, from the cells under `path` (see `streaming.jobs.dims_to`).

    The newest cell counts, unless a delete of its row is newer. Cells that lie both in the base
    and in a batch are the same, so the view needs no list of the folders that count.
    """
    names = _columns_of(rule)

    def text(value):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    cell = ", ".join(f"max(if(column_name = {text(c)}, struct(batch_id, seq, value), null)) AS _{i}" for i, c in enumerate(names))
    live = [f"_{i}.value IS NOT NULL AND (_gone IS NULL OR struct(_{i}.batch_id, _{i}.seq) > _gone)" for i in range(len(names))]
    shown = ", ".join(f"if({alive}, _{i}.value, null) AS `{c}`" for i, (c, alive) in enumerate(zip(names, live)))
    listed = ", ".join(text(c) for c in names)
    return f"""SELECT row_key, {shown} FROM (
        SELECT row_key, max(if(deleted, struct(batch_id, seq), null)) AS _gone, {cell} FROM parquet.`{path}/*/*`
        WHERE sink_table = {text(rule["sink_table"])} AND (deleted OR column_name IN ({listed})) GROUP BY row_key)
        WHERE {" OR ".join(f"({alive})" for alive in live)}"""


def apply_rule_views(spark, rule_changes, database, path):
    """Create, replace and drop the views of dimensions as rules come and go (see `apply_rule_ddl`)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for rule in rule_changes.orderBy("seq").toLocalIterator():
        name = f"{database}.{rule['sink_table']}"
        if rule["op"] == "d":
            spark.sql(f"DROP VIEW IF EXISTS {name}")
        else:
            spark.sql(f"CREATE OR REPLACE VIEW {name} AS {rule_view_sql(rule, path)}")
