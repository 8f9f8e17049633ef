"""Running pipelines as streams."""
from __future__ import annotations

from pyspark.sql import functions as F

from brookmart.operators.logs import fix_is_new, log_records, mark_dirty, parse_log
from brookmart.operators.rules import cells, current_rules, dim_changes, newest_cells, project_rows, rows_of_cells
from brookmart.session import stream_settings
from brookmart.sinks.store import Store
from brookmart.sinks.tables import apply_rule_ddl, apply_rule_views, refresh_dim_table
from brookmart.sinks.topics import (write_json_rows, write_routed, write_text_topic, write_upsert,
                                    write_upsert_topic)


def run_stream(df, write_batch, checkpoint, every="5 seconds", drain=False, mode="append", name=None):
    """Start a stream that hands each micro-batch to `write_batch(df, batch_id)`.

    Offsets and state are checkpointed, so a restart repeats at most the last batch
    under the same id; the sinks of this package replace what that id wrote before.
    `drain` processes what is available and stops. Batches run under `STREAM_SETTINGS`.
    """
    def write(batch, batch_id):
        with stream_settings(batch.sparkSession):
            write_batch(batch, batch_id)

    writer = df.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=every)
    return writer.start()


def upsert_to(path, keys=None, order=None):
    """Batch writer: append to the keyed changelog at `path`."""
    def write(batch, batch_id):
        write_upsert(batch, path, batch_id, order, keys)
    return write


def rows_to(path):
    """Batch writer: each batch owns one folder of the parquet table at `path`."""
    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


def records_to(conn):
    """Batch writer: records routed by their `topic` column, in one pass."""
    def write(batch, batch_id):
        write_routed(batch, conn, batch_id)
    return write


def text_to(topic, conn):
    """Batch writer: the `value` texts of one topic."""
    def write(batch, batch_id):
        write_text_topic(batch, topic, conn, batch_id)
    return write


def json_to(table, conn, columns=None):
    """Batch writer: JSON rows for the load folder of a table."""
    def write(batch, batch_id):
        write_json_rows(batch, table, conn, columns, batch_id)
    return write


def keyed_to(keys, topic, conn):
    """Batch writer: changes of a keyed topic; rows flagged `_deleted` become tombstones."""
    def write(batch, batch_id):
        write_upsert_topic(batch, keys, topic, conn)
    return write


def log_split_stream(df_text, topics=None):
    """Cleaned, repaired and split log records (`topic, value`) and dirty text, in one pass."""
    return log_records(fix_is_new(mark_dirty(parse_log(df_text))), topics)


def looked_up(write, dims, enrich):
    """Batch writer: `enrich(batch, dims())`, then `write`.

    `dims` is a function, called by every batch: a DataFrame made before the stream
    starts would go on listing the files of that time.
    """
    def enriched(batch, batch_id):
        write(enrich(batch, dims()), batch_id)
    return enriched


def routed_to(rules, conn, keys=("table", "type")):
    """Batch writer: rows routed by the rules in force when the batch starts.

    `rules` is a function that returns the rule changes known by then.
    """
    from brookmart.operators.rules import match_rules, project_by_rule, routed_payload

    def write(batch, batch_id):
        in_force = current_rules(rules(), ["source_table", "source_type"])
        write_routed(routed_payload(project_by_rule(match_rules(batch, in_force, list(keys)))), conn, batch_id)
    return write


CELLS = "sink_table string, row_key string, column_name string, value string, deleted boolean, seq bigint"


def dim_store(path, buckets=32):
    """The store of dimension cells at `path` (see `brookmart.sinks.store`)."""
    return Store(path, CELLS, ["sink_table", "row_key"], buckets)


def _newest(rows):
    return newest_cells(rows.drop("bucket", "place"), "batch_id", "seq")


def dims_to(rules, path, database, order="seq", buckets=32, fold_every=20):
    """Batch writer: dimension row changes under the rules in force, as cells in a store.

    `order` orders the changes of a row within a batch: the offset in its topic (see
    `read_text_topic`), or `ts` where a row changes at most once a second. The store
    keeps all columns, so that a rule which lists more of them later finds them. A batch adds
    the newest value of each cell and the newest delete of each row; every `fold_every`
    batches they are folded into the base, deletes included.
    """
    store = dim_store(path, buckets)

    def write(batch, batch_id):
        if batch_id and batch_id % fold_every == 0:
            store.fold(batch.sparkSession, batch_id - 1, _newest)
        in_force = current_rules(rules(), ["source_table"])
        changes = dim_changes(batch, in_force, database, order, project=False).withColumn("seq", F.col(order).cast("bigint"))
        store.append(newest_cells(cells(changes, "seq"), "seq"), batch_id)
    return write


def _merged(spark, path, tables=None):
    rows = dim_store(path).read(spark)
    if tables is not None:
        rows = rows.filter(F.col("sink_table").isin(list(tables)))
    return rows_of_cells(rows, "batch_id", "seq")


def read_dims(spark, path, rules, tables=None):
    """Current dimension rows of the store written by `dims_to`, under `rules` (changes).

    Reads the base and the batches after it, of all dimensions or of the named `tables`. A store
    that does not exist yet is empty. Read it by every batch that looks up in them (see `looked_up`).
    """
    return project_rows(_merged(spark, path, tables), current_rules(rules, ["source_table"]))


def rule_tables_to(path, database):
    """Batch writer for the stream of dimension rules: tables that are filled when a rule changes.

    Tables are created, dropped and recreated as the rules say, and those that are
    new are filled from the store at `path`, so an update loses no rows. Between changes of
    their rule they stand still; `rule_views_to` gives tables that follow the rows.
    """
    def write(batch, batch_id):
        spark = batch.sparkSession
        for rule in apply_rule_ddl(spark, batch, database).values():
            refresh_dim_table(spark, _merged(spark, path, [rule["sink_table"]]), rule, database)
    return write


def rule_views_to(path, database):
    """Batch writer for the stream of dimension rules: a view for each table that a rule makes.

    A view merges the cells of its table when it is read, so it shows each change as soon as its
    batch is written, and no reader meets a table without its rows: a changed rule replaces the
    view at once. A rule may come before the first row.
    """
    def write(batch, batch_id):
        dim_store(path).create(batch.sparkSession)
        apply_rule_views(batch.sparkSession, batch, database, path)
    return write
