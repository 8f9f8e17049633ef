"""Row changes: validity, branches, transitions."""
from __future__ import annotations

from pyspark.sql import functions as F

from brookmart.functions.timecols import gate
from brookmart.schemas import CHANGE_TYPES


def valid_changes(ods, database):
    """Changes of one database, of a known type, that carry data."""
    return gate(ods, (F.col("database") == database) & F.col("type").isin(CHANGE_TYPES)
                & F.col("data").isNotNull() & (F.size("data") > 0))


def branch(ods, table, types, columns, keep=("ts",), where=None):
    """Changes of one source table and type(s), with `data` keys as columns.

    `columns` maps output name to `data` key, or is a list where both are equal.
    Event time, where the input has it, is kept as `et`.
    """
    if not isinstance(columns, dict):
        columns = {c: c for c in columns}
    types = [types] if isinstance(types, str) else list(types)
    condition = (F.col("table") == table) & F.col("type").isin(types)
    if where is not None:
        condition = condition & where
    keep = [c for c in (*keep, "et") if c in ods.columns]
    rows = gate(ods, condition)
    value = {name: F.col("data")[key] for name, key in columns.items()}
    if ods.isStreaming and "et" in keep:
        # Joins demand keys that are not null. Without the event time in them these filters move
        # below the watermark, where rows of other tables could no longer advance it.
        value = {name: F.when(F.col("et").isNotNull(), v) for name, v in value.items()}
    return rows.select(*[v.alias(name) for name, v in value.items()], *keep)


def changed_to(column, new, old=None):
    """Condition: this change moved `column` to `new` (from `old`, where given)."""
    before = F.col("old")[column]
    moved = before.isNotNull() if old is None else before == old
    return moved & (F.col("data")[column] == new)


def cart_add(ods):
    """Additions to a cart: whole quantity on insert, the increase on update.

    A quantity of an update that is no whole number fails the job.
    """
    now, before = F.col("data")["sku_num"], F.col("old")["sku_num"]
    changed = (F.col("table") == "cart_info") & (F.col("type") == "update")

    def whole(text):
        bad = F.raise_error(F.concat(F.lit("bad quantity: "), text)).cast("int")
        return F.when(changed & text.isNotNull(), F.coalesce(text.try_cast("int"), bad))

    now_n, before_n = whole(now), whole(before)
    inserted = F.col("type") == "insert"
    grew = (F.col("type") == "update") & before.isNotNull() & (now_n > before_n)
    rows = gate(ods, (F.col("table") == "cart_info") & (inserted | grew))
    return rows.select(
        *[F.col("data")[c].alias(c) for c in ("id", "user_id", "sku_id")],
        F.when(inserted, now).otherwise((now_n - before_n).cast("string")).alias("sku_num"),
        "ts")


def drop_tombstones(df, column="value"):
    """Drop delete markers (null values) of a keyed topic."""
    return df.filter(F.col(column).isNotNull())
