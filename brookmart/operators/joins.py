"""Joins between facts, and look-ups in dimensions.

No join here carries a broadcast hint. Catalyst broadcasts a side only while its
size, from statistics or measured at run time, is below
`spark.sql.autoBroadcastJoinThreshold`; beyond that the same plan runs as a
sort-merge join whose hot partitions adaptive execution reads in slices (see
`brookmart.session`, which turns this on even where it costs another exchange).
"""
from __future__ import annotations

from pyspark.sql import functions as F


def _equal(pairs):
    condition = None
    for left, right in pairs:
        same = F.col(left) == F.col(right)
        condition = same if condition is None else condition & same
    return condition


def fact_join(left, right, on, how="inner", gap=None, right_time=None):
    """Equi join of two facts; `on` is a list of (left column, right column).

    Column names must differ between the sides. Without `gap` every pair is found, in
    batch and on streams alike; an inner stream join then keeps its rows for ever. `gap`
    bounds how far event times (`et`, `right_time`) may lie apart on a stream, so that
    join state can be dropped. Spark's outer stream joins need such a bound, so there it
    must be given. The right event time is dropped from the result.
    """
    condition = _equal(on)
    if left.isStreaming and how != "inner" and not (gap and right_time):
        raise ValueError("an outer join of streams needs a gap and the right event time")
    if left.isStreaming and right_time and gap:
        condition = condition & F.expr(
            f"{right_time} BETWEEN et - INTERVAL {gap} AND et + INTERVAL {gap}")
    joined = left.join(right, condition, how)
    return joined.drop(right_time) if right_time else joined


def interval_join(left, right, on, low_s, high_s, left_time="et", right_time="right_et"):
    """Inner join on keys and `left_time in [right_time + low_s, right_time + high_s]`.

    Both ends are included. On a stream the range bounds the join state. In batch
    the range also becomes part of the key: time is cut into stretches as long as
    the range, and a right row is sent to the (at most two) stretches its range
    touches. Each left row lies in exactly one stretch, so no pair is found twice,
    and a hot key is spread over as many partitions as it has stretches.
    """
    in_range = F.expr(f"{left_time} >= {right_time} + INTERVAL {low_s} SECONDS "
                      f"AND {left_time} <= {right_time} + INTERVAL {high_s} SECONDS")
    if left.isStreaming or right.isStreaming:
        return left.join(right, _equal(on) & in_range, "inner")
    width = max(1, high_s - low_s) * 1_000_000
    first = F.expr(f"(unix_micros({right_time}) + {low_s * 1_000_000}) DIV {width}")
    last = F.expr(f"(unix_micros({right_time}) + {high_s * 1_000_000}) DIV {width}")
    cut_left = left.withColumn("left_stretch", F.expr(f"unix_micros({left_time}) DIV {width}"))
    cut_right = right.select("*", F.explode(F.sequence(first, last)).alias("right_stretch"))
    pairs = [*on, ("left_stretch", "right_stretch")]
    return (cut_left.join(cut_right, _equal(pairs) & in_range, "inner")
            .drop("left_stretch", "right_stretch"))


def lookup(df, dim, key, dim_key, columns, how="left"):
    """Add dimension attributes to rows; `columns` maps attribute to output name.

    "left" keeps rows without a match (attributes null), "inner" drops them. Use
    the same dimension again under other output names to look up a second key.
    """
    side = dim.select(F.col(dim_key).alias("_dim_key"),
                      *[F.col(source).alias(name) for source, name in columns.items()])
    return df.join(side, F.col(key) == F.col("_dim_key"), how).drop("_dim_key")


def lookup_inner(df, dim, key, dim_key, columns):
    """Look-up that drops rows without a match."""
    return lookup(df, dim, key, dim_key, columns, "inner")


def lookup_left(df, dim, key, dim_key, columns):
    """Look-up that keeps rows without a match."""
    return lookup(df, dim, key, dim_key, columns, "left")


def enrich_snowflake(df, dims, steps):
    """A chain of left look-ups in which each may supply the key of a later one.

    `steps` is a list of (dimension name, key column, dimension key, columns).
    """
    for name, key, dim_key, columns in steps:
        df = lookup_left(df, dims[name], key, dim_key, columns)
    return df


# Look-ups of the sku order window. State plainly which column feeds which key.
SKU_CHAIN = [
    ("dim_sku_info", "sku_id", "id", {"sku_name": "sku_name", "spu_id": "spu_id",
                                      "tm_id": "trademark_id", "category3_id": "category3_id"}),
    ("dim_spu_info", "spu_id", "id", {"spu_name": "spu_name"}),
    ("dim_base_trademark", "trademark_id", "id", {"tm_name": "trademark_name"}),
    ("dim_base_category3", "category3_id", "id", {"name": "category3_name",
                                                  "category2_id": "category2_id"}),
    ("dim_base_category2", "category2_id", "id", {"name": "category2_name",
                                                  "category1_id": "category1_id"}),
    ("dim_base_category1", "category1_id", "id", {"name": "category1_name"}),
]
