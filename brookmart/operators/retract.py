"""Later versions of a row cancel earlier ones."""
from __future__ import annotations

from pyspark.sql import functions as F


def to_amounts(df, amounts):
    """Text amounts as decimals under their output names; missing ones are 0.

    An amount that is no number, or has more than 34 digits before the point, fails the job.
    """
    kept = [c for c in df.columns if c not in amounts]
    return df.select(*kept, *[
        F.when(F.col(source).isNull(), F.lit(0).cast("decimal(38,4)")).otherwise(F.coalesce(
            F.expr(f"try_cast({source} AS decimal(38,4))"),
            F.raise_error(F.concat(F.lit(f"bad amount in {source}: "), F.col(source))).cast("decimal(38,4)"))).alias(name)
        for source, name in amounts.items()])


def negated(df, amounts):
    return df.select(*[(-F.col(c)).cast(df.schema[c].dataType).alias(c) if c in amounts else c
                       for c in df.columns])


def retract_updates(df, key, order, amounts, ttl_ms=None):
    """Every version of a key, and the negation of each version that was replaced.

    `order` (one or more columns) must order the versions of a key without ties.
    The negation keeps the columns of the row it cancels, including its time, so
    only the last version of each key remains in any sum.

    A stream keeps the newest version of each key, for ever or until it was not
    written for `ttl_ms`: a version that comes later than that replaces nothing.

    In batch the last version is found by an aggregate; the rows it leaves over are
    matched on key *and* order, which spreads the versions of a hot key.
    """
    order = [order] if isinstance(order, str) else list(order)
    if df.isStreaming:
        from brookmart.streaming.state import retract_stream
        return retract_stream(df, key, order, amounts, ttl_ms)
    last = df.groupBy(key).agg(F.max(F.struct(*order)).alias("_last")).select(key, "_last.*")
    # Null-safe: a version whose key or order is null is a version too.
    newest = last.select(*[F.col(c).alias(f"_last_{c}") for c in (key, *order)])
    same = F.lit(True)
    for c in (key, *order):
        same = same & F.col(c).eqNullSafe(F.col(f"_last_{c}"))
    replaced = df.join(newest, same, "left_anti").select(*df.columns)
    return df.unionByName(negated(replaced, amounts))


def last_versions(df, key, order):
    """The last version of every key (map-side combined, safe for hot keys)."""
    order = [order] if isinstance(order, str) else list(order)
    rest = [c for c in df.columns if c != key]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(key).agg(newest).select(key, "_row.*").select(*df.columns)
