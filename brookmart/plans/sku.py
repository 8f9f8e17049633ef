"""Order amounts by product and window, with the product's dimensions."""
from __future__ import annotations

from pyspark.sql import functions as F

from brookmart.operators.joins import SKU_CHAIN, enrich_snowflake, lookup_left
from brookmart.operators.retract import to_amounts
from brookmart.operators.windows import sku_window, start_texts, window_start
from brookmart.schemas import SKU_AMOUNTS, SKU_ORDER_WINDOW
from brookmart.streaming.deltas import DeltaSums


def sku_sums(details, order, seconds=10, **options):
    """Amounts by product and window; a stream looks its dimensions up when it writes."""
    amounts = list(SKU_AMOUNTS.values())
    return sku_window(to_amounts(details, SKU_AMOUNTS), "id", order, amounts, seconds, **options)


def sku_sums_deltas(path, order, seconds=10, **options):
    """Amounts by product and window as they change: a function of (details of a batch, batch id).

    Gives the sums of every window that a batch changes; by window and product the newer row
    replaces the older. Versions may come in any order and however late.
    """
    amounts = list(SKU_AMOUNTS.values())

    def results(details, batch_id):
        rows = to_amounts(details, SKU_AMOUNTS).withColumn("_start", window_start("(ts * 1000)", seconds))
        sums = DeltaSums(path, rows.schema, "id", order, ["_start", "sku_id"], amounts, **options).results(rows, batch_id)
        return start_texts(sums, seconds)

    return results


def with_products(sums, dims):
    """The sums with the dimensions of their products.

    The chain runs over the products and not over their windows, which are many more: a row of sums is looked up once.
    """
    name, key, dim_key, columns = SKU_CHAIN[0]
    products = dims[name].select(F.col(dim_key).alias("_product"), *[F.col(source).alias(c) for source, c in columns.items()])
    products = enrich_snowflake(products, dims, SKU_CHAIN[1:])
    found = {c: c for c in products.columns if c != "_product"}
    return lookup_left(sums, products, key, "_product", found).select(*SKU_ORDER_WINDOW)


def sku_order_window(details, dims, order, seconds=10, **options):
    """Aggregate first, look up afterwards: dimensions join one row per window.

    `details` is the order-detail fact, `order` the column(s) that order the
    versions of one detail, `dims` the dimensions of `SKU_CHAIN` by name.
    """
    return with_products(sku_sums(details, order, seconds, **options), dims)
