"""Trade and interaction facts: row changes in, detail facts out.

Each plan is a pure function of DataFrames. Rows of the result have a primary key
and go to a keyed changelog; the same code runs on batch and on streams.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from brookmart import schemas as S
from brookmart.operators.cdc import branch, cart_add, changed_to
from brookmart.operators.joins import fact_join, interval_join, lookup_inner
from brookmart.streaming.deltas import DeltaJoin

MONEY = "decimal(16,2)"


def _without_time(df, prefix):
    """Rename the event time of a join side so that names stay unique."""
    return df.withColumnRenamed("et", f"{prefix}_et")


def _day(column):
    """Day text of a date-time text; null where it is not one."""
    return F.col(column).try_cast("date").cast("string")


def order_detail_parts(ods):
    """What an ordered item is made of: detail, info, activity and coupon rows."""
    detail = branch(ods, "order_detail", "insert", [
        "id", "order_id", "sku_id", "sku_name", "create_time", "sku_num", "order_price",
        "split_total_amount", "split_activity_amount", "split_coupon_amount"])
    detail = detail.withColumn("split_original_amount", (
        F.col("sku_num").try_cast(MONEY) * F.col("order_price").try_cast(MONEY)).cast("string"))
    info = _without_time(branch(ods, "order_info", "insert", {
        "oi_id": "id", "user_id": "user_id", "province_id": "province_id"}, keep=()), "oi")
    activity = _without_time(branch(ods, "order_detail_activity", "insert", {
        "act_id": "order_detail_id", "activity_id": "activity_id",
        "activity_rule_id": "activity_rule_id"}, keep=()), "act")
    coupon = _without_time(branch(ods, "order_detail_coupon", "insert", {
        "cou_id": "order_detail_id", "coupon_id": "coupon_id"}, keep=()), "cou")
    return {"detail": detail, "info": info, "activity": activity, "coupon": coupon}


def _detail_rows(joined):
    return joined.withColumn("date_id", _day("create_time")).select(*S.ORDER_DETAIL)


def order_detail(ods, gap=None):
    """Ordered items with buyer, province, activity and coupon."""
    p = order_detail_parts(ods)
    joined = fact_join(p["detail"], p["info"], [("order_id", "oi_id")], "inner", gap, "oi_et")
    joined = fact_join(joined, p["activity"], [("id", "act_id")], "left", gap, "act_et")
    return _detail_rows(fact_join(joined, p["coupon"], [("id", "cou_id")], "left", gap, "cou_et"))


#: The columns of an ordered item that its own row change gives: what tells items apart where ids repeat.
DETAIL_KEY = [c for c in S.ORDER_DETAIL if c not in ("user_id", "province_id", "activity_id", "activity_rule_id", "coupon_id", "date_id")]


def order_detail_deltas(path, key=("id",), **options):
    """Ordered items as they come: a function of (row changes of a batch, batch id).

    An item appears in the batch in which it and its order are there. An activity or coupon that
    comes later, in whatever batch, gives the item anew; by `key` the newer row replaces the
    older. `key` is the id, or `DETAIL_KEY` where ids repeat. Items without an id are left out.
    What has come is kept in `path`; see `brookmart.streaming.deltas` for the options.
    """
    def with_order(sides):
        return fact_join(sides["detail"], sides["info"], [("order_id", "oi_id")]).drop("oi_id")

    def with_extras(sides):
        joined = fact_join(sides["item"], sides["activity"], [("id", "act_id")], "left")
        return fact_join(joined, sides["coupon"], [("id", "cou_id")], "left").drop("act_id", "cou_id")

    # Versions of an item that are equal in all its own columns need not be told apart.
    newest = {"item": list(key)} if set(key) < set(DETAIL_KEY) else None

    def results(ods, batch_id):
        p = {name: df.drop("et", "oi_et", "act_et", "cou_et") for name, df in order_detail_parts(ods).items()}
        # The order first: an item meets it once, whatever comes later, so it is stored once as such.
        ordered = {"detail": p["detail"].filter("id is not null"), "info": p["info"]}
        items = DeltaJoin(f"{path}/orders", ordered, {"detail": {"order_id": "order_id"}, "info": {"order_id": "oi_id"}},
                          with_order, **options).results(ordered, batch_id)
        extras = {"item": items, "activity": p["activity"], "coupon": p["coupon"]}
        joined = DeltaJoin(f"{path}/items", extras, {"item": {"id": "id"}, "activity": {"id": "act_id"}, "coupon": {"id": "cou_id"}},
                           with_extras, newest=newest, **options).results(extras, batch_id)
        return _detail_rows(joined)

    return results


def _cancelled(ods):
    rows = branch(ods, "order_info", "update", {"oc_id": "id", "cancel_time": "operate_time"},
                  where=changed_to("order_status", S.ORDER_CANCELLED, S.ORDER_CREATED))
    return _without_time(rows, "oc").withColumnRenamed("ts", "oc_ts")


def _cancel_rows(joined):
    return joined.select(*S.ORDER_CANCEL[:9], _day("cancel_time").alias("date_id"),
                         *S.ORDER_CANCEL[10:16], F.col("oc_ts").alias("ts"))


def _of_orders(details, orders, column):
    """Items of the given orders. In batch this goes first: the optimizer moves it down to the scan of the items, so
    those of other orders are not shuffled through the joins that make up a detail."""
    if details.isStreaming or orders.isStreaming:
        return details
    return details.join(orders.select(F.col(column).alias("_wanted")), F.col("order_id") == F.col("_wanted"), "left_semi")


def order_cancel(details, ods, gap=None):
    """Ordered items of orders that were cancelled."""
    cancelled = _cancelled(ods)
    return _cancel_rows(fact_join(_of_orders(details, cancelled, "oc_id"), cancelled, [("order_id", "oc_id")], "inner", gap,
                                  "oc_et" if "oc_et" in cancelled.columns else None))


def order_cancel_deltas(path, **options):
    """Items of cancelled orders as they come: a function of (details, row changes, batch id)."""
    def results(details, ods, batch_id):
        sides = {"detail": details.drop("et"), "cancelled": _cancelled(ods).drop("oc_et")}
        joined = DeltaJoin(path, sides, {"detail": {"order_id": "order_id"}, "cancelled": {"order_id": "oc_id"}},
                           lambda s: fact_join(s["detail"], s["cancelled"], [("order_id", "oc_id")]), **options)
        return _cancel_rows(joined.results(sides, batch_id))
    return results


def _paid(ods):
    paid = branch(ods, "payment_info", "update", {
        "pi_order_id": "order_id", "payment_type_code": "payment_type", "callback_time": "callback_time"},
        where=changed_to("payment_status", S.PAYMENT_DONE))
    return _without_time(paid, "pi").withColumnRenamed("ts", "pi_ts")


def _in_time(details, paid):
    return interval_join(details, paid, [("order_id", "pi_order_id")], -1800, 5, "et", "pi_et")


def payments(details, ods):
    """Ordered items paid within 30 minutes of ordering (5 seconds of slack), without names."""
    paid = _paid(ods)
    return _in_time(_of_orders(details, paid, "pi_order_id"), paid)


def payment_deltas(path, **options):
    """Items paid in time, as they come and however late: a function of (details, row changes, batch id)."""
    def results(details, ods, batch_id):
        sides = {"detail": details, "paid": _paid(ods)}
        return DeltaJoin(path, sides, {"detail": {"order_id": "order_id"}, "paid": {"order_id": "pi_order_id"}},
                         lambda s: _in_time(s["detail"], s["paid"]), **options).results(sides, batch_id)
    return results


def with_payment_names(joined, dic):
    """Payments with the name of their type."""
    joined = lookup_inner(joined, dic, "payment_type_code", "dic_code", {"info.dic_name": "payment_type_name"})
    return joined.select(F.col("id").alias("order_detail_id"), *S.PAY_SUCCESS[1:16],
                         F.col("split_total_amount").alias("split_payment_amount"), F.col("pi_ts").alias("ts"))


def pay_success(details, ods, dic):
    """Ordered items paid in time, with the name of the payment type."""
    return with_payment_names(payments(details, ods), dic)


def refund_request_parts(ods):
    """Refund requests, and the orders of which a refund was asked."""
    refund = branch(ods, "order_refund_info", "insert", {
        "id": "id", "user_id": "user_id", "order_id": "order_id", "sku_id": "sku_id",
        "create_time": "create_time", "refund_type_code": "refund_type",
        "refund_reason_type_code": "refund_reason_type", "refund_reason_txt": "refund_reason_txt",
        "refund_num": "refund_num", "refund_amount": "refund_amount"})
    order = _without_time(branch(ods, "order_info", "update", {"oi_id": "id", "province_id": "province_id"},
                                 keep=(), where=changed_to("order_status", S.ORDER_REFUND_ASKED)), "oi")
    return {"refund": refund, "order": order}


def _requested(p, gap=None):
    return fact_join(p["refund"], p["order"], [("order_id", "oi_id")], "inner", gap, "oi_et" if "oi_et" in p["order"].columns else None)


def refund_requests(ods, gap=None):
    """Refund requests with the province of their order."""
    return _requested(refund_request_parts(ods), gap)


def refund_request_deltas(path, **options):
    """Refund requests as they come: a function of (row changes of a batch, batch id)."""
    def results(ods, batch_id):
        sides = {name: df.drop("et", "oi_et") for name, df in refund_request_parts(ods).items()}
        return DeltaJoin(path, sides, {"refund": {"order_id": "order_id"}, "order": {"order_id": "oi_id"}},
                         _requested, **options).results(sides, batch_id)
    return results


def with_refund_names(joined, dic):
    """Refund requests with the names of their type and reason."""
    joined = lookup_inner(joined, dic, "refund_type_code", "dic_code", {"info.dic_name": "refund_type_name"})
    joined = lookup_inner(joined, dic, "refund_reason_type_code", "dic_code",
                          {"info.dic_name": "refund_reason_type_name"})
    return joined.withColumn("date_id", _day("create_time")).select(*S.ORDER_REFUND)


def order_refund(ods, dic, gap=None):
    """Refund requests with the province of their order and the names of their codes."""
    return with_refund_names(refund_requests(ods, gap), dic)


def refund_payment_parts(ods):
    """Payments of refunds, paid requests and refunded orders."""
    paid = branch(ods, "refund_payment", "update", {
        "id": "id", "order_id": "order_id", "sku_id": "sku_id", "payment_type_code": "payment_type",
        "callback_time": "callback_time", "refund_amount": "total_amount"},
        where=changed_to("refund_status", S.PAYMENT_DONE))
    request = _without_time(branch(ods, "order_refund_info", "update", {
        "ri_order_id": "order_id", "ri_sku_id": "sku_id", "refund_num": "refund_num"}, keep=(),
        where=changed_to("refund_status", S.REFUND_REQUEST_PAID)), "ri")
    order = _without_time(branch(ods, "order_info", "update", {
        "oi_id": "id", "user_id": "user_id", "province_id": "province_id"}, keep=(),
        where=changed_to("order_status", S.ORDER_REFUNDED)), "oi")
    return {"paid": paid, "request": request, "order": order}


def _paid_out(p, gap=None):
    timed = "oi_et" in p["order"].columns
    joined = fact_join(p["paid"], p["request"], [("order_id", "ri_order_id"), ("sku_id", "ri_sku_id")],
                       "inner", gap, "ri_et" if timed else None)
    return fact_join(joined, p["order"], [("order_id", "oi_id")], "inner", gap, "oi_et" if timed else None)


def refunds_paid(ods, gap=None):
    """Refunds that were paid out, without names."""
    return _paid_out(refund_payment_parts(ods), gap)


def refunds_paid_deltas(path, **options):
    """Refunds paid out, as they come: a function of (row changes of a batch, batch id)."""
    key = {"paid": {"order_id": "order_id"}, "request": {"order_id": "ri_order_id"}, "order": {"order_id": "oi_id"}}

    def results(ods, batch_id):
        sides = {name: df.drop("et", "ri_et", "oi_et") for name, df in refund_payment_parts(ods).items()}
        return DeltaJoin(path, sides, key, _paid_out, **options).results(sides, batch_id)
    return results


def with_refund_payment_names(joined, dic):
    """Paid refunds with the name of the payment type."""
    joined = lookup_inner(joined, dic, "payment_type_code", "dic_code", {"info.dic_name": "payment_type_name"})
    return joined.withColumn("date_id", _day("callback_time")).select(*S.REFUND_PAY)


def refund_pay(ods, dic, gap=None):
    """Refunds that were paid out, with the name of the payment type."""
    return with_refund_payment_names(refunds_paid(ods, gap), dic)


def cart_additions(ods):
    """Items put in carts."""
    return cart_add(ods).select(*S.CART_ADD)


def comment_rows(ods):
    """Comments, without names."""
    return branch(ods, "comment_info", ["insert", "update"],
                  ["id", "user_id", "sku_id", "appraise", "comment_txt"])


def with_appraisal_names(rows, dic):
    """Comments with the name of their appraisal."""
    named = lookup_inner(rows, dic, "appraise", "dic_code", {"info.dic_name": "appraise_name"})
    return named.select(*S.COMMENT)


def comments(ods, dic):
    """Comments with the name of their appraisal."""
    return with_appraisal_names(comment_rows(ods), dic)
