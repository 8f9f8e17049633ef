"""Schemas of envelopes and outputs."""

# --- fixed values: envelopes ------------------------------------------------

# Row change: `old` holds only the columns that changed; `ts` is in seconds.
CDC = ("database string, table string, type string, "
       "data map<string,string>, old map<string,string>, ts bigint")

# App log. `common` and `page` stay maps so that fields nobody declared survive;
# `start`, `err` and the array elements stay raw JSON text. `ts` (milliseconds)
# may arrive as a number or as text.
LOG = ("common map<string,string>, page map<string,string>, start string, err string, "
       "displays array<string>, actions array<string>, ts string")

PAGE = "common map<string,string>, page map<string,string>, ts string"

# Change of a routing rule: `before` is filled for deletes, `after` otherwise.
DIM_RULE = ("source_table string, sink_table string, sink_columns string, "
            "sink_family string, sink_row_key string")
DWD_RULE = "source_table string, source_type string, sink_table string, sink_columns string"

CHANGE_TYPES = ["insert", "bootstrap-insert", "update", "delete"]

# --- fixed values: output columns, in insert order --------------------------

ORDER_DETAIL = ["id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id",
                "activity_rule_id", "coupon_id", "date_id", "create_time", "sku_num",
                "split_original_amount", "split_activity_amount", "split_coupon_amount",
                "split_total_amount", "ts"]

ORDER_CANCEL = ["id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id",
                "activity_rule_id", "coupon_id", "date_id", "cancel_time", "sku_num",
                "split_original_amount", "split_activity_amount", "split_coupon_amount",
                "split_total_amount", "ts"]

PAY_SUCCESS = ["order_detail_id", "order_id", "user_id", "sku_id", "sku_name", "province_id",
               "activity_id", "activity_rule_id", "coupon_id", "payment_type_code",
               "payment_type_name", "callback_time", "sku_num", "split_original_amount",
               "split_activity_amount", "split_coupon_amount", "split_payment_amount", "ts"]

ORDER_REFUND = ["id", "user_id", "order_id", "sku_id", "province_id", "date_id", "create_time",
                "refund_type_code", "refund_type_name", "refund_reason_type_code",
                "refund_reason_type_name", "refund_reason_txt", "refund_num", "refund_amount", "ts"]

REFUND_PAY = ["id", "user_id", "order_id", "sku_id", "province_id", "payment_type_code",
              "payment_type_name", "date_id", "callback_time", "refund_num", "refund_amount", "ts"]

CART_ADD = ["id", "user_id", "sku_id", "sku_num", "ts"]

COMMENT = ["id", "user_id", "sku_id", "appraise", "appraise_name", "comment_txt", "ts"]

KEYWORD_WINDOW = ["stt", "edt", "cur_date", "keyword", "keyword_count"]

TRAFFIC_WINDOW = ["stt", "edt", "cur_date", "vc", "ch", "ar", "is_new",
                  "uv_ct", "sv_ct", "pv_ct", "dur_sum"]

HOME_DETAIL_WINDOW = ["stt", "edt", "cur_date", "home_uv_ct", "good_detail_uv_ct"]

SKU_ORDER_WINDOW = ["stt", "edt", "cur_date", "trademark_id", "trademark_name", "category1_id",
                    "category1_name", "category2_id", "category2_name", "category3_id",
                    "category3_name", "sku_id", "sku_name", "spu_id", "spu_name",
                    "original_amount", "activity_reduce_amount", "coupon_reduce_amount",
                    "order_amount"]

SKU_AMOUNTS = {"split_original_amount": "original_amount",
               "split_activity_amount": "activity_reduce_amount",
               "split_coupon_amount": "coupon_reduce_amount",
               "split_total_amount": "order_amount"}

# Status codes of the trade tables.
ORDER_CREATED, ORDER_CANCELLED = "1001", "1003"
ORDER_REFUND_ASKED, ORDER_REFUNDED = "1005", "1006"
PAYMENT_DONE, REFUND_REQUEST_PAID = "1602", "0705"
