"""DuckDB SQL for the registered queries, written against the base tables."""

STAMP = "'%Y-%m-%d %H:%M:%S'"
DAY = "'%Y-%m-%d'"
ID = "l_orderkey || '-' || l_linenumber"
PRICE = "cast(l_extendedprice as decimal(16,2))"
QTY = "cast(l_quantity as decimal(16,2))"
ACT = f"case when l_discount >= 0.05 then {PRICE} * cast(l_discount as decimal(16,2)) end"
COU = f"case when l_returnflag = 'R' then {PRICE} * cast(l_tax as decimal(16,2)) end"


def text(expr):
    return f"cast({expr} as varchar)"


def seconds(expr):
    return f"cast(epoch({expr}) as bigint)"


# --- trade --------------------------------------------------------------------

D_ET = "o_orderdate + interval (6 * l_linenumber) minute"

DETAIL = f"""
act as (select {ID} as act_id, min(l_suppkey) as a from lineitem where l_discount >= 0.05 group by 1),
cou as (select {ID} as cou_id, min(l_partkey) as p from lineitem where l_returnflag = 'R' group by 1),
detail as (
  select {ID} as id, {text('l_orderkey')} as order_id, {text('o_custkey')} as user_id,
    {text('l_partkey')} as sku_id, p_name as sku_name, {text('c_nationkey')} as province_id,
    {text('a')} as activity_id, {text('a % 3')} as activity_rule_id, {text('p % 7')} as coupon_id,
    strftime({D_ET}, {DAY}) as date_id, strftime({D_ET}, {STAMP}) as create_time,
    {text('cast(l_quantity as int)')} as sku_num,
    {text(f'{QTY} * {PRICE}')} as split_original_amount, {text(ACT)} as split_activity_amount,
    {text(COU)} as split_coupon_amount, {text(PRICE)} as split_total_amount, {seconds(D_ET)} as ts
  from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
    join customer on o_custkey = c_custkey
    left join act on {ID} = act_id left join cou on {ID} = cou_id)"""

DETAIL_COLUMNS = ("id, order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id, coupon_id")
AMOUNT_COLUMNS = "split_original_amount, split_activity_amount, split_coupon_amount"

DIC = "dic as (select * from (values ('1','URGENT'),('2','HIGH'),('3','MEDIUM'),('5','LOW')) v(code, name))"
PRIORITY = "substr(o_orderpriority, 1, 1)"
PAY_ET = "o_orderdate + interval 36 minute - interval (case when o_orderkey % 2 = 1 then 5 else 0 end) second"
PAID = f"""paid as (select {text('o_orderkey')} as pay_order, {PRIORITY} as code, {PAY_ET} as pay_et
  from orders where o_orderstatus = 'O')"""

REFUND = """refund as (
  select o.*, c_nationkey, l_orderkey, l_partkey, ln, qty, price from (
    select l_orderkey, l_partkey, min(l_linenumber) as ln, min(l_quantity) as qty, min(l_extendedprice) as price
    from lineitem group by all) l
  join orders o on o_orderkey = l_orderkey join customer on o_custkey = c_custkey where o_orderstatus = 'P')"""

CART = f"""cart as (
  select {ID} as id, {text('l_suppkey')} as user_id, {text('l_partkey')} as sku_id, cast(l_quantity as int) as qty,
    case when l_linenumber = 1 then 'insert' else 'update' end as type,
    case when l_linenumber <> 1 and l_partkey % 10 <> 0 then l_partkey % 25 end as old_qty,
    {seconds('l_shipdate')} as ts
  from lineitem)"""

# --- logs ---------------------------------------------------------------------

LOG = f"""
ev as (select *, cast(regexp_extract(props, '"k": *([0-9]+)', 1) as int) as k, epoch_us(ts) // 1000 as ms from events),
raw as (
  select *, '{{"common":{{"mid":"' || user_id || '","vc":"v' || k % 3 || '","ch":"c' || k % 2 || '","ar":"'
    || user_id % 5 || '","is_new":"' || k % 2 || '","sid":"' || user_id || '-' || k % 4 || '"}}'
    || case event_type when 'signup' then ',"start":{{"entry":"icon","k":' || k || '}}'
       else ',"page":{{"page_id":"' || case event_type when 'click' then 'good_detail' when 'purchase' then 'payment'
         else 'home' end || '"' || case when k < 20 then '' else ',"last_page_id":"home"' end
         || ',"during_time":"' || cast(cast(value as decimal(16,2)) * 100 as bigint) || '"}}' end
    || case event_type when 'error' then ',"err":{{"code":' || k || '}}' else '' end
    || case event_type when 'purchase' then ',"displays":[{{"pos":0}},{{"pos":1}}],"actions":[{{"id":' || k || '}}]'
       else '' end
    || ',"ts":' || ms || '}}' as full_text
  from ev),
log as (
  select {text('user_id')} as mid, 'v' || k % 3 as vc, 'c' || k % 2 as ch, {text('user_id % 5')} as ar,
    {text('k % 2')} as is_new, user_id || '-' || k % 4 as sid, event_type, k, ms as ts,
    strftime(make_timestamp(ms * 1000), {DAY}) as day,
    case event_type when 'signup' then null when 'click' then 'good_detail' when 'purchase' then 'payment'
      else 'home' end as page_id,
    case when event_type <> 'signup' and k >= 20 then 'home' end as last_page_id,
    case when event_type <> 'signup' then cast(cast(value as decimal(16,2)) * 100 as bigint) end as during_time
  from ev where k <> 13),
fixed as (
  select * replace (case when is_new = '1' and day = first_value(day) over w and first_value(is_new) over w = '1'
    then '1' else '0' end as is_new)
  from log window w as (partition by mid order by ts, is_new desc
    rows between unbounded preceding and unbounded following)),
pages as (select * from fixed where event_type <> 'signup')"""

PAGE_COLUMNS = f"mid, is_new, sid, page_id, last_page_id, {text('during_time')} as during_time"


def bounds(start, length):
    at = f"make_timestamp(({start}) * 1000)"
    end = f"make_timestamp(({start} + {length * 1000}) * 1000)"
    return (f"strftime({at}, {STAMP}) as stt, strftime({end}, {STAMP}) as edt, strftime({at}, {DAY}) as cur_date")


def traffic(source, closed=""):
    return f"""with {LOG}, flagged as (
      select *, row_number() over (partition by mid, day order by ts, vc, ch, ar, is_new) = 1 as uv,
        ts - ts % 10000 as start from {source} where event_type <> 'signup')
    select {bounds('start', 10)}, vc, ch, ar, is_new, cast(sum(uv::int) as bigint) as uv_ct,
      cast(sum((last_page_id is null)::int) as bigint) as sv_ct, count(*) as pv_ct,
      cast(sum(during_time) as bigint) as dur_sum
    from flagged {closed} group by start, vc, ch, ar, is_new"""


def home_detail(closed=""):
    return f"""with {LOG}, flagged as (
      select *, row_number() over (partition by mid, page_id, day order by ts) = 1 as uv,
        ts - ts % 10000 as start from pages where page_id in ('home', 'good_detail'))
    select {bounds('start', 10)}, cast(sum((uv and page_id = 'home')::int) as bigint) as home_uv_ct,
      cast(sum((uv and page_id <> 'home')::int) as bigint) as good_detail_uv_ct
    from flagged {closed} group by start"""


SEARCH = f"""
clicks as (
  select text as item, k, epoch_us(ts) // 1000 as ms from (
    select *, event_id % (select count(*) from documents) as doc,
      cast(regexp_extract(props, '"k": *([0-9]+)', 1) as int) as k
    from events where event_type = 'click') join documents on doc = doc_id),
words as (
  select ms, unnest(list_distinct(list_filter(regexp_split_to_array(lower(item), '[^\\pL\\pN]+'),
    lambda x: x <> ''))) as keyword
  from clicks where k % 2 = 0)"""


def keywords(length):
    return f"""with {SEARCH}, cut as (select keyword, ms - ms % {length * 1000} as start from words)
    select {bounds('start', length)}, keyword, count(*) as keyword_count from cut group by start, keyword"""


RECORDS = f"""with {LOG}, parts as (
  select *, '"common":{{"mid":"' || mid || '","vc":"' || vc || '","ch":"' || ch || '","ar":"' || ar || '","sid":"' || sid
      || '","is_new":"' || is_new || '"}}' as common,
    ',"page":{{"page_id":"' || page_id || '"' || case when last_page_id is null then '' else ',"last_page_id":"home"' end
      || ',"during_time":"' || during_time || '"}}' as page
  from fixed)
select 'dwd_err' as topic, '{{"code":' || k || '}}' as value from parts where event_type = 'error'
union all select 'dwd_start', '{{' || common || ',"start":{{"entry":"icon","k":' || k || '}},"ts":' || ts || '}}' from parts
  where event_type = 'signup'
union all select 'dwd_page', '{{' || common || page || ',"ts":' || ts || '}}' from parts where event_type <> 'signup'
union all select 'dwd_display', '{{' || common || page || ',"ts":' || ts || ',"display":{{"pos":' || unnest([0, 1]) || '}}}}'
  from parts where event_type = 'purchase'
union all select 'dwd_action', '{{' || common || page || ',"ts":' || ts || ',"action":{{"id":' || k || '}}}}'
  from parts where event_type = 'purchase'"""

# --- products -------------------------------------------------------------------

SKU = f"""
sku as (
  select {ID} as id, {text('l_partkey')} as sku_id, {text(f'{QTY} * {PRICE}')} as split_original_amount,
    {text(ACT)} as split_activity_amount, {text(COU)} as split_coupon_amount, {text(PRICE)} as split_total_amount,
    {seconds("date_trunc('year', l_shipdate)")} + 2 * l_linenumber as ts,
    {seconds('l_shipdate')} as v1, l_partkey as v2, l_suppkey as v3
  from lineitem),
ranked as (
  select id, sku_id, ts, v1, v2, v3, lead(1) over (partition by id order by v1, v2, v3) is null as is_last,
    coalesce(cast(split_original_amount as decimal(20,4)), 0)::decimal(20,4) as original_amount,
    coalesce(cast(split_activity_amount as decimal(20,4)), 0)::decimal(20,4) as activity_reduce_amount,
    coalesce(cast(split_coupon_amount as decimal(20,4)), 0)::decimal(20,4) as coupon_reduce_amount,
    coalesce(cast(split_total_amount as decimal(20,4)), 0)::decimal(20,4) as order_amount
  from sku)"""

AMOUNTS = ["original_amount", "activity_reduce_amount", "coupon_reduce_amount", "order_amount"]

SKU_WINDOW = f"""
cut as (select *, ts * 1000 - (ts * 1000) % 10000 as start from ranked),
sums as (
  select {bounds('start', 10)}, sku_id, {', '.join(
      f'cast(sum(case when is_last then {a} else 0 end) as decimal(38,4)) as {a}' for a in AMOUNTS)}
  from cut group by start, sku_id)"""

CHAIN = """
chain as (
  select {text_part} as chain_id, p_name as sku_name, p_type as spu_id, p_brand as trademark_id,
    cast(s_suppkey as varchar) as category3_id, 'spu ' || p_type as spu_name,
    case when p_brand <> 'Brand#7' then 'tm ' || p_brand end as trademark_name,
    s_name as category3_name, cast(s_nationkey as varchar) as category2_id, n_name as category2_name,
    cast(n_regionkey as varchar) as category1_id, r_name as category1_name
  from part join supplier on p_partkey % (select count(*) from supplier) = s_suppkey
    join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey)
""".format(text_part=text("p_partkey"))

CHAIN_COLUMNS = """sku_name, spu_id, trademark_id, category3_id, spu_name, trademark_name, category3_name,
  category2_id, category2_name, category1_id, category1_name"""

# --- rules ------------------------------------------------------------------------

RULES = """rules as (
  select case p_partkey % 7 when 0 then 'd' when 1 then 'u' when 2 then 'r' else 'c' end as op,
    lower(p_type) || '_' || p_size as source_table,
    case when p_partkey % 2 = 0 then 'insert' else 'update' end as source_type, p_brand as sink_table,
    'id,name,' || lower(p_type) as sink_columns, p_partkey as seq
  from part)"""

PART_CHANGES = f"""
part_changes as (
  select {text('p_partkey')} as p_partkey, p_name, p_brand, 'insert' as type, p_partkey * 4 as seq from part
  union all select {text('p_partkey')}, null, p_brand || '-v2', 'update', p_partkey * 4 + 1 from part where p_partkey % 3 = 0
  union all select {text('p_partkey')}, null, null, 'delete', p_partkey * 4 + 2 from part where p_partkey % 5 = 0
  union all select {text('p_partkey')}, 'again', null, 'insert', p_partkey * 4 + 3 from part where p_partkey % 10 = 0),
gone as (select p_partkey as gone_key, max(seq) as gone_seq from part_changes where type = 'delete' group by 1),
live as (select * from part_changes left join gone on p_partkey = gone_key
  where type <> 'delete' and seq > coalesce(gone_seq, -1)),
merged as (
  select p_partkey as row_key, max(p_partkey) as p_partkey, arg_max(p_name, seq) filter (p_name is not null) as p_name,
    arg_max(p_brand, seq) filter (p_brand is not null) as p_brand
  from live group by 1)"""

SQL = {
    "src_text_topic": f"""with {LOG} select case when k = 13 then substr(full_text, 1, length(full_text) // 2)
        else full_text end as value from raw""",
    "src_json_topic": "select o_orderkey, o_orderpriority, cast(null as varchar) as o_comment from orders",
    "ods_envelope": f"""with {CART} select 'shop' as database, 'cart_info' as "table", type, id, {text('qty')} as sku_num,
        {text('old_qty')} as old_num, ts, strftime(make_timestamp(ts * 1000000), {STAMP}) as et from cart""",
    "page_log": f"""with {SEARCH} select item, case when k % 2 = 0 then 'keyword' else 'sku_id' end as item_type,
        cast(null as varchar) as missing, ms as ts,
        strftime(make_timestamp(ms * 1000), '%Y-%m-%d %H:%M:%S.%g') as et from clicks""",
    "order_detail_source": f"""with {DETAIL} select id, order_id, activity_id, split_original_amount, ts,
        create_time as et from detail""",
    "rule_changes": f"with {RULES} select op, source_table, source_type, sink_table, sink_columns, seq from rules",
    "rule_snapshot": """select 'r' as op, 'tbl_' || p_partkey as source_table, 'insert' as source_type,
        p_brand as sink_table, 'id,name' as sink_columns, cast(-1 as bigint) as seq from part""",
    "dim_dic": f"select distinct {PRIORITY} as dic_code, substr(o_orderpriority, 3) as dic_name from orders",
    "valid_changes": f"""with {CART} select 'cart_info' as "table", type, id, {text('qty')} as sku_num, ts from cart
        where (ts // 86400) % 7 <> 0 and (ts // 86400) % 5 <> 0 and qty not in (7, 8)""",
    "ods_branch": f"""select {text('o_orderkey')} as id, {text('o_custkey')} as buyer, {text('c_nationkey')} as province_id,
        {seconds('o_orderdate')} as ts from orders join customer on o_custkey = c_custkey""",
    "status_transition": f"""
        select {text('o_orderkey')} as id, strftime(o_orderdate + interval 1 hour, {STAMP}) as operate_time,
          '1003' as order_status, {seconds('o_orderdate')} + 3600 as ts
        from orders join customer on o_custkey = c_custkey where o_orderstatus = 'F'
        union all
        select {text('o_orderkey')}, strftime(o_orderdate + interval 1 hour, {STAMP}), '1006',
          {seconds('o_orderdate')} + 7200
        from orders join customer on o_custkey = c_custkey where o_orderstatus = 'P' and o_orderkey % 2 = 0""",
    "search_events": f"""with {SEARCH} select item, strftime(make_timestamp(ms * 1000), '%Y-%m-%d %H:%M:%S.%g') as et
        from clicks where k % 2 = 0""",
    "rule_project": f"""with {PART_CHANGES} select type, seq, p_partkey, p_name, p_brand,
        cast(null as varchar) as p_size, 'missing_col,p_brand,p_name,p_partkey' as columns from part_changes""",
    "camel_columns": 'select s_suppkey as "suppKey", s_name as "suppLongName" from supplier',
    "sink_json_rows": """select '{"order_key":"' || o_orderkey || '","order_status":"' || o_orderstatus
        || '","cust_key":' || o_custkey || '}' as value from orders""",
    "log_dirty": f"with {LOG} select substr(full_text, 1, length(full_text) // 2) as value from raw where k = 13",
    "log_clean": f"""with {LOG} select mid, vc, ch, ar, is_new, sid, page_id,
        case when event_type = 'signup' then '{{"entry":"icon","k":' || k || '}}' end as start,
        case when event_type = 'error' then '{{"code":' || k || '}}' end as err,
        case when event_type = 'purchase' then '{{"pos":0}};{{"pos":1}}' end as displays,
        case when event_type = 'purchase' then '{{"id":' || k || '}}' end as actions, ts from log""",
    "fix_is_new": f"with {LOG} select mid, is_new, ts from fixed",
    "log_records": RECORDS,
    "log_err": f"with {LOG} select '{{\"code\":' || k || '}}' as err from fixed where event_type = 'error'",
    "log_start": f"""with {LOG} select mid, is_new, '{{"entry":"icon","k":' || k || '}}' as start, ts
        from fixed where event_type = 'signup'""",
    "log_page": f"with {LOG} select {PAGE_COLUMNS}, ts from pages",
    "log_display": f"""with {LOG} select {PAGE_COLUMNS}, unnest(['{{"pos":0}}', '{{"pos":1}}']) as display, ts
        from pages where event_type = 'purchase'""",
    "log_action": f"""with {LOG} select {PAGE_COLUMNS}, '{{"id":' || k || '}}' as action, ts
        from pages where event_type = 'purchase'""",
    "join_inner": f"""select {ID} as id, {text('l_orderkey')} as order_id, {text('l_partkey')} as sku_id, {seconds(D_ET)} as ts,
        {text('o_custkey')} as user_id
        from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
          join customer on o_custkey = c_custkey""",
    "join_left": f"""with {DETAIL} select id, sku_id, ts, coupon_id from detail""",
    "interval_join": f"""with {PAID}, d as (
          select {ID} as id, {text('l_orderkey')} as order_id, {D_ET} as d_et
          from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey)
        select id, order_id, {seconds('d_et')} as order_s, {seconds('pay_et')} as pay_s from d join paid on order_id = pay_order
        where d_et between pay_et - interval 30 minute and pay_et + interval 5 second""",
    "lookup_inner": f"""with {DIC} select {text('o_orderkey')} as id, {PRIORITY} as code, name
        from orders join dic on {PRIORITY} = code""",
    "lookup_left": f"""with {DIC} select {text('o_orderkey')} as id, {PRIORITY} as code, name
        from orders left join dic on {PRIORITY} = dic.code""",
    "lookup_chain": f"""with {CHAIN} select {ID} as id, {text('l_partkey')} as sku_id, l_suppkey, {CHAIN_COLUMNS}
        from lineitem left join chain on {text('l_partkey')} = chain_id""",
    "rule_connect_dim": f"""with {PART_CHANGES} select p_partkey, type, seq, 'dim_part' as sink_table,
        'p_partkey' as sink_row_key from part_changes""",
    "split_word": r"""select doc_id, unnest(list_distinct(list_filter(
        regexp_split_to_array(lower(text), '[^\pL\pN]+'), lambda x: x <> ''))) as word from documents""",
    "split_keyword_counts": r"""select keyword, count(*) as n from (select unnest(list_distinct(list_filter(
        regexp_split_to_array(lower(text), '[^\pL\pN]+'), lambda x: x <> ''))) as keyword from documents) group by keyword""",
    "rules_current": f"""with {RULES} select source_table, source_type, sink_table, sink_columns from rules
        qualify row_number() over (partition by source_table, source_type order by seq desc) = 1 and op <> 'd'""",
    "upsert_latest": f"""with {SKU} select * from sku
        qualify row_number() over (partition by id order by v1 desc, v2 desc, v3 desc) = 1""",
    "uv_first_of_day": f"""with {LOG} select mid, ts,
        (row_number() over (partition by mid, day order by ts) = 1)::bigint as uv from pages""",
    "uv_by_page": f"""with {LOG} select mid, page_id, ts,
        (row_number() over (partition by mid, page_id, day order by ts) = 1)::bigint as uv from pages
        where page_id in ('home', 'good_detail')""",
    "session_flag": f"with {LOG} select mid, ts, last_page_id, (last_page_id is null)::bigint as sv_ct from pages",
    "sku_retract": f"""with {SKU}
        select id, sku_id, ts, v1, v2, v3, {', '.join(AMOUNTS)} from ranked
        union all
        select id, sku_id, ts, v1, v2, v3, {', '.join(f'(-{a})::decimal(20,4)' for a in AMOUNTS)} from ranked
        where not is_last""",
    "sku_window": f"with {SKU}, {SKU_WINDOW} select * from sums",
    "window_bounds": f"""with e as (select epoch_us(ts) // 1000 as ms, cast(value as decimal(16,2)) as v from events),
        cut as (select v, ms - ms % 10000 as start from e)
        select {bounds('start', 10)}, count(*) as n, cast(sum(v) as decimal(38,2)) as total from cut group by start""",
    "dim_sync": f"""with {PART_CHANGES} select 'dim_part' as sink_table, row_key, column_name, value from (
          select row_key, 'p_partkey' as column_name, p_partkey as value from merged
          union all select row_key, 'p_name', p_name from merged
          union all select row_key, 'p_brand', p_brand from merged) where value is not null""",
    "dim_table": f"""with {PART_CHANGES} select row_key, p_name, p_brand, cast(null as varchar) as missing_col from merged""",
    "base_db_route": f"""
        select 't_orders' as topic, '{{"type":"insert","ts":"' || {seconds('o_orderdate')} || '","o_orderkey":"'
          || o_orderkey || '","o_orderstatus":"' || o_orderstatus || '"}}' as value from orders
        union all
        select 't_items', '{{"type":"insert","ts":"' || {seconds('l_shipdate')} || '","l_orderkey":"' || l_orderkey
          || '","l_linenumber":"' || l_linenumber || '","l_returnflag":"' || l_returnflag || '"}}' from lineitem""",
    "dwd_comment_info": f"""with {DIC} select {text('doc_id')} as id, {text('doc_id % 100')} as user_id,
        {text('doc_id % 50')} as sku_id, {text('quality')} as appraise, name as appraise_name, source as comment_txt,
        1700000000 + doc_id as ts
        from labels join documents using (doc_id) join dic on {text('quality')} = code""",
    "dwd_cart_add": f"""with {CART} select id, user_id, sku_id,
        {text("case when type = 'insert' then qty else qty - old_qty end")} as sku_num, ts
        from cart where type = 'insert' or qty > old_qty""",
    "dwd_order_detail": f"with {DETAIL} select * from detail",
    "dwd_order_cancel": f"""with {DETAIL} select {DETAIL_COLUMNS}, strftime(o_orderdate + interval 1 hour, {DAY}) as date_id,
        strftime(o_orderdate + interval 1 hour, {STAMP}) as cancel_time, sku_num, {AMOUNT_COLUMNS}, split_total_amount,
        {seconds('o_orderdate')} + 3600 as ts
        from detail join orders on order_id = {text('o_orderkey')} where o_orderstatus = 'F'""",
    "dwd_pay_success": f"""with {DETAIL}, {DIC}, {PAID} select id as order_detail_id, {DETAIL_COLUMNS.replace('id, ', '', 1)},
        paid.code as payment_type_code, dic.name as payment_type_name, strftime(pay_et, {STAMP}) as callback_time, sku_num,
        {AMOUNT_COLUMNS}, split_total_amount as split_payment_amount, {seconds('pay_et')} as ts
        from detail join paid on order_id = pay_order join dic on paid.code = dic.code
        where detail.ts between {seconds('pay_et')} - 1800 and {seconds('pay_et')} + 5""",
    "dwd_order_refund": f"""with {DIC}, {REFUND} select l_orderkey || '-' || l_partkey as id, {text('o_custkey')} as user_id,
        {text('l_orderkey')} as order_id, {text('l_partkey')} as sku_id, {text('c_nationkey')} as province_id,
        strftime(o_orderdate + interval 2 hour, {DAY}) as date_id,
        strftime(o_orderdate + interval 2 hour, {STAMP}) as create_time, {PRIORITY} as refund_type_code,
        d1.name as refund_type_name, {text('ln % 3')} as refund_reason_type_code, d2.name as refund_reason_type_name,
        'line ' || ln as refund_reason_txt, {text('cast(qty as int)')} as refund_num,
        {text('cast(price as decimal(16,2))')} as refund_amount, {seconds('o_orderdate')} + 7200 as ts
        from refund join dic d1 on {PRIORITY} = d1.code join dic d2 on {text('ln % 3')} = d2.code""",
    "dwd_refund_pay": f"""with {DIC}, {REFUND} select l_orderkey || '-' || l_partkey as id, {text('o_custkey')} as user_id,
        {text('l_orderkey')} as order_id, {text('l_partkey')} as sku_id, {text('c_nationkey')} as province_id,
        {PRIORITY} as payment_type_code, name as payment_type_name,
        strftime(o_orderdate + interval 3 hour, {DAY}) as date_id,
        strftime(o_orderdate + interval 3 hour, {STAMP}) as callback_time, {text('cast(qty as int)')} as refund_num,
        {text('cast(price as decimal(16,2))')} as refund_amount, {seconds('o_orderdate')} + 10800 as ts
        from refund join dic on {PRIORITY} = code where o_orderkey % 2 = 0""",
    "dws_keyword_window": keywords(5),
    "dws_keyword_window_10s": keywords(10),
    "dws_traffic_window": traffic("fixed"),
    "dws_home_detail": home_detail(),
    "dws_sku_order": f"""with {SKU}, {SKU_WINDOW}, {CHAIN} select stt, edt, cur_date, trademark_id, trademark_name,
        category1_id, category1_name, category2_id, category2_name, category3_id, category3_name, sku_id, sku_name,
        spu_id, spu_name, {', '.join(AMOUNTS)} from sums left join chain on sku_id = chain_id""",
    "stream_fix_is_new": f"with {LOG} select mid, is_new, ts from fixed",
    "uv_stream": f"""with {LOG} select mid, ts,
        (row_number() over (partition by mid, day order by ts) = 1)::bigint as uv from pages""",
    "late_drop": f"""with {LOG}, cut as (select ms - ms % 10000 as start from ev where k <> 13)
        select {bounds('start', 10)}, count(*) as n from cut group by start""",
    "rule_ddl": f"""with {PART_CHANGES} select row_key, merged.p_name,
          case when part.p_partkey % 10 <> 0 then {text('p_size')} end as p_size
        from merged join part on row_key = {text('part.p_partkey')}""",
}

# Streams give the rows of the batch form.
STREAMS = {
    "stream_traffic_window": "dws_traffic_window", "stream_home_detail": "dws_home_detail",
    "stream_sku_window": "sku_window", "stream_sku_order": "dws_sku_order", "stream_keyword_window": "dws_keyword_window",
    "stream_upsert_latest": "upsert_latest", "stream_keyed_table": "upsert_latest", "stream_base_db_route": "base_db_route", "stream_dim_sync": "dim_sync",
    "stream_pay_success": "dwd_pay_success",
    "rule_views": "rule_ddl", "stream_order_detail": "dwd_order_detail", "stream_order_cancel": "dwd_order_cancel", "stream_order_refund": "dwd_order_refund",
    "stream_refund_pay": "dwd_refund_pay", "stream_comment_info": "dwd_comment_info", "stream_cart_add": "dwd_cart_add",
}
SQL.update({stream: SQL[batch] for stream, batch in STREAMS.items()})
SQL["stream_log_records"] = f"{SQL['log_records']} union all select 'dwd_dirty', value from ({SQL['log_dirty']})"
