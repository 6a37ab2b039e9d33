"""Comparison SQL (DuckDB) for the named queries."""

from __future__ import annotations

_STARTS = """
starts as (
  select user_id as mid, event_id, event_type, ts,
         strftime(ts, '%Y-%m-%d') as log_date, strftime(ts, '%H') as log_hour
  from events),
first as (
  select * from (
    select *, row_number() over (partition by mid, log_date order by ts, event_id) as rn
    from starts) where rn = 1)
"""

_LOG_STARTS = """
lines as (
  select *, strftime(ts, '%Y-%m-%d') as log_date, strftime(ts, '%H') as log_hour
  from events where event_type = 'signup'),
first as (
  select * from (
    select *, row_number() over (partition by user_id, log_date
                                 order by epoch_us(ts) // 1000, event_id) as rn
    from lines) where rn = 1)
"""

_SALES = """
line as (
  select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as order_detail_id,
         case when l_linenumber = 7 then -l_orderkey else l_orderkey end as order_id,
         l_partkey as sku_id, p_name as sku_name,
         l_extendedprice as sku_price, l_shipdate
  from lineitem left join part on l_partkey = p_partkey),
ord as (
  select o_orderkey as order_id, o_orderstatus as order_status,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as create_time,
         case when o_orderkey % 10 = 3 then -o_custkey else o_custkey end as user_id,
         strftime(o_orderdate, '%Y-%m-%d') as dt, o_orderdate
  from orders),
usr as (
  select c_custkey as user_id, case when c_custkey % 2 = 0 then 'M' else 'F' end as user_gender,
         c_mktsegment as user_level,
         date '1965-01-01' + cast(c_custkey * 37 % 16000 as integer) as birthday
  from customer),
sale as (
  select order_detail_id, line.order_id, order_status, create_time, ord.user_id, sku_id,
         user_gender,
         cast(coalesce(date_diff('day', birthday, date '2001-08-01') // 365, 0) as integer)
           as user_age,
         user_level, sku_price, sku_name, dt
  from line join ord on line.order_id = ord.order_id left join usr on ord.user_id = usr.user_id)
"""

_HITS = _SALES + """,
hits as (
  select * from sale
  where list_contains(regexp_extract_all(lower(sku_name), '[a-z0-9]+'), 'red')
    and list_contains(regexp_extract_all(lower(sku_name), '[a-z0-9]+'), 'widget'))
"""

_DAY_HITS = _SALES + """,
hits as (
  select * from sale
  where dt = '1998-10-03'
    and list_contains(regexp_extract_all(lower(sku_name), '[a-z0-9]+'), 'red'))
"""

_SHARES = """
tot as (select count(*) as total from hits),
gender as (
  select user_gender as k, count(*) as n from hits where user_gender is not null
  group by 1 order by 2 desc, 1 limit 2),
age as (
  select user_age as k, count(*) as n from hits where user_age is not null
  group by 1 order by 2 desc, 1 limit 100),
stats as (
  select '性别占比' as title, '男' as name,
         (select count(*) from hits where user_gender = 'M') as n
  union all select '性别占比', '女', (select count(*) from hits where user_gender = 'F')
  union all select '年龄段占比', '20岁以下', (select count(*) from hits where user_age < 20)
  union all select '年龄段占比', '20岁到30岁',
         (select count(*) from hits where user_age between 20 and 30)
  union all select '年龄段占比', '30岁以上', (select count(*) from hits where user_age > 30)),
shares as (
  select title, name, total,
         case when total > 0 then floor(coalesce(n, 0) * 1000.0 / total + 0.5) / 10.0
              else 0.0 end::double as value
  from stats, tot)
"""


def _windows(width_s: int, slide_s: int, accounts: int) -> str:
    """Windows as (start, start + width] in epoch microseconds, one row per event and window."""
    copies = width_s // slide_s
    return f"""
ev as (
  select cast(floor(user_id / 15) as bigint) as mid, cast(user_id as varchar) as uid,
         case event_type when 'purchase' then 'coupon' when 'click' then 'clickItem'
              else event_type end as evid,
         json_extract_string(props, '$.k') as itemid, epoch_us(ts) as us
  from events),
win as (
  select *, (us // {slide_s * 1000000} - i) * {slide_s * 1000000} + {width_s * 1000000} as end_us
  from ev, (select unnest(range(0, {copies})) as i)),
prof as (
  select mid, end_us // 1000 as window_end,
         coalesce(string_agg(distinct uid order by uid) filter (evid = 'coupon'), '') as uids,
         coalesce(string_agg(distinct itemid order by itemid) filter (evid = 'coupon'), '')
           as item_ids,
         string_agg(evid, ',' order by evid) as events,
         bool_or(evid = 'clickItem') as clicked,
         count(distinct case when evid = 'coupon' then uid end) as accounts
  from win group by mid, end_us),
alert as (select * from prof where accounts >= {accounts} and not clicked)
"""


_DOCS = """,
docs as (
  select mid || '_' || (window_end // 60000) as alert_id, *,
         row_number() over (partition by mid, window_end // 60000 order by window_end desc) as rn
  from alert)
select alert_id, mid, uids, item_ids, events, window_end as ts,
       strftime(make_timestamp(window_end * 1000), '%Y-%m-%d') as alert_date
from docs where rn = 1
"""

_CHANGES = """
routed as (
  select case when o_orderstatus in ('O', 'P') or o_orderkey % 10 = 7 then null else 'order' end as topic,
         '{"id":"' || o_orderkey || '","user_id":"' || o_custkey || '","order_status":"'
         || o_orderstatus || '","total_amount":"' || o_totalprice || '","create_time":"'
         || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '"}' as value
  from orders
  union all
  select case when l_returnflag = 'R' then null else 'order_detail' end,
         '{"id":"' || concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)
         || '","order_id":"' || l_orderkey || '","sku_id":"' || l_partkey
         || '","order_price":"' || l_extendedprice || '","sku_num":"' || l_quantity || '"}'
  from lineitem
  union all
  select 'user_info', '{"id":"' || c_custkey || '","login_name":"' || c_name
         || '","user_level":"' || c_mktsegment || '"}'
  from customer)
"""

_LOG_LINES = """
stamped as (
  select event_id, ts, case when event_type = 'signup' then 'start' else 'event' end as topic,
         '{' || case when event_type = 'signup' then '"type":"startup",'
                     when event_type = 'error' then '' else '"type":"event",' end
         || '"mid":' || user_id || ',"uid":' || user_id || ',"evid":"' || event_type
         || '","itemid":' || json_extract_string(props, '$.k')
         || ',"ts":' || (epoch_us(ts) // 1000) || '}' as value
  from events)
"""

_HOURS_OF_DEVICES = f"""
with {_STARTS},
spine as (select lpad(cast(unnest(range(0, 24)) as varchar), 2, '0') as log_hour)
select spine.log_hour,
       count(mid) filter (log_date = '2024-01-08') as yesterday,
       count(mid) filter (log_date = '2024-01-09') as today
from spine left join first
  on first.log_hour = spine.log_hour and log_date in ('2024-01-08', '2024-01-09')
group by spine.log_hour"""

_HOURS_OF_AMOUNTS = """
with paid as (
  select strftime(ts, '%Y-%m-%d') as d, strftime(ts, '%H') as h, value
  from events where event_type = 'purchase'),
spine as (select lpad(cast(unnest(range(0, 24)) as varchar), 2, '0') as log_hour)
select log_hour,
       round(coalesce(sum(value) filter (d = '2024-01-08'), 0.0), 2) as yesterday,
       round(coalesce(sum(value) filter (d = '2024-01-09'), 0.0), 2) as today
from spine left join paid on h = log_hour
group by log_hour"""

ORACLE: dict[str, str] = {
    "dau_first_seen": f"""
with {_STARTS}
select mid, mid as uid, event_type as log_type, log_date, log_hour, event_id, epoch_us(ts) // 1000 as ts
from first""",

    "dau_total": f"""
with {_STARTS} select count(mid) as ct from first where log_date = '2024-01-09'""",

    "dau_hour": f"""
with {_STARTS}
select log_hour, count(mid) as ct from first where log_date = '2024-01-09' group by log_hour""",

    "dau_per_day": f"""
with {_STARTS} select log_date, count(mid) as ct from first group by log_date""",

    "dau_unseen": f"""
with {_STARTS},
late as (
  select * from (
    select *, row_number() over (partition by mid, log_date order by ts, event_id) as lrn
    from starts where hour(ts) >= 12) where lrn = 1)
select mid, log_date, log_hour, event_id from late
where not exists (select 1 from starts s where s.mid = late.mid and s.log_date = late.log_date
                  and hour(s.ts) < 12)""",

    "dau_from_log": f"""
with {_LOG_STARTS}
select cast(user_id as varchar) as mid, cast(user_id as varchar) as uid, 'startup' as log_type,
       log_date, log_hour, epoch_us(ts) // 1000 as ts
from first""",

    "dau_table": f"""
with {_LOG_STARTS}
select cast(user_id as varchar) as "MID", cast(user_id as varchar) as "UID",
       cast(null as varchar) as "APP_ID", cast(null as varchar) as "AREA",
       cast(null as varchar) as "OS", cast(null as varchar) as "CH", 'startup' as "LOG_TYPE",
       cast(null as varchar) as "VS", log_date as "LOG_DATE", log_hour as "LOG_HOUR",
       epoch_us(ts) // 1000 as "TS"
from first""",

    "realtime_total": f"""
with {_STARTS}
select 'dau' as id, '新增日活' as name, cast(count(mid) as double) as value
from first where log_date = '2024-01-09'
union all
select 'order_amount', '新增交易额', round(coalesce(sum(value), 0.0), 2)
from events where event_type = 'purchase' and strftime(ts, '%Y-%m-%d') = '2024-01-09'""",

    "realtime_hour_dau": _HOURS_OF_DEVICES,
    "realtime_hour_amount": _HOURS_OF_AMOUNTS,

    "realtime_hour_map": f"""
with {_STARTS},
hours as (select log_date, log_hour, count(mid) as ct from first group by 1, 2)
select coalesce(string_agg(log_hour || '=' || ct, ',' order by log_hour)
         filter (log_date = '2024-01-08'), '') as yesterday,
       coalesce(string_agg(log_hour || '=' || ct, ',' order by log_hour)
         filter (log_date = '2024-01-09'), '') as today
from hours""",

    "order_clean": """
select o_orderkey as id, c_nationkey as province_id,
       substr(c_name, 1, 4) || '*******' as consignee_tel, o_orderstatus as order_status,
       case when o_orderkey % 10 = 3 then -o_custkey else o_custkey end as user_id,
       o_totalprice as total_amount,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as create_time,
       strftime(o_orderdate, '%Y-%m-%d') as create_date,
       strftime(o_orderdate, '%H') as create_hour
from orders left join customer on o_custkey = c_custkey""",

    "order_day_amount": """
select round(coalesce(sum(o_totalprice), 0.0), 2) as total_amount
from orders where strftime(o_orderdate, '%Y-%m-%d') = '1998-10-03'""",

    "order_hour_amount": """
select strftime(ts, '%H') as create_hour, round(sum(value), 2) as total_amount
from events
where event_type = 'purchase' and strftime(ts, '%Y-%m-%d') = '2024-01-09'
group by 1""",

    "sales_by_province": """
select c_nationkey as province_id, round(sum(o_totalprice), 2) as total_amount,
       count(*) as order_count,
       cast(least(count(*) // 100 * 100, 500) as bigint) as band
from orders left join customer on o_custkey = c_custkey
group by 1""",

    "sale_join": f"""
with {_SALES}
select order_detail_id, line.order_id, sku_id, sku_name, sku_price, order_status, create_time,
       user_id, dt
from line join ord on line.order_id = ord.order_id""",

    "sale_outer": f"""
with {_SALES}
select order_detail_id, coalesce(line.order_id, ord.order_id) as order_id, sku_id, sku_name,
       sku_price, order_status, create_time, user_id, dt
from line full join ord on line.order_id = ord.order_id""",

    "sale_interval": f"""
with {_SALES}
select order_detail_id, line.order_id, sku_id, sku_name, sku_price, order_status, create_time,
       user_id, dt
from line join ord on line.order_id = ord.order_id
where l_shipdate between o_orderdate - interval 30 day and o_orderdate + interval 30 day""",

    "sale_enriched": f"with {_SALES} select * from sale",

    "user_dim": """
select id, user_level, changed, change_id from (
  select o_custkey as id, o_orderpriority as user_level,
         strftime(o_orderdate, '%Y-%m-%d') as changed, o_orderkey as change_id,
         row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc)
           as rn
  from orders) where rn = 1""",

    "sale_latest": """
select order_detail_id, l_orderkey, l_partkey, l_suppkey, l_extendedprice, l_quantity, dt from (
  select concat_ws('-', l_orderkey, l_linenumber) as order_detail_id, l_orderkey, l_partkey,
         l_suppkey, l_extendedprice, l_quantity, strftime(l_shipdate, '%Y-%m-%d') as dt,
         row_number() over (partition by l_orderkey, l_linenumber
           order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_extendedprice desc,
                    l_quantity desc) as rn
  from lineitem) where rn = 1""",

    "sale_search": f"with {_HITS} select * from hits",

    "sale_page": f"with {_HITS} select * from hits order by order_detail_id limit 10 offset 10",

    "sale_total": f"with {_HITS} select count(*) as total from hits",

    "sale_gender": f"""
with {_HITS}, {_SHARES} select k as user_gender, n from gender""",

    "sale_age": f"""
with {_HITS}, {_SHARES} select k as user_age, n from age""",

    "sale_stats": f"""
with {_HITS}, {_SHARES} select title, name, value from shares""",

    "sale_detail_day": f"""
with {_DAY_HITS}, {_SHARES} select total, title, name, value from shares""",

    "sale_detail_page": f"""
with {_DAY_HITS} select * from hits order by order_detail_id limit 10""",

    "sale_detail_json": f"""
with {_HITS}, {_SHARES},
page as (select * from hits order by order_detail_id limit 2),
opts as (
  select title, '[' || string_agg('{{"name":"' || name || '","value":' || value || '}}', ','
    order by case name when '男' then 1 when '女' then 2 when '20岁以下' then 3
                       when '20岁到30岁' then 4 else 5 end) || ']' as options
  from shares group by title)
select '{{"total":' || (select total from tot) || ',"stat":['
  || (select string_agg('{{"title":"' || title || '","options":' || options || '}}', ','
        order by case title when '性别占比' then 1 else 2 end) from opts)
  || '],"detail":['
  || (select string_agg('{{"order_detail_id":"' || order_detail_id || '","order_id":' || order_id
        || ',"order_status":"' || order_status || '","create_time":"' || create_time
        || '","user_id":' || user_id || ',"sku_id":' || sku_id || ',"user_gender":"'
        || user_gender || '","user_age":' || user_age || ',"user_level":"' || user_level
        || '","sku_price":' || sku_price || ',"sku_name":"' || sku_name || '","dt":"' || dt
        || '"}}', ',' order by order_detail_id) from page)
  || ']}}' as result""",

    "device_profiles": f"""
with {_windows(21600, 3600, 3)}
select window_end, mid, uids, item_ids, events, clicked from prof""",

    "alert_windows": f"""
with {_windows(21600, 3600, 3)} select window_end, mid, uids, item_ids from alert""",

    "alert_docs": f"with {_windows(21600, 3600, 3)} {_DOCS}",

    "alert_docs_5s": f"with {_windows(300, 5, 1)} {_DOCS}",

    "cdc_route": f"with {_CHANGES} select topic, value from routed where topic is not null",

    "cdc_orders": """
select cast(o_orderkey as varchar) as id, cast(o_custkey as varchar) as user_id,
       o_orderstatus as order_status, o_totalprice as total_amount,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as create_time,
       strftime(o_orderdate, '%Y-%m-%d') as create_date,
       strftime(o_orderdate, '%H') as create_hour
from orders where o_orderstatus not in ('O', 'P') and o_orderkey % 10 <> 7""",

    "cdc_sales": """
select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as order_detail_id,
       cast(l_orderkey as varchar) as order_id, o_orderstatus as order_status,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as create_time,
       cast(o_custkey as varchar) as user_id, cast(l_partkey as varchar) as sku_id,
       l_extendedprice as sku_price, strftime(o_orderdate, '%Y-%m-%d') as dt
from lineitem join orders on l_orderkey = o_orderkey
where o_orderstatus not in ('O', 'P') and o_orderkey % 10 <> 7 and l_returnflag <> 'R'""",

    "log_route": f"with {_LOG_LINES} select event_id, topic, value from stamped",

    "log_archive": f"""
with {_LOG_LINES}
select strftime(ts, '%Y-%m-%d') as log_date, value from stamped""",

    "log_columns": """
select event_id, strftime(ts, '%Y-%m-%d %H') as day_hour, strftime(ts, '%Y-%m-%d') as day,
       strftime(ts - interval 1 day, '%Y-%m-%d') as day_before,
       cast(json_extract_string(props, '$.k') as integer) as item
from events""",

    "cdc_keys": """
with kinds as (
  select case o_orderstatus when 'O' then 'UPDATE' when 'P' then 'DELETE' else 'INSERT' end
           || '->order_info' as route_key,
         case when o_orderkey % 10 = 7 then 'TRANSACTIONEND' else 'ROWDATA' end as entry_type
  from orders
  union all
  select case when l_returnflag = 'R' then 'UPDATE' else 'INSERT' end || '->order_detail', 'ROWDATA'
  from lineitem
  union all
  select case when c_acctbal < 0 then 'UPDATE' else 'INSERT' end || '->user_info', 'ROWDATA'
  from customer)
select route_key, entry_type, count(*) as n from kinds group by 1, 2""",

    "table_orders": """
select cast(event_id as varchar) as "ID", cast(user_id as varchar) as "USER_ID",
       value as "TOTAL_AMOUNT", strftime(ts, '%Y-%m-%d %H:%M:%S') as "CREATE_TIME",
       strftime(ts, '%Y-%m-%d') as "CREATE_DATE", strftime(ts, '%H') as "CREATE_HOUR"
from events where event_type = 'purchase'""",

    "table_total": f"""
with {_STARTS}
select 'dau' as id, '新增日活' as name, cast(count(mid) as double) as value
from first where log_date = '2024-01-09'
union all
select 'order_amount', '新增交易额', round(coalesce(sum(value), 0.0), 2)
from events where event_type = 'purchase' and strftime(ts, '%Y-%m-%d') = '2024-01-09'""",

    "table_hour": f"""
with {_STARTS},
spine as (select lpad(cast(unnest(range(0, 24)) as varchar), 2, '0') as log_hour)
select spine.log_hour,
       count(mid) filter (log_date = '2024-01-08') as yesterday,
       count(mid) filter (log_date = '2024-01-09') as today
from spine left join first
  on first.log_hour = spine.log_hour and log_date in ('2024-01-08', '2024-01-09')
group by spine.log_hour""",

    "table_sale_detail": f"""
with {_DAY_HITS}, {_SHARES} select total, title, name, value from shares""",

    "stream_dau": f"""
with {_STARTS}
select cast(mid as varchar) as mid, log_date, log_hour, epoch_us(ts) // 1000 as ts from first""",

    "stream_alerts": f"""
select * replace (cast(mid as varchar) as mid) from (with {_windows(21600, 3600, 3)} {_DOCS})""",

    "stream_alerts_5s": f"""
select * replace (cast(mid as varchar) as mid) from (with {_windows(300, 5, 1)} {_DOCS})""",

    "stream_sales": f"""
with {_SALES}
select sale.order_detail_id, cast(sale.order_id as varchar) as order_id, order_status,
       create_time, cast(user_id as varchar) as user_id, cast(sku_id as varchar) as sku_id,
       user_gender, user_age, user_level, sku_price, sku_name, dt
from sale
where order_detail_id in (
  select order_detail_id from line join ord on line.order_id = ord.order_id
  where l_shipdate between o_orderdate - interval 30 day and o_orderdate + interval 30 day)""",

    "stream_fanout": f"""
with {_STARTS}, n as (select (select count(*) from starts) as every, (select count(*) from first) as once)
select 'starts' as name, every as n from n union all select 'first_starts', once from n
union all select 'commits of one table only', 0
union all select 'dau', once from n union all select 'seen_device', once from n""",

    "stream_hour_figures": f"""
select 'dau' as metric, log_hour, yesterday::double as yesterday, today::double as today
from ({_HOURS_OF_DEVICES})
union all select 'order_amount', log_hour, yesterday, today from ({_HOURS_OF_AMOUNTS})""",

    "stream_sales_repaired": f"""
with {_SALES},
one as (
  select * from line qualify row_number() over (partition by order_detail_id order by sku_price desc) = 1)
select order_detail_id, coalesce(one.order_id, ord.order_id)::varchar as order_id, sku_id::varchar as sku_id,
       sku_name, sku_price, order_status, create_time, user_id::varchar as user_id, dt
from one full join ord on one.order_id = ord.order_id""",

    "stream_users_sales": f"""
with {_SALES},
met as (
  select order_detail_id, greatest(l_shipdate, o_orderdate) as met_at
  from line join ord on line.order_id = ord.order_id
  where l_shipdate between o_orderdate - interval 30 day and o_orderdate + interval 30 day)
select sale.order_detail_id, cast(sale.order_id as varchar) as order_id, order_status,
       create_time, cast(user_id as varchar) as user_id, cast(sku_id as varchar) as sku_id,
       user_gender, user_age,
       case when user_level is null or user_id % 3 <> 1 or met_at < date '1996-01-01' then user_level
            when met_at < date '1999-01-01' then 'level 1' else 'level 2' end as user_level,
       sku_price, dt
from sale join met on sale.order_detail_id = met.order_detail_id""",
}
_DEVICE_DAYS = "devices as (select distinct user_id as mid, ts::date as d from events), days as (select distinct d from devices)"
ORACLE["dau_week"] = f"""
with {_DEVICE_DAYS}
select strftime(days.d, '%Y-%m-%d') as day, count(distinct mid) as n
from days join devices on devices.d between days.d - 6 and days.d group by days.d"""
ORACLE["dau_return"] = f"""
with {_DEVICE_DAYS}
select strftime(days.d, '%Y-%m-%d') as day, count(old.mid) as n
from days join devices on devices.d = days.d
left join devices old on old.mid = devices.mid and old.d = days.d - 1 group by days.d"""
ORACLE["search_index"] = f"""
with {_HITS}
select order_detail_id, order_id::varchar as order_id, order_status, create_time, user_id::varchar as user_id,
       sku_id::varchar as sku_id, user_gender, user_age, user_level, sku_price, sku_name, dt from hits"""
ORACLE["table_page"] = f"""
with {_SALES}
select order_detail_id, order_id::varchar as order_id, order_status, create_time, user_id::varchar as user_id,
       sku_id::varchar as sku_id, user_gender, user_age, user_level, sku_price, sku_name, dt
from sale order by order_detail_id limit 10 offset 3990"""
ORACLE["sale_ranked"] = f"""
with {_HITS},
named as (
  select order_detail_id, sku_name, coalesce(regexp_extract_all(lower(sku_name), '[a-z0-9]+'), []) as t from sale),
stats as (
  select count(*)::double as rows, avg(len(t)) as mean,
         count(*) filter (list_contains(t, 'red'))::double as red,
         count(*) filter (list_contains(t, 'widget'))::double as widget from named),
terms as (
  select order_detail_id, sku_name, unnest([ln(1 + (rows - red + 0.5) / (red + 0.5)),
           ln(1 + (rows - widget + 0.5) / (widget + 0.5))]) as idf,
         unnest([len(list_filter(t, lambda x: x = 'red')),
           len(list_filter(t, lambda x: x = 'widget'))])::double as tf, len(t) / mean as l
  from named, stats where list_contains(t, 'red') and list_contains(t, 'widget'))
select order_detail_id, any_value(sku_name) as sku_name,
       round(sum(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * l))), 6) as score
from terms group by order_detail_id order by score desc, order_detail_id limit 10"""
ORACLE["stream_recovery"] = ORACLE["table_orders"]
