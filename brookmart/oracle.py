"""The same queries in DuckDB SQL, for checking results."""

from __future__ import annotations

from brookmart.queries import AS_OF, SALES_DAY, STAT_TS

# Common table expressions, each with the ones it reads.
_CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "ev": ((), """
        select event_id, ts as moment, epoch_us(ts) // 1000 as ts, user_id, event_type, value,
               cast(json_extract_string(props, '$.k') as bigint) as k,
               case when event_type in ('click', 'view') then 'sku_id'
                    when event_type = 'error' then 'keyword' end as item_type,
               event_type in ('signup', 'view') as is_entry
        from events"""),
    "logs": (("ev",), """
        select event_id as pos, ts, make_timestamp(ts * 1000) as moment,
               cast(user_id as varchar) as mid, 'v' || (user_id % 4) as vc,
               'ch' || (user_id % 3) as ch, 'ar' || (user_id % 5) as ar, k,
               case when event_type = 'error' then 'good_list' else event_type end as page_id,
               case when not is_entry then 'home' end as last_page_id,
               case when item_type is not null then cast(k as varchar) end as item,
               item_type, cast(round(value * 100) as bigint) as during_time,
               is_entry, event_type = 'signup' and k % 2 = 0 as is_start
        from ev"""),
    "flagged": (("logs",), """
        select *, case when row_number() over (partition by mid order by ts, pos) = 1
                       then '1' else '0' end as is_new
        from logs"""),
    "pages": (("flagged",), "select * from flagged where not is_start"),
    "shown": (("logs",), """
        select *, unnest(range(k % 3 + 1)) as i from logs where not is_start"""),
    "stepped": (("logs",), """
        select *, lead(ts) over w as next_ts, lead(is_entry) over w as next_entry
        from logs window w as (partition by mid order by ts, pos)"""),
    "page_stepped": (("pages",), """
        select *, lead(ts) over w as next_ts, lead(is_entry) over w as next_entry
        from pages window w as (partition by mid order by ts, pos)"""),
    "changes": (("ev",), """
        select event_type as "table",
               case k % 4 when 1 then 'update' else 'insert' end as type,
               ts // 1000 as ts, event_id as xid, k as xoffset, event_id, user_id, value
        from ev where k % 10 <> 0 and k % 4 <> 3"""),
    "config": (("ev",), """
        select event_type as source_table,
               case when k % 2 = 0 then 'insert' else 'update' end as operate_type,
               case when event_type in ('view', 'signup') then 'hbase'
                    when event_type = 'error' then 'other' else 'kafka' end as sink_type,
               case when event_type in ('view', 'signup') then 'dim_' else 'dwd_' end
                   || event_type as sink_table,
               ['user_id,event_id,value', 'user_id,event_id', 'user_id, value']
                   [cast(event_id % 3 + 1 as int)] as sink_columns,
               'user_id' as sink_pk, cast(null as varchar) as sink_extend
        from ev where event_id % 4 in (0, 1)
        qualify row_number() over (partition by source_table, operate_type
                                   order by ts desc, event_id desc) = 1"""),
    "configured": (("changes", "config"), """
        select * from changes join config
            on "table" = source_table and type = operate_type"""),
    "routed": (("configured",), """
        select *, case sink_type when 'kafka' then 'topic' else 'dim' end as route,
               sink_columns <> 'user_id, value' and sink_columns like '%event_id%' as has_event,
               sink_columns = 'user_id,event_id,value' as has_value
        from configured where sink_type in ('kafka', 'hbase')"""),
    "info": ((), """
        select o_orderkey as id, o_custkey % 25 as province_id, o_orderstatus as order_status,
               o_custkey as user_id, cast(o_totalprice as decimal(20, 2)) as total_amount,
               o_orderdate as moment, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as create_time
        from orders"""),
    "facts": (("info",), """
        select l_orderkey * 10 + l_linenumber as detail_id, id as order_id,
               l_partkey as sku_id, cast(l_quantity as bigint) as sku_num, province_id,
               order_status, user_id, total_amount,
               cast(5 as decimal(20, 2)) as feight_fee,
               cast(l_extendedprice as decimal(20, 2)) as split_total_amount, moment, create_time,
               strftime(moment, '%Y-%m-%d') as create_date, strftime(moment, '%H') as create_hour
        from info join lineitem on id = l_orderkey
            and l_shipdate between moment - interval 30 day and moment + interval 30 day"""),
    "sku": ((), """
        select p_partkey as sku_id, p_name as sku_name,
               cast(p_retailprice as decimal(20, 2)) as sku_price,
               s_suppkey as spu_id, s_name as spu_name,
               cast(split_part(p_brand, '#', 2) as bigint) as tm_id, p_brand as tm_name,
               cast(ascii(p_type) * 100 + length(p_type) as bigint) as category3_id,
               p_type as category3_name
        from part join supplier on p_partkey % 10 = s_suppkey"""),
    "wide": (("facts", "sku"), f"""
        select detail_id, f.order_id, f.sku_id, sku_price, sku_num, sku_name, province_id,
               order_status, user_id, total_amount,
               cast(0 as decimal(20, 2)) as activity_reduce_amount,
               cast(0 as decimal(20, 2)) as coupon_reduce_amount,
               total_amount as original_total_amount, feight_fee,
               cast(null as decimal(20, 2)) as split_feight_fee,
               cast(0 as decimal(20, 2)) as split_activity_amount,
               cast(0 as decimal(20, 2)) as split_coupon_amount, split_total_amount,
               cast(null as varchar) as expire_time, create_time,
               cast(null as varchar) as operate_time, create_date, create_hour,
               n_name as province_name, cast(n_regionkey as varchar) as province_area_code,
               r_name as province_iso_code, 'N-' || n_nationkey as province_3166_2_code,
               cast(date_diff('day', date '1950-01-01' + cast(c_custkey % 18000 as int),
                              date '{AS_OF}') // 365 as int) as user_age,
               case when c_custkey % 2 = 0 then 'F' else 'M' end as user_gender,
               spu_id, tm_id, category3_id, spu_name, tm_name, category3_name
        from facts f join sku on f.sku_id = sku.sku_id
            join nation on province_id = n_nationkey join region on n_regionkey = r_regionkey
            join customer on user_id = c_custkey"""),
    "paid": ((), """
        select o_orderkey + 1000000 as payment_id, o_orderkey as order_id,
               o_custkey as user_id, cast(o_totalprice as decimal(20, 2)) as total_amount,
               o_orderpriority as subject, '1101' as payment_type,
               o_orderdate + to_minutes(cast(o_orderkey % 60 as int)) as moment,
               strftime(o_orderdate + to_minutes(cast(o_orderkey % 60 as int)),
                        '%Y-%m-%d %H:%M:%S') as create_time
        from orders where o_orderstatus in ('F', 'P')"""),
    "metric": (("logs", "shown", "ev", "facts", "paid"), """
        select k as sku_id, ts, 1 as click_ct, 0 as display_ct, 0 as favor_ct, 0 as cart_ct,
               0 as order_sku_num, 0 as comment_ct, 0 as good_comment_ct,
               0 as order_amount, 0 as payment_amount, 0 as refund_amount,
               null as order_id, null as paid_order_id, null as refund_order_id
        from logs where not is_start and item_type = 'sku_id'
        union all
        select case when item_type = 'sku_id' then k else k + i + 1 end, ts, 0, 1,
               0, 0, 0, 0, 0, 0, 0, 0, null, null, null
        from shown where item_type = 'sku_id' or item_type is null
        union all
        select k, ts // 1000 * 1000, 0, 0, cast(event_type = 'signup' as int),
               cast(event_type = 'purchase' as int), 0, 0, 0, 0, 0, 0, null, null, null
        from ev where event_type in ('signup', 'purchase')
        union all
        select sku_id, epoch_ms(moment), 0, 0, 0, 0, sku_num, 0, 0, split_total_amount, 0, 0,
               order_id, null, null
        from facts
        union all
        select sku_id, epoch_ms(p.moment), 0, 0, 0, 0, 0, 0, 0, 0, split_total_amount, 0,
               null, f.order_id, null
        from paid p join facts f on p.order_id = f.order_id
            and f.moment between p.moment - interval 45 minute and p.moment + interval 5 second
        union all
        select l_partkey, epoch_ms(l_shipdate), 0, 0, 0, 0, 0, 0, 0, 0, 0,
               cast(l_extendedprice as decimal(20, 2)), null, null, l_orderkey
        from lineitem where l_returnflag = 'R'
        union all
        select l_partkey, epoch_ms(l_shipdate), 0, 0, 0, 0, 0, 1,
               cast((l_linenumber - 1) % 5 + 1 in (4, 5) as int), 0, 0, 0, null, null, null
        from lineitem"""),
    "pstats": (("metric",), f"""
        select strftime(day, '%Y-%m-%d %H:%M:%S') as stt,
               strftime(day + interval 1 day, '%Y-%m-%d %H:%M:%S') as edt,
               cast(sku_id as bigint) as sku_id,
               cast(sum(display_ct) as bigint) as display_ct,
               cast(sum(click_ct) as bigint) as click_ct,
               cast(sum(favor_ct) as bigint) as favor_ct,
               cast(sum(cart_ct) as bigint) as cart_ct,
               cast(sum(order_sku_num) as bigint) as order_sku_num,
               cast(sum(comment_ct) as bigint) as comment_ct,
               cast(sum(good_comment_ct) as bigint) as good_comment_ct,
               cast(sum(order_amount) as decimal(20, 2)) as order_amount,
               cast(sum(payment_amount) as decimal(20, 2)) as payment_amount,
               cast(sum(refund_amount) as decimal(20, 2)) as refund_amount,
               count(distinct order_id) as order_ct,
               count(distinct paid_order_id) as paid_order_ct,
               count(distinct refund_order_id) as refund_order_ct,
               cast({STAT_TS} as bigint) as ts
        from (select *, date_trunc('day', make_timestamp(cast(ts * 1000 as bigint))) as day
              from metric)
        group by day, sku_id"""),
    "penriched": (("pstats", "sku"), """
        select p.*, sku_name, sku_price, spu_id, spu_name, tm_id, tm_name, category3_id,
               category3_name
        from pstats p join sku on p.sku_id = sku.sku_id"""),
    "rstats": (("wide",), f"""
        select province_id, province_name, province_area_code as area_code,
               province_iso_code as iso_code, province_3166_2_code as iso_3166_2,
               create_date || ' 00:00:00' as stt,
               strftime(cast(create_date as date) + 1, '%Y-%m-%d') || ' 00:00:00' as edt,
               cast(sum(split_total_amount) as decimal(20, 2)) as order_amount,
               count(distinct order_id) as order_count, cast({STAT_TS} as bigint) as ts
        from wide
        group by province_id, province_name, province_area_code, province_iso_code,
                 province_3166_2_code, create_date"""),
    "vmetric": (("pages", "page_stepped"), """
        select vc, ch, ar, is_new, ts, 0 as uv_ct, 1 as pv_ct, 0 as sv_ct, 0 as uj_ct,
               during_time as dur_sum from pages
        union all
        select vc, ch, ar, is_new, ts, 0, 0, 1, 0, 0 from pages where is_entry
        union all
        select vc, ch, ar, is_new, ts, 1, 0, 0, 0, 0 from pages
        qualify row_number() over (partition by mid, date_trunc('day', moment)
                                   order by ts, pos) = 1
        union all
        select vc, ch, ar, is_new, ts, 0, 0, 0, 1, 0 from page_stepped
        where is_entry and (next_ts is null or next_ts - ts >= 21600000 or next_entry)"""),
    "searched": (("ev",), """
        select event_id as pos, p_name as kw, ts from ev join part on k = p_partkey
        where event_type = 'error'"""),
    "active": (("penriched",), """
        select * from penriched where click_ct > 0 or cart_ct > 0 or order_ct > 0"""),
    "counted": (("penriched",), """
        select stt, edt, sku_id, sku_name, 'click_ct' as source, click_ct as ct from penriched
        union all select stt, edt, sku_id, sku_name, 'cart_ct', cart_ct from penriched
        union all select stt, edt, sku_id, sku_name, 'order_ct', order_ct from penriched"""),
}

_WORDS = "unnest(list_distinct(regexp_extract_all(lower({}), '[a-z0-9]+|[一-鿿]+')))"
_DAY = f"{SALES_DAY // 10000}-{SALES_DAY // 100 % 100:02d}-{SALES_DAY % 100:02d}"
_HOUR_MS = 3_600_000
_GAP_MS = 6 * _HOUR_MS


def _with(names: tuple[str, ...], body: str) -> str:
    order: list[str] = []

    def need(name: str) -> None:
        if name not in order:
            for other in _CTES[name][0]:
                need(other)
            order.append(name)

    for name in names:
        need(name)
    if not order:
        return body.strip()
    return "with " + ",\n".join(f"{n} as ({_CTES[n][1]})" for n in order) + body


_GMV = f"""select cast(sum(order_amount) as decimal(20, 2)) as order_amount
    from penriched where stt like '{_DAY}%'"""
_BY_BRAND = f"""select tm_name, cast(sum(order_amount) as decimal(20, 2)) as order_amount
    from penriched where stt like '{_DAY}%' group by tm_name"""
_BY_PROVINCE = f"""select province_name,
           cast(sum(order_amount) as decimal(20, 2)) as order_amount,
           cast(sum(order_count) as bigint) as order_count
    from rstats where stt like '{_DAY}%' group by province_name"""

def _fields(fixed: str, common: str, page: str, more: str) -> str:
    """Names of a payload's fields; `common` and `page` stand before those of the two."""
    names = ", ".join(f"{common} || '{c}'" for c in
                      ("mid", "vc", "ch", "ar", "is_new", "uid", "os"))
    maybe = ", ".join(f"case when {c} is not null then {page} || '{c}' end"
                      for c in ("last_page_id", "item", "item_type"))
    return (f"array_to_string(list_sort(list_distinct(list_filter({fixed} || "
            f"[{names}, {maybe}{more}], lambda x: x is not null))), ',')")


_QUERIES: dict[str, tuple[tuple[str, ...], str]] = {
    "topic_table_json": (("ev",), """
        select event_id, ts, user_id, event_type, value from ev"""),
    "log_parse_fields": (("logs",), """
        select pos, mid, ch, page_id, item, during_time,
               cast(k + 1 as varchar) as first_display, is_start as has_start, ts from logs"""),
    "log_split_counts": (("logs", "shown"), """
        select 'start' as kind, count(*) as records from logs where is_start
        union all select 'page', count(*) from logs where not is_start
        union all select 'display', count(*) from shown"""),
    "log_payload_fields": (("logs", "shown"), f"""
        select pos, case when is_start then 'dwd_start' else 'dwd_page' end as topic,
               {_fields("['common', 'displays', 'page', 'ts', 'page.during_time', 'page.page_id', "
                        "'page.source_type']", "'common.'", "'page.'",
                        ", if(is_start, 'start', null), if(k % 5 = 0, 'err', null)")} as fields
        from logs
        union all
        select pos, 'dwd_display',
               {_fields("['ts', 'item', 'item_type', 'display_type', 'order', 'pos_id', 'extra', "
                        "'during_time', 'page_id', 'source_type']", "''", "''", "")}
        from shown"""),
    "display_explode_merge": (("shown",), """
        select pos, mid, vc, ch, ar, '1' as is_new, page_id, last_page_id,
               coalesce(item, cast(k + i + 1 as varchar)) as item,
               coalesce(item_type, 'sku_id') as item_type, during_time,
               'query' as display_type, i as "order", i + 1 as pos_id, ts from shown"""),
    "display_keep_own_item": (("shown",), """
        select pos, i + 1 as pos_id, cast(k + i + 1 as varchar) as item,
               'sku_id' as item_type, page_id from shown"""),
    "changelog_etl": (("changes",), """
        select "table", type, ts, xid, xoffset, event_id, value from changes"""),
    "config_latest_per_key": (("config",), "select * from config"),
    "changelog_config_join": (("configured",), """
        select "table", type, xid, sink_type, sink_table, sink_columns, sink_pk
        from configured"""),
    "changelog_prune_columns": (("configured",), """
        select xid, sink_table,
               case sink_columns when 'user_id,event_id,value' then 'event_id,user_id,value'
                                 when 'user_id,event_id' then 'event_id,user_id'
                                 else 'user_id' end as kept,
               user_id,
               case when sink_columns = 'user_id,event_id,value' then value end as value
        from configured"""),
    "changelog_route": (("routed",), "select xid, sink_table, route from routed"),
    "dynamic_topic_counts": (("routed",), """
        select sink_table as topic, count(*) as records from routed
        where route = 'topic' group by 1"""),
    "dim_upsert_latest": (("routed",), """
        select sink_table, cast(user_id as varchar) as pk, cast(user_id as varchar) as user_id,
               case when has_event then event_id end as event_id,
               case when has_value then value end as value, ts, xid, xoffset
        from routed where route = 'dim'
        qualify row_number() over (partition by sink_table, user_id
                                   order by ts desc, xid desc, xoffset desc) = 1"""),
    "dim_lookup_by_id": ((), """
        select l_orderkey * 10 + l_linenumber as id, l_orderkey as order_id,
               l_partkey as sku_id, p_name as sku_name,
               cast(cast(p_retailprice as decimal(20, 2)) as varchar) as price,
               cast(p_partkey % 10 as varchar) as spu_id
        from lineitem join part on l_partkey = p_partkey"""),
    "time_conversions": (("ev",), """
        select event_id, strftime(moment, '%Y-%m-%d %H:%M:%S') as at_text,
               ts // 1000 * 1000 as at_millis, strftime(moment, '%Y-%m-%d') as at_day,
               cast(strftime(moment, '%Y%m%d') as int) as day_number from ev"""),
    "timezone_convert": (("ev",), """
        select event_id, strftime(moment + interval 8 hour, '%Y-%m-%d %H:%M:%S') as local_text
        from ev"""),
    "user_age": ((), f"""
        select c_custkey as user_id, case when c_custkey % 2 = 0 then 'F' else 'M' end as gender,
               cast(date_diff('day', date '1950-01-01' + cast(c_custkey % 18000 as int),
                              date '{AS_OF}') // 365 as int) as age
        from customer"""),
    "order_info_derive": (("info",), """
        select id, province_id, user_id, total_amount, create_time,
               create_time[1:10] as create_date, create_time[12:13] as create_hour,
               epoch_ms(moment) as create_ts from info"""),
    "order_wide_facts": (("facts",), "select * exclude (moment) from facts"),
    "order_wide_enriched": (("wide",), "select * from wide"),
    "payment_wide": (("paid", "wide"), """
        select payment_id, subject, payment_type, p.create_time as payment_create_time,
               p.create_time as callback_time, p.order_id, p.user_id, p.total_amount,
               w.create_time as order_create_time,
               w.* exclude (order_id, user_id, total_amount, expire_time, create_time,
                            operate_time, create_date, create_hour)
        from paid p join wide w on p.order_id = w.order_id
            and cast(w.create_time as timestamp)
                between p.moment - interval 45 minute and p.moment + interval 5 second"""),
    "new_visitor_flag": (("flagged",), "select pos, mid, is_new, ts from flagged"),
    "daily_unique_visitors": (("logs",), """
        select mid, pos, page_id, ts from logs
        qualify row_number() over (partition by mid, date_trunc('day', moment)
                                   order by ts, pos) = 1"""),
    "daily_uv_count": (("logs",), """
        select strftime(moment, '%Y-%m-%d') as day, count(distinct mid) as uv
        from logs group by 1"""),
    "earliest_event_per_window": (("ev",), """
        select user_id, strftime(moment, '%Y-%m-%d %H') as hour, event_id, event_type, ts from ev
        qualify row_number() over (partition by user_id, date_trunc('hour', moment)
                                   order by ts, event_id) = 1"""),
    "user_jump": (("stepped",), f"""
        select mid, pos, page_id, ts from stepped
        where is_entry and (next_ts is null or next_ts - ts >= {_GAP_MS} or next_entry)"""),
    "user_jump_timeout_only": (("stepped",), f"""
        select mid, pos, page_id, ts from stepped
        where is_entry and (next_ts is null or next_ts - ts >= {_GAP_MS})"""),
    "sequence_match": (("stepped",), f"""
        select mid, pos, ts, next_ts from stepped
        where is_entry and next_ts - ts < {_GAP_MS} and not next_entry"""),
    "sequence_timeout": (("stepped",), f"""
        select mid, pos, ts from stepped
        where is_entry and (next_ts is null or next_ts - ts >= {_GAP_MS})"""),
    "visitor_metric_rows": (("vmetric",), """
        select vc, ch, ar, is_new, ts, cast(uv_ct as bigint) as uv_ct,
               cast(pv_ct as bigint) as pv_ct, cast(sv_ct as bigint) as sv_ct,
               cast(uj_ct as bigint) as uj_ct, cast(dur_sum as bigint) as dur_sum
        from vmetric"""),
    "visitor_stats": (("vmetric",), f"""
        select strftime(h, '%Y-%m-%d %H:%M:%S') as stt,
               strftime(h + interval 1 hour, '%Y-%m-%d %H:%M:%S') as edt, vc, ch, ar, is_new,
               cast(sum(uv_ct) as bigint) as uv_ct, cast(sum(pv_ct) as bigint) as pv_ct,
               cast(sum(sv_ct) as bigint) as sv_ct, cast(sum(uj_ct) as bigint) as uj_ct,
               cast(sum(dur_sum) as bigint) as dur_sum, cast({STAT_TS} as bigint) as ts
        from (select *, date_trunc('hour', make_timestamp(ts * 1000)) as h from vmetric)
        group by h, vc, ch, ar, is_new"""),
    "product_clicks": (("logs",), """
        select k as sku_id, cast(1 as bigint) as click_ct, ts from logs
        where not is_start and item_type = 'sku_id'"""),
    "product_displays": (("shown",), """
        select case when item_type = 'sku_id' then k else k + i + 1 end as sku_id,
               cast(1 as bigint) as display_ct, ts
        from shown where item_type = 'sku_id' or item_type is null"""),
    "product_favor_cart": (("ev",), """
        select k as sku_id, cast(event_type = 'signup' as bigint) as favor_ct,
               cast(event_type = 'purchase' as bigint) as cart_ct, ts // 1000 * 1000 as ts
        from ev where event_type in ('signup', 'purchase')"""),
    "product_order_pay_refund": (("metric",), """
        select cast(sku_id as bigint) as sku_id, cast(order_sku_num as bigint) as order_sku_num,
               cast(order_amount as decimal(20, 2)) as order_amount,
               cast(payment_amount as decimal(20, 2)) as payment_amount,
               cast(refund_amount as decimal(20, 2)) as refund_amount,
               cast(order_id as bigint) as order_id,
               cast(paid_order_id as bigint) as paid_order_id,
               cast(refund_order_id as bigint) as refund_order_id, cast(ts as bigint) as ts
        from metric
        where order_id is not null or paid_order_id is not null
            or refund_order_id is not null"""),
    "product_comments": ((), """
        select l_partkey as sku_id, cast(1 as bigint) as comment_ct,
               cast((l_linenumber - 1) % 5 + 1 in (4, 5) as bigint) as good_comment_ct,
               epoch_ms(l_shipdate) as ts from lineitem"""),
    "product_metric_union": (("metric",), """
        select cast(sku_id as bigint) as sku_id, cast(ts as bigint) as ts,
               cast(click_ct as bigint) as click_ct, cast(display_ct as bigint) as display_ct,
               cast(favor_ct as bigint) as favor_ct, cast(cart_ct as bigint) as cart_ct,
               cast(order_sku_num as bigint) as order_sku_num,
               cast(comment_ct as bigint) as comment_ct,
               cast(good_comment_ct as bigint) as good_comment_ct,
               cast(order_amount as decimal(20, 2)) as order_amount,
               cast(payment_amount as decimal(20, 2)) as payment_amount,
               cast(refund_amount as decimal(20, 2)) as refund_amount,
               cast(order_id as bigint) as order_id,
               cast(paid_order_id as bigint) as paid_order_id,
               cast(refund_order_id as bigint) as refund_order_id
        from metric"""),
    "product_stats": (("pstats",), "select * from pstats"),
    "sink_projection": (("pstats",), "select * from pstats"),
    "product_stats_enriched": (("penriched",), "select * from penriched"),
    "province_stats": (("rstats",), "select * from rstats"),
    "province_stats_sql": (("rstats",), "select * from rstats"),
    "search_filter": (("searched",), "select pos, kw, ts from searched"),
    "keyword_tokens": ((), f"select p_partkey, {_WORDS.format('p_name')} as word from part"),
    "document_words": ((), f"""
        select word, count(*) as documents
        from (select {_WORDS.format('text')} as word from documents) group by word"""),
    "search_keyword_stats": (("searched",), f"""
        select strftime(h + interval 8 hour, '%Y-%m-%d %H:%M:%S') as stt,
               strftime(h + interval 9 hour, '%Y-%m-%d %H:%M:%S') as edt, keyword,
               'search' as source, count(*) as ct, cast({STAT_TS} as bigint) as ts
        from (select date_trunc('hour', make_timestamp(ts * 1000)) as h,
                     {_WORDS.format('kw')} as keyword from searched)
        group by h, keyword"""),
    "any_metric_positive": (("active",), """
        select stt, sku_id, click_ct, cart_ct, order_ct from active"""),
    "unpivot_metrics": (("counted",), """
        select stt, sku_id, source, ct from counted where ct > 0"""),
    "product_keyword_stats": (("counted",), f"""
        select stt, edt, keyword, source, cast(sum(ct) as bigint) as ct,
               cast({STAT_TS} as bigint) as ts
        from (select stt, edt, source, ct, {_WORDS.format('sku_name')} as keyword
              from counted where ct > 0)
        group by stt, edt, keyword, source"""),
    "gmv_day": (("penriched",), _GMV),
    "gmv_by_brand_day": (("penriched",), _BY_BRAND),
    "sales_by_province_day": (("rstats",), _BY_PROVINCE),
    "gmv_payload": (("penriched",), f"""
        select '{{"status":0,"msg":""'
               || coalesce(',"data":' || order_amount, '') || '}}' as payload
        from ({_GMV})"""),
    "brand_chart_payload": (("penriched",), f"""
        select '{{"status":0,"msg":"","data":{{"categories":['
               || coalesce(string_agg('"' || tm_name || '"', ',' order by tm_name), '')
               || '],"series":[{{"name":"商品品牌","data":['
               || coalesce(string_agg(cast(order_amount as varchar), ',' order by tm_name), '')
               || ']}}]}}}}' as payload
        from ({_BY_BRAND})"""),
    "province_chart_payload": (("rstats",), f"""
        select '{{"status":0,"msg":"","data":{{"mapData":['
               || coalesce(string_agg('{{"name":"' || province_name || '","value":'
                                      || order_amount || ',"tooltipvalues":['
                                      || order_count || ']}}', ','
                                      order by province_name), '')
               || '],"valueName":"销售额","tooltipNames":["订单数"],"tooltipUnits":["个"]}}}}'
               as payload
        from ({_BY_PROVINCE})"""),
    "tumbling_window_counts": (("ev",), """
        select strftime(h, '%Y-%m-%d %H:%M:%S') as stt,
               strftime(h + interval 1 hour, '%Y-%m-%d %H:%M:%S') as edt, count(*) as n
        from (select date_trunc('hour', moment) as h from ev) group by h"""),
    "late_rows_split": ((), """
        , d as (select cast(l_shipdate as date) as arrived, date '1970-01-01'
                       + cast(7 * ((cast(o_orderdate as date) - date '1970-01-01') // 7 + 1) as int)
                       as edt
                from lineitem join orders on l_orderkey = o_orderkey)
        select strftime(edt - 7, '%Y-%m-%d %H:%M:%S') as stt,
               strftime(edt, '%Y-%m-%d %H:%M:%S') as edt,
               count(*) filter (arrived - edt < 14) as on_time_ct,
               count(*) filter (arrived - edt >= 14) as late_ct,
               greatest(max(arrived - edt), 0) * 86400000 as last_behind_ms
        from d group by edt"""),
    "latest_version_per_key": (("ev",), """
        select event_type, k as keyword, event_id as version, value, ts from ev
        qualify row_number() over (partition by event_type, k
                                   order by ts desc, event_id desc) = 1"""),
}


def oracles() -> dict[str, str]:
    out = {}
    for name, (needs, body) in _QUERIES.items():
        sql = _with(needs, body)
        out[name] = "with " + sql[1:].strip() if sql.startswith(",") else sql
    return out
