"""Every operator as a query over the test tables.

The test events are far apart, so windows and limits are wider here than the defaults.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmart import adapters as A
from brookmart.functions.keywords import any_positive, explode_words, positive_counters
from brookmart.functions.records import parse_dynamic, parse_typed, to_payload
from brookmart.functions.times import (age_in_years, event_time, millis_to_text,
                                       text_to_millis, utc_to_zone)
from brookmart.operators import changelog as C
from brookmart.operators import firsts, logs, metrics, sequence, windows
from brookmart.operators.enrich import enrich_product, lookup_dim
from brookmart.plans import orders, serving, stats
from brookmart.schemas import DAY, ORDER_INFO
from brookmart.session import materialize, tune
from brookmart.sinks import tables as sinks

HOUR = "1 hour"
ONE_DAY = "1 day"
GAP = "6 hours"
ORDER_SLACK = "30 days"
LATE_DELAY = "14 days"
WEEK = "7 days"
AS_OF = date(2024, 1, 31)
STAT_TS = 1_706_659_200_000
SALES_DAY = 20000611

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register `fn` under its name; sessions are tuned before it runs."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tune(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


# ---- shared inputs -----------------------------------------------------------------

PAGE_FIELDS = ("common", "start", "page", "ts")


def _span(day):
    """The day of a yyyymmdd number."""
    start = datetime.strptime(str(day), "%Y%m%d")
    return start, start + timedelta(days=1)


def _wider(span, before, after):
    return (span[0] - before, span[1] + after) if span else None


def _logs(spark, sf, *fields, span=None):
    return logs.parse_log(A.log_topic(spark, sf, span), fields=fields or None)


def _views(spark, sf):
    return logs.page_views(_logs(spark, sf, *PAGE_FIELDS))


def _pages(spark, sf):
    """Page topic with the repaired visitor flag, as a stored layer."""
    page = logs.split_log(logs.repair_is_new(_logs(spark, sf)))["page"]
    return materialize(logs.page_views(page), "dwd_page")


def _order_facts(spark, sf, span=None):
    slack = timedelta(days=30)
    return orders.order_wide_facts(A.order_info(spark, sf, span),
                                   A.order_detail(spark, sf, _wider(span, slack, slack)),
                                   ORDER_SLACK, ORDER_SLACK)


def _order_wide(spark, sf, span=None):
    return orders.enrich_order(_order_facts(spark, sf, span), A.dims(spark, sf), F.lit(AS_OF))


def _changes(spark, sf):
    return C.changelog_etl(A.change_topic(spark, sf))


def _config(spark, sf):
    latest = C.latest_config(A.config_changes(spark, sf), ("seq", "seq2"))
    return materialize(latest, "table_process")


def _configured(spark, sf):
    return C.join_config(_changes(spark, sf), _config(spark, sf))


def _routed(spark, sf):
    return C.route_by_sink(C.prune_columns(_configured(spark, sf)))


def _product_metrics(spark, sf, span=None):
    """Metric rows of all kinds; with a span only those in it, of sources read as far."""
    # A payment is made up to an hour after its order, and joins orders around it.
    hour = timedelta(hours=1)
    around = _wider(span, hour, hour)
    wide = materialize(_order_facts(spark, sf, around), "dwm_order_wide")
    paid = orders.payment_wide(A.payment_info(spark, sf, around), wide)
    rows = metrics.union_all([
        metrics.seen(_logs(spark, sf, *metrics.SEEN_FIELDS, span=span)),
        metrics.favors(A.favor_info(spark, sf, span)),
        metrics.carts(A.cart_info(spark, sf, span)),
        metrics.orders_m(wide),
        metrics.payments_m(paid),
        metrics.refunds_m(A.refund_payment(spark, sf, span)),
        metrics.comments(A.comment_info(spark, sf, span)),
    ])
    if span is None:
        return rows
    lo, hi = (int(t.replace(tzinfo=timezone.utc).timestamp() * 1000) for t in span)
    return rows.where((F.col("ts") >= lo) & (F.col("ts") < hi))


def _product_stats(spark, sf, span=None):
    return stats.product_stats(_product_metrics(spark, sf, span), ONE_DAY, F.lit(STAT_TS))


def _product_stats_enriched(spark, sf, span=None):
    return enrich_product(sinks.sink_projection(_product_stats(spark, sf, span)),
                          A.dims(spark, sf))


def _province_stats(spark, sf, span=None):
    return stats.province_stats(_order_wide(spark, sf, span), ONE_DAY, F.lit(STAT_TS))


# ---- sources, parsing, log records -------------------------------------------------

@query
def topic_table_json(spark, sf):
    text = to_payload(A.events(spark, sf).select("event_id", "ts", "user_id", "event_type",
                                                 "value"))
    return parse_typed(text, spark.createDataFrame([], """
        event_id bigint, ts bigint, user_id bigint, event_type string, value double""").schema)


@query
def log_parse_fields(spark, sf):
    record = A.log_topic(spark, sf).withColumn("v", parse_dynamic("value"))

    def at(path, kind="string"):
        return F.try_variant_get("v", path, kind)

    return record.select(
        "pos", at("$.common.mid").alias("mid"), at("$.common.ch").alias("ch"),
        at("$.page.page_id").alias("page_id"), at("$.page.item").alias("item"),
        at("$.page.during_time", "bigint").alias("during_time"),
        at("$.displays[0].item").alias("first_display"),
        at("$.start").isNotNull().alias("has_start"), at("$.ts", "bigint").alias("ts"))


@query
def log_split_counts(spark, sf):
    records = logs.parse_log(A.log_topic(spark, sf), fields=logs.ROUTED_FIELDS, raw=True)
    return (logs.routed_payloads(records)
            .groupBy(F.expr("replace(topic, 'dwd_', '')").alias("kind"))
            .agg(F.count("*").alias("records")))


@query
def log_payload_fields(spark, sf):
    """Topic and field names of every payload, of records with fields no reader knows."""
    rows = logs.routed_payloads(logs.parse_log(A.log_topic(spark, sf, more=True)), ("pos",))
    return rows.withColumn("v", F.expr(
        "cast(parse_json(value) as map<string, variant>)")).select("pos", "topic", F.expr("""
        array_join(array_sort(flatten(array(
            map_keys(v),
            transform(map_keys(coalesce(try_cast(v['common'] as map<string, variant>),
                                        cast(map() as map<string, variant>))),
                      k -> concat('common.', k)),
            transform(map_keys(coalesce(try_cast(v['page'] as map<string, variant>),
                                        cast(map() as map<string, variant>))),
                      k -> concat('page.', k))))), ',')""").alias("fields"))


@query
def display_explode_merge(spark, sf):
    return logs.explode_displays(logs.split_log(_logs(spark, sf))["display"], keep=("pos",))


@query
def display_keep_own_item(spark, sf):
    shown = logs.split_log(_logs(spark, sf))["display"]
    return logs.explode_displays(shown, keep_display=True, keep=("pos",)).select(
        "pos", "pos_id", "item", "item_type", "page_id")


# ---- change records ----------------------------------------------------------------

@query
def changelog_etl(spark, sf):
    data = parse_dynamic("data")
    return _changes(spark, sf).select(
        "table", "type", "ts", "xid", "xoffset",
        F.try_variant_get(data, "$.event_id", "bigint").alias("event_id"),
        F.try_variant_get(data, "$.value", "double").alias("value"))


@query
def config_latest_per_key(spark, sf):
    return C.latest_config(A.config_changes(spark, sf), ("seq", "seq2"))


@query
def changelog_config_join(spark, sf):
    return _configured(spark, sf).select("table", "type", "xid", "sink_type", "sink_table",
                                         "sink_columns", "sink_pk")


@query
def changelog_prune_columns(spark, sf):
    pruned = F.from_json("data", "map<string,string>")
    return (C.prune_columns(_configured(spark, sf))
            .select("xid", "sink_table", pruned.alias("m"))
            .select("xid", "sink_table",
                    F.array_join(F.array_sort(F.map_keys("m")), ",").alias("kept"),
                    F.col("m")["user_id"].cast("bigint").alias("user_id"),
                    F.col("m")["value"].cast("double").alias("value")))


@query
def changelog_route(spark, sf):
    return _routed(spark, sf).select("xid", "sink_table", "route")


@query
def dynamic_topic_counts(spark, sf):
    return (C.topic_rows(_routed(spark, sf)).groupBy("topic")
            .agg(F.count("*").alias("records")))


@query
def dim_upsert_latest(spark, sf):
    return C.latest_dim_rows(C.dim_rows(_routed(spark, sf))).select(
        "sink_table", F.col("pk")[0].alias("pk"), F.col("data")["user_id"].alias("user_id"),
        F.col("data")["event_id"].cast("bigint").alias("event_id"),
        F.col("data")["value"].cast("double").alias("value"), "ts", "xid", "xoffset")


@query
def dim_lookup_by_id(spark, sf):
    lines = A.order_detail(spark, sf).select("id", "order_id", "sku_id")
    return lookup_dim(lines, A.dims(spark, sf)["sku_info"], "sku_id",
                      ["sku_name", "price", "spu_id"])


# ---- functions ---------------------------------------------------------------------

@query
def time_conversions(spark, sf):
    e = A.events(spark, sf).withColumn("at_text", millis_to_text("ts"))
    return e.select("event_id", "at_text", text_to_millis("at_text").alias("at_millis"),
                    millis_to_text("ts", DAY).alias("at_day"),
                    F.date_format(event_time("ts"), "yyyyMMdd").cast("int").alias("day_number"))


@query
def timezone_convert(spark, sf):
    e = A.events(spark, sf)
    return e.select("event_id", utc_to_zone(millis_to_text("ts")).alias("local_text"))


@query
def user_age(spark, sf):
    return A.dims(spark, sf)["user_info"].select(
        F.col("id").cast("bigint").alias("user_id"), "gender",
        age_in_years("birthday", F.lit(AS_OF)).alias("age"))


@query
def order_info_derive(spark, sf):
    text = to_payload(A.order_info(spark, sf))
    return orders.order_info_derive(parse_typed(text, ORDER_INFO)).select(
        "id", "province_id", "user_id", "total_amount", "create_time", "create_date",
        "create_hour", "create_ts")


# ---- orders ------------------------------------------------------------------------

@query
def order_wide_facts(spark, sf):
    return _order_facts(spark, sf).select(
        "detail_id", "order_id", "sku_id", "sku_num", "province_id", "order_status", "user_id",
        "total_amount", "feight_fee", "split_total_amount", "create_time", "create_date",
        "create_hour")


@query
def order_wide_enriched(spark, sf):
    return _order_wide(spark, sf)


@query
def payment_wide(spark, sf):
    return orders.payment_wide(A.payment_info(spark, sf), _order_wide(spark, sf))


# ---- visitors ----------------------------------------------------------------------

@query
def new_visitor_flag(spark, sf):
    return logs.repair_is_new(_logs(spark, sf)).select(
        "pos", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"), "ts")


@query
def daily_unique_visitors(spark, sf):
    return firsts.daily_uv(_views(spark, sf)).select("mid", "pos", "page_id", "ts")


@query
def daily_uv_count(spark, sf):
    seen = _logs(spark, sf, "common.mid", "ts").select("pos", "common.mid", "ts")
    return (firsts.daily_uv(seen).groupBy(millis_to_text("ts", DAY).alias("day"))
            .agg(F.count("*").alias("uv")))


@query
def earliest_event_per_window(spark, sf):
    e = A.events(spark, sf).withColumn("hour", F.date_format("at", "yyyy-MM-dd HH"))
    return firsts.earliest(e, ["user_id", "hour"], "ts", ["event_id"]).select(
        "user_id", "hour", "event_id", "event_type", "ts")


@query
def user_jump(spark, sf):
    return sequence.user_jump(_views(spark, sf), GAP).select("mid", "pos", "page_id", "ts")


@query
def user_jump_timeout_only(spark, sf):
    return sequence.user_jump(_views(spark, sf), GAP, entry_breaks=False).select(
        "mid", "pos", "page_id", "ts")


def _steps(spark, sf):
    entry = sequence.is_entry()
    return sequence.followed_by(_views(spark, sf), entry, ~entry, GAP)


@query
def sequence_match(spark, sf):
    return _steps(spark, sf)[0].select("mid", "pos", "ts", "next_ts")


@query
def sequence_timeout(spark, sf):
    return _steps(spark, sf)[1].select("mid", "pos", "ts")


def _visitor_metrics(spark, sf):
    pages = _pages(spark, sf)
    return metrics.visitor_metrics(pages, firsts.daily_uv(pages),
                                   sequence.user_jump(pages, GAP))


@query
def visitor_metric_rows(spark, sf):
    return _visitor_metrics(spark, sf)


@query
def visitor_stats(spark, sf):
    return stats.visitor_stats(_visitor_metrics(spark, sf), HOUR, F.lit(STAT_TS))


# ---- products ----------------------------------------------------------------------

@query
def product_clicks(spark, sf):
    rows = _logs(spark, sf, *PAGE_FIELDS).where("start is null and page is not null")
    return metrics.clicks(logs.page_views(rows)).select("sku_id", "click_ct", "ts")


@query
def product_displays(spark, sf):
    shown = logs.explode_displays(logs.split_log(_logs(spark, sf))["display"])
    return metrics.displays(shown).select("sku_id", "display_ct", "ts")


@query
def product_favor_cart(spark, sf):
    both = metrics.union_all([metrics.favors(A.favor_info(spark, sf)),
                              metrics.carts(A.cart_info(spark, sf))])
    return both.select("sku_id", "favor_ct", "cart_ct", "ts")


@query
def product_order_pay_refund(spark, sf):
    wide = materialize(_order_facts(spark, sf), "dwm_order_wide")
    paid = orders.payment_wide(A.payment_info(spark, sf), wide)
    rows = metrics.union_all([metrics.orders_m(wide), metrics.payments_m(paid),
                              metrics.refunds_m(A.refund_payment(spark, sf))])
    return rows.select("sku_id", "order_sku_num", "order_amount", "payment_amount",
                       "refund_amount", "order_id", "paid_order_id", "refund_order_id", "ts")


@query
def product_comments(spark, sf):
    return metrics.comments(A.comment_info(spark, sf)).select(
        "sku_id", "comment_ct", "good_comment_ct", "ts")


@query
def product_metric_union(spark, sf):
    return _product_metrics(spark, sf).drop(metrics.CARRIES_ID)


@query
def product_stats(spark, sf):
    return _product_stats(spark, sf).drop("window")


@query
def sink_projection(spark, sf):
    return sinks.sink_projection(_product_stats(spark, sf))


@query
def product_stats_enriched(spark, sf):
    return _product_stats_enriched(spark, sf)


# ---- regions and keywords ----------------------------------------------------------

@query
def province_stats(spark, sf):
    return _province_stats(spark, sf)


@query
def province_stats_sql(spark, sf):
    return stats.province_stats_sql(_order_wide(spark, sf), ONE_DAY, STAT_TS)


def _page_maps(spark, sf):
    schema = spark.createDataFrame([], "page map<string,string>, ts bigint").schema
    return parse_typed(A.page_map_topic(spark, sf), schema)


@query
def search_filter(spark, sf):
    return stats.searches(_page_maps(spark, sf)).select("pos", "kw", "ts")


@query
def keyword_tokens(spark, sf):
    part = A.table(spark, sf, "part").select("p_partkey", "p_name")
    return explode_words(part, "p_name").select("p_partkey", "word")


@query
def document_words(spark, sf):
    docs = A.table(spark, sf, "documents").select("doc_id", "text")
    return (explode_words(docs, "text").groupBy("word")
            .agg(F.count("*").alias("documents")))


@query
def search_keyword_stats(spark, sf):
    return stats.search_keyword_stats(_page_maps(spark, sf), HOUR, F.lit(STAT_TS))


@query
def any_metric_positive(spark, sf):
    return any_positive(_product_stats_enriched(spark, sf), list(stats.KEYWORD_COUNTERS)).select(
        "stt", "sku_id", *stats.KEYWORD_COUNTERS)


@query
def unpivot_metrics(spark, sf):
    rows = _product_stats_enriched(spark, sf).select("stt", "sku_id", *stats.KEYWORD_COUNTERS)
    return positive_counters(rows, list(stats.KEYWORD_COUNTERS))


@query
def product_keyword_stats(spark, sf):
    return stats.product_keyword_stats(_product_stats_enriched(spark, sf), F.lit(STAT_TS))


# ---- serving -----------------------------------------------------------------------

@query
def gmv_day(spark, sf):
    return serving.gmv(_product_stats_enriched(spark, sf, _span(SALES_DAY)), SALES_DAY)


@query
def gmv_by_brand_day(spark, sf):
    return serving.gmv_by_brand(_product_stats_enriched(spark, sf, _span(SALES_DAY)), SALES_DAY)


@query
def sales_by_province_day(spark, sf):
    return serving.sales_by_province(_province_stats(spark, sf, _span(SALES_DAY)), SALES_DAY)


@query
def gmv_payload(spark, sf):
    return serving.gmv_payload(gmv_day(spark, sf))


@query
def brand_chart_payload(spark, sf):
    return serving.brand_payload(gmv_by_brand_day(spark, sf))


@query
def province_chart_payload(spark, sf):
    return serving.province_payload(sales_by_province_day(spark, sf))


# ---- windows, late rows, versions --------------------------------------------------

@query
def tumbling_window_counts(spark, sf):
    counts = A.events(spark, sf).groupBy(windows.tumble("at", HOUR)).agg(
        F.count("*").alias("n"))
    return windows.window_bounds(counts).select("stt", "edt", "n")


@query
def late_rows_split(spark, sf):
    counts = windows.lateness(A.deliveries(spark, sf), "ordered", "arrived", WEEK, LATE_DELAY)
    return windows.window_bounds(counts).drop("window")


@query
def latest_version_per_key(spark, sf):
    # Each event is a new version of the row of its type and number.
    seen = A.events(spark, sf).select("event_type", F.col("k").alias("keyword"), "ts",
                                      F.col("event_id").alias("version"), "value")
    return firsts.latest_version(seen, ["event_type", "keyword"], "ts", ["version"]).select(
        "event_type", "keyword", "version", "value", "ts")
