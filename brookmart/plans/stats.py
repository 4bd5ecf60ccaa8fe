"""Windowed statistics of visitors, products, regions and keywords."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmart.functions.keywords import any_positive, explode_words, positive_counters
from brookmart.functions.times import event_time, now_millis, text_to_time, utc_to_zone
from brookmart.operators.metrics import (CARRIES_ID, PRODUCT_AMOUNTS, PRODUCT_COUNTS,
                                         PRODUCT_IDS, VISITOR_KEYS, VISITOR_SUMS)
from brookmart.operators.windows import count_once, tumble, window_bounds, with_event_time
from brookmart.schemas import MONEY

WINDOW = "5 seconds"
VISITOR_DELAY = "20 seconds"
PRODUCT_DELAY = "10 seconds"
SQL_DELAY = "3 seconds"
KEYWORD_DELAY = "1 day"

KEYWORD_COUNTERS = ("click_ct", "cart_ct", "order_ct")


def _stamp(stat_ts: Column | None) -> Column:
    """Time of the statistic: now, unless a run is to be repeatable."""
    return (now_millis() if stat_ts is None else stat_ts).cast("bigint").alias("ts")


def visitor_stats(metrics: DataFrame, window: str = WINDOW, stat_ts: Column | None = None,
                  delay: str = VISITOR_DELAY) -> DataFrame:
    """Visitor metric rows summed by window, version, channel, area and newness."""
    timed = with_event_time(metrics, event_time("ts"), delay)
    sums = (timed.groupBy(tumble("et", window), *VISITOR_KEYS)
                 .agg(*[F.sum(c).alias(c) for c in VISITOR_SUMS]))
    return window_bounds(sums).select("stt", "edt", *VISITOR_KEYS, *VISITOR_SUMS,
                                      _stamp(stat_ts))


def product_stats(metrics: DataFrame, window: str = WINDOW, stat_ts: Column | None = None,
                  delay: str = PRODUCT_DELAY) -> DataFrame:
    """Product metric rows summed by window and product, orders counted once each.

    The `window` column is for further use and is not written to result tables.
    """
    timed = with_event_time(metrics, event_time("ts"), delay)
    sums = count_once(timed, tumble("et", window), ["sku_id"], PRODUCT_IDS,
                      [*PRODUCT_COUNTS, *PRODUCT_AMOUNTS],
                      CARRIES_ID if CARRIES_ID in metrics.columns else None)
    money = [F.col(c).cast(MONEY).alias(c) for c in PRODUCT_AMOUNTS]
    return window_bounds(sums).select(
        F.col("window").alias("window", metadata={"sink": False}), "stt", "edt", "sku_id",
        *PRODUCT_COUNTS, *money, *PRODUCT_IDS, _stamp(stat_ts))


_PROVINCE = {"province_id": "province_id", "province_name": "province_name",
             "area_code": "province_area_code", "iso_code": "province_iso_code",
             "iso_3166_2": "province_3166_2_code"}


def province_stats(wide: DataFrame, window: str = WINDOW, stat_ts: Column | None = None,
                   delay: str = SQL_DELAY) -> DataFrame:
    """Amount and number of orders by window and region."""
    timed = with_event_time(wide, text_to_time("create_time"), delay)
    named = timed.select("et", "order_id", F.col("split_total_amount").alias("order_amount"),
                         *[F.col(c).alias(out) for out, c in _PROVINCE.items()])
    sums = count_once(named, tumble("et", window), [*_PROVINCE],
                      {"order_count": "order_id"}, ["order_amount"])
    return window_bounds(sums).select(
        *_PROVINCE, "stt", "edt", F.col("order_amount").cast(MONEY).alias("order_amount"),
        "order_count", _stamp(stat_ts))


PROVINCE_SQL = """
    select province_id, province_name, area_code, iso_code, iso_3166_2,
           date_format(w.start, 'yyyy-MM-dd HH:mm:ss') as stt,
           date_format(w.end, 'yyyy-MM-dd HH:mm:ss') as edt,
           cast(sum(amount) as decimal(20, 2)) as order_amount,
           count(order_id) as order_count,
           {stat_ts} as ts
    from (select window(et, '{size}') as w, province_id, province_name,
                 province_area_code as area_code, province_iso_code as iso_code,
                 province_3166_2_code as iso_3166_2, order_id,
                 sum(split_total_amount) as amount
          from {{wide}}
          group by window(et, '{size}'), province_id, province_name, province_area_code,
                   province_iso_code, province_3166_2_code, order_id) as per_order
    group by w, province_id, province_name, area_code, iso_code, iso_3166_2
"""


def province_stats_sql(wide: DataFrame, window: str = WINDOW, stat_ts: int | None = None,
                       delay: str = SQL_DELAY) -> DataFrame:
    """`province_stats` as a SQL statement."""
    timed = with_event_time(wide, text_to_time("create_time"), delay)
    stamp = ("unix_millis(current_timestamp())" if stat_ts is None
             else f"cast({int(stat_ts)} as bigint)")
    return wide.sparkSession.sql(PROVINCE_SQL.format(size=window, stat_ts=stamp), wide=timed)


def searches(pages: DataFrame) -> DataFrame:
    """What was searched for, from page records whose `page` is a map of text."""
    page = F.col("page")
    hit = ((page["page_id"] == "good_list") & (page["item_type"] == "keyword")
           & page["item"].isNotNull())
    rest = [c for c in pages.columns if c != "page"]
    return pages.where(hit).select(page["item"].alias("kw"), *rest)


def search_keyword_stats(pages: DataFrame, window: str = WINDOW,
                         stat_ts: Column | None = None, delay: str = SQL_DELAY,
                         zone: str = "Asia/Shanghai",
                         segmenter: Callable[[Column], Column] | None = None) -> DataFrame:
    """How often each word was searched for in each window."""
    timed = with_event_time(pages, event_time("ts"), delay)
    words = explode_words(searches(timed), "kw", segmenter=segmenter)
    counts = (words.groupBy(tumble("et", window), F.col("word").alias("keyword"))
                   .agg(F.count("*").alias("ct")))
    return window_bounds(counts).select(
        utc_to_zone("stt", zone).alias("stt"), utc_to_zone("edt", zone).alias("edt"),
        "keyword", F.lit("search").alias("source"), "ct", _stamp(stat_ts))


def product_words(stats: DataFrame,
                  segmenter: Callable[[Column], Column] | None = None) -> DataFrame:
    """Words of the names of active products, one row per positive counter."""
    active = any_positive(stats, list(KEYWORD_COUNTERS))
    words = explode_words(active.select("stt", "edt", "sku_name", *KEYWORD_COUNTERS),
                          "sku_name", "keyword", segmenter)
    return positive_counters(words.drop("sku_name"), list(KEYWORD_COUNTERS))


def product_keyword_stats(stats: DataFrame, stat_ts: Column | None = None,
                          segmenter: Callable[[Column], Column] | None = None,
                          delay: str = KEYWORD_DELAY) -> DataFrame:
    """Counters of products summed by the words of their names.

    On a stream this is a running total: use update mode, and read the result with
    `latest_version` over (stt, edt, keyword, source).  Totals of windows that ended more than
    `delay` before the newest one leave the state.
    """
    words = product_words(stats, segmenter)
    keys = ["stt", "edt", "keyword", "source"]
    if stats.isStreaming:
        words = with_event_time(words, text_to_time("edt"), delay)
        keys.append("et")
    sums = words.groupBy(*keys).agg(F.sum("ct").alias("ct"))
    return sums.drop("et").withColumn("ts", _stamp(stat_ts))
