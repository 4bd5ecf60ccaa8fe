"""Shop records made from the TPC-H-like test tables, row by row.

Only what the tables lack is derived; see FIXTURES.md, section 5.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmart.schemas import MONEY

ZERO = "0.00"
FREIGHT = "5.00"


@cache
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Start and end of a time span; the end is left out.
Span = tuple[datetime, datetime]


def facts(spark: SparkSession, sf_dir: str, name: str, at: str, span: Span | None = None
          ) -> DataFrame:
    """A fact table, or its rows with `at` inside the span: a filter that reaches the scan."""
    df = table(spark, sf_dir, name)
    if span is None:
        return df
    lo, hi = (F.lit(f"{t:%Y-%m-%d %H:%M:%S}").cast("timestamp_ntz") for t in span)
    return df.where((F.col(at) >= lo) & (F.col(at) < hi))


def events(spark: SparkSession, sf_dir: str, span: Span | None = None) -> DataFrame:
    """Events with zoned time, epoch milliseconds, and the number inside `props`."""
    df = facts(spark, sf_dir, "events", "ts", span)
    at = F.col("ts").cast("timestamp")
    return df.select("event_id", at.alias("at"), F.unix_millis(at).alias("ts"), "user_id",
                     "event_type", "value",
                     F.get_json_object("props", "$.k").cast("bigint").alias("k"))


def _time_text(c: Column | str) -> Column:
    """'yyyy-MM-dd HH:mm:ss'."""
    return F.date_trunc("second", c).cast("string")


def _item_type() -> Column:
    return (F.when(F.col("event_type").isin("click", "view"), "sku_id")
             .when(F.col("event_type") == "error", "keyword"))


def _cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def _page(item: Column, more: Sequence[Column] = ()) -> Column:
    entry = F.col("event_type").isin("signup", "view")
    page_id = F.when(F.col("event_type") == "error", "good_list").otherwise(F.col("event_type"))
    return F.struct(
        page_id.alias("page_id"), F.when(~entry, "home").alias("last_page_id"),
        F.when(_item_type().isNotNull(), item).alias("item"),
        _item_type().alias("item_type"), _cents("value").alias("during_time"), *more)


def _text(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def _more(wanted: bool, **columns: str) -> list[Column]:
    return [F.col(c).alias(name) for name, c in columns.items()] if wanted else []


def log_topic(spark: SparkSession, sf_dir: str, span: Span | None = None,
              more: bool = False) -> DataFrame:
    """Client log records as JSON text with their position.

    With `more`, records have fields besides those that the typed readers know.
    """
    e = events(spark, sf_dir, span)
    user, k = F.col("user_id"), F.col("k")
    common = F.struct(
        user.cast("string").alias("mid"), _text("v", user % 4).alias("vc"),
        _text("ch", user % 3).alias("ch"), _text("ar", user % 5).alias("ar"),
        F.lit("1").alias("is_new"), *_more(more, uid="user_id", os="event_type"))
    is_start = (F.col("event_type") == "signup") & (k % 2 == 0)
    start = F.when(is_start, F.struct(F.lit("icon").alias("entry")))
    displays = F.transform(F.sequence(F.lit(0), k % 3), lambda i: F.struct(
        (k + i + 1).cast("string").alias("item"), F.lit("sku_id").alias("item_type"),
        F.lit("query").alias("display_type"), i.alias("order"), (i + 1).alias("pos_id"),
        *_more(more, extra="k")))
    page = _page(k.cast("string"), _more(more, source_type="event_type"))
    error = F.when(k % 5 == 0, F.struct(k.alias("code"), F.lit("slow").alias("msg")))
    record = F.struct(common.alias("common"), start.alias("start"), page.alias("page"),
                      displays.alias("displays"), "ts", *([error.alias("err")] if more else []))
    return e.select(F.to_json(record).alias("value"), F.col("event_id").alias("pos"))


def page_map_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page records with a map of text for `page`; the words searched for are part names."""
    e = events(spark, sf_dir)
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    named = e.join(part, e["k"] == part["p_partkey"], "left")
    item = F.when(F.col("event_type") == "error", F.col("p_name")).otherwise(
        F.col("k").cast("string"))
    record = F.struct(_page(item).alias("page"), "ts")
    return named.select(F.to_json(record).alias("value"), F.col("event_id").alias("pos"))


def change_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Database change records as JSON text."""
    e = events(spark, sf_dir)
    kind = F.element_at(F.array(*map(F.lit, ("insert", "update", "bootstrap-insert",
                                             "delete"))), (F.col("k") % 4 + 1).cast("int"))
    record = F.struct(
        F.when(F.col("k") % 10 == 0, "other").otherwise("shop").alias("database"),
        F.col("event_type").alias("table"), kind.alias("type"),
        F.floor(F.col("ts") / 1000).alias("ts"), F.col("event_id").alias("xid"),
        F.col("k").alias("xoffset"), F.struct("event_id", "user_id", "value").alias("data"))
    return e.select(F.to_json(record).alias("value"))


def config_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of the configuration table: every event rewrites the row of its key."""
    e = events(spark, sf_dir)
    kinds = F.array(*map(F.lit, ("+I", "+U", "-U", "-D")))
    lists = F.array(*map(F.lit, ("user_id,event_id,value", "user_id,event_id",
                                 "user_id, value")))
    is_dim = F.col("event_type").isin("view", "signup")
    return e.select(
        F.element_at(kinds, (F.col("event_id") % 4 + 1).cast("int")).alias("kind"),
        F.col("event_type").alias("source_table"),
        F.when(F.col("k") % 2 == 0, "insert").otherwise("update").alias("operate_type"),
        F.when(is_dim, "hbase").when(F.col("event_type") == "error", "other")
         .otherwise("kafka").alias("sink_type"),
        F.concat(F.when(is_dim, "dim_").otherwise("dwd_"), "event_type").alias("sink_table"),
        F.element_at(lists, (F.col("event_id") % 3 + 1).cast("int")).alias("sink_columns"),
        F.lit("user_id").alias("sink_pk"), F.lit(None).cast("string").alias("sink_extend"),
        F.col("ts").alias("seq"), F.col("event_id").alias("seq2"))


def _money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY)


def order_info(spark: SparkSession, sf_dir: str, span: Span | None = None) -> DataFrame:
    at = _time_text("o_orderdate")
    nothing = F.lit(None).cast("string")
    return facts(spark, sf_dir, "orders", "o_orderdate", span).select(
        F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 25).alias("province_id"),
        F.col("o_orderstatus").alias("order_status"), F.col("o_custkey").alias("user_id"),
        _money("o_totalprice").alias("total_amount"),
        _money(F.lit(ZERO)).alias("activity_reduce_amount"),
        _money(F.lit(ZERO)).alias("coupon_reduce_amount"),
        _money("o_totalprice").alias("original_total_amount"),
        _money(F.lit(FREIGHT)).alias("feight_fee"), nothing.alias("expire_time"),
        at.alias("create_time"), nothing.alias("operate_time"))


def order_detail(spark: SparkSession, sf_dir: str, span: Span | None = None) -> DataFrame:
    return facts(spark, sf_dir, "lineitem", "l_shipdate", span).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku_id"),
        _money(F.lit(ZERO)).alias("sku_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.lit(None).cast("string").alias("sku_name"),
        _time_text("l_shipdate").alias("create_time"),
        _money("l_extendedprice").alias("split_total_amount"),
        _money(F.lit(ZERO)).alias("split_activity_amount"),
        _money(F.lit(ZERO)).alias("split_coupon_amount"))


def payment_info(spark: SparkSession, sf_dir: str, span: Span | None = None) -> DataFrame:
    """Payments of the orders in the span."""
    paid = facts(spark, sf_dir, "orders", "o_orderdate", span).where(
        F.col("o_orderstatus").isin("F", "P"))
    # A payment is made up to an hour after the order, by order number.
    late = F.make_dt_interval(mins=(F.col("o_orderkey") % 60).cast("int"))
    at = _time_text(F.col("o_orderdate") + late)
    return paid.select(
        (F.col("o_orderkey") + 1_000_000).alias("id"), F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"), _money("o_totalprice").alias("total_amount"),
        F.col("o_orderpriority").alias("subject"), F.lit("1101").alias("payment_type"),
        at.alias("create_time"), at.alias("callback_time"))


def favor_info(spark: SparkSession, sf_dir: str, span: Span | None = None,
               event_type: str = "signup") -> DataFrame:
    return events(spark, sf_dir, span).where(F.col("event_type") == event_type).select(
        F.col("k").alias("sku_id"), _time_text("at").alias("create_time"))


def cart_info(spark: SparkSession, sf_dir: str, span: Span | None = None) -> DataFrame:
    return favor_info(spark, sf_dir, span, "purchase")


def refund_payment(spark: SparkSession, sf_dir: str, span: Span | None = None) -> DataFrame:
    back = facts(spark, sf_dir, "lineitem", "l_shipdate", span).where(F.col("l_returnflag") == "R")
    return back.select(
        F.col("l_partkey").alias("sku_id"), F.col("l_orderkey").alias("order_id"),
        _money("l_extendedprice").alias("total_amount"),
        _time_text("l_shipdate").alias("create_time"))


def comment_info(spark: SparkSession, sf_dir: str, span: Span | None = None) -> DataFrame:
    return facts(spark, sf_dir, "lineitem", "l_shipdate", span).select(
        F.col("l_partkey").alias("sku_id"),
        _text("120", (F.col("l_linenumber") - 1) % 5 + 1).alias("appraise"),
        _time_text("l_shipdate").alias("create_time"))


@cache
def dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The six dimensions, every column text."""
    part = table(spark, sf_dir, "part")
    tm_id = F.substring_index("p_brand", "#", -1)
    # A type is numbered by its first letter and length.
    category_id = F.ascii("p_type") * 100 + F.length("p_type")
    parts = {
        "user_info": table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("id"),
            F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
            F.date_add(F.to_date(F.lit("1950-01-01")), (F.col("c_custkey") % 18000).cast("int"))
             .alias("birthday")),
        "base_province": table(spark, sf_dir, "nation").join(
            table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"),
                    _text("N-", F.col("n_nationkey")).alias("iso_3166_2"),
                    F.col("n_regionkey").alias("area_code"), F.col("r_name").alias("iso_code")),
        "sku_info": part.select(
            F.col("p_partkey").alias("id"), F.col("p_name").alias("sku_name"),
            _money("p_retailprice").alias("price"), (F.col("p_partkey") % 10).alias("spu_id"),
            tm_id.alias("tm_id"), category_id.alias("category3_id")),
        "spu_info": table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").alias("id"), F.col("s_name").alias("spu_name")),
        "base_trademark": part.select(tm_id.alias("id"), F.col("p_brand").alias("tm_name"))
            .distinct(),
        "base_category3": part.select(category_id.alias("id"), F.col("p_type").alias("name"))
            .distinct(),
    }
    return {name: df.selectExpr([f"cast({c} as string) as {c}" for c in df.columns])
            for name, df in parts.items()}


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the day of the order and the day on which their own record came."""
    days = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").cast(
        "timestamp").alias("ordered"))
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber",
        F.to_date("l_shipdate").cast("timestamp").alias("arrived"))
    return lines.join(days, "o_orderkey")
