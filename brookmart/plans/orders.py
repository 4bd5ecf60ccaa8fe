"""Orders joined with their lines, payments and dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brookmart.functions.times import age_in_years, text_to_millis, text_to_time
from brookmart.operators.enrich import DimSpec, enrich, enrich_product
from brookmart.operators.intervals import interval_join
from brookmart.operators.windows import with_event_time
from brookmart.schemas import ORDER_WIDE, PAYMENT_WIDE

# The line of an order is written at most this far before or after the order.
ORDER_SLACK = "10 seconds"
# An order is paid within this time; the payment may be stamped slightly early.
PAY_WINDOW = "45 minutes"
PAY_SLACK = "5 seconds"
ORDER_DELAY = "3 seconds"


def order_info_derive(info: DataFrame) -> DataFrame:
    """Add day, hour and epoch ms of the creation time."""
    return (info.withColumn("create_date", F.substring("create_time", 1, 10))
                .withColumn("create_hour", F.substring("create_time", 12, 2))
                .withColumn("create_ts", text_to_millis("create_time")))


def _prefixed(df: DataFrame, prefix: str, at: str, delay: str) -> DataFrame:
    timed = with_event_time(df, text_to_time(at), delay)
    return timed.toDF(*[prefix + c for c in timed.columns])


def _conform(df: DataFrame, schema: StructType, sources: dict[str, str]) -> DataFrame:
    """Columns of `schema` from expressions; null where nothing fills them."""
    return df.selectExpr([
        f"cast({sources.get(f.name, 'null')} as {f.dataType.simpleString()}) as {f.name}"
        for f in schema])


def order_wide_facts(info: DataFrame, detail: DataFrame, lower: str = ORDER_SLACK,
                     upper: str = ORDER_SLACK, delay: str = ORDER_DELAY) -> DataFrame:
    """Orders with their lines, dimension columns still empty.

    Price and name of the product are left to the dimension; the expiry and operation
    times and the split freight are never filled.
    """
    left = _prefixed(order_info_derive(info), "i_", "create_time", delay)
    right = _prefixed(detail, "d_", "create_time", delay)
    both = interval_join(left, right, ("i_id", "d_order_id"), ("i_et", "d_et"), lower, upper)
    of_order = ("order_status", "create_time", "create_date", "create_hour",
                "activity_reduce_amount", "coupon_reduce_amount", "original_total_amount",
                "feight_fee", "total_amount", "province_id", "user_id")
    of_line = ("sku_id", "sku_name", "sku_num", "split_activity_amount",
               "split_coupon_amount", "split_total_amount")
    sources = {"order_id": "i_id", "detail_id": "d_id"}
    sources |= {c: f"i_{c}" for c in of_order}
    sources |= {c: f"d_{c}" for c in of_line}
    return _conform(both, ORDER_WIDE, sources)


def enrich_order(wide: DataFrame, dims: dict[str, DataFrame], as_of: Column | None = None,
                 how: str = "inner", keep: tuple[str, ...] = ()) -> DataFrame:
    """Fill in the user, region and product columns from six dimensions."""
    as_of = F.current_date() if as_of is None else as_of
    filled = ("user_gender", "user_age", "province_name", "province_area_code",
              "province_iso_code", "province_3166_2_code", "sku_name", "sku_price",
              "spu_id", "spu_name", "tm_id", "tm_name", "category3_id", "category3_name")
    users = DimSpec(dims["user_info"], "user_id", {
        "user_gender": "gender", "user_age": age_in_years("birthday", as_of)})
    regions = DimSpec(dims["base_province"], "province_id", {
        "province_name": "name", "province_area_code": "area_code",
        "province_iso_code": "iso_code", "province_3166_2_code": "iso_3166_2"})
    out = enrich(wide.drop(*filled), [regions, users], how)
    return enrich_product(out, dims, how).select(*ORDER_WIDE.names, *keep)


def payment_wide(payments: DataFrame, wide: DataFrame, before: str = PAY_WINDOW,
                 after: str = PAY_SLACK, delay: str = ORDER_DELAY) -> DataFrame:
    """Payments with the order lines they pay for, one row per line.

    User and total amount are the payment's, everything else the order's.
    """
    left = _prefixed(payments, "p_", "create_time", delay)
    right = _prefixed(wide, "w_", "create_time", delay)
    both = interval_join(left, right, ("p_order_id", "w_order_id"), ("p_et", "w_et"),
                         before, after)
    sources = {c: f"w_{c}" for c in ORDER_WIDE.names}
    sources |= {c: f"p_{c}" for c in ("order_id", "user_id", "total_amount", "subject",
                                      "payment_type", "callback_time")}
    sources |= {"payment_id": "p_id", "payment_create_time": "p_create_time",
                "order_create_time": "w_create_time"}
    return _conform(both, PAYMENT_WIDE, sources)
