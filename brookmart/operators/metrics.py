"""Facts turned into rows of one metric shape, ready for union and aggregation.

A metric row counts what one record contributes and holds zero elsewhere.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmart.operators.sequence import is_entry
from brookmart.schemas import GOOD_APPRAISALS, MONEY

VISITOR_KEYS = ("vc", "ch", "ar", "is_new")
VISITOR_SUMS = ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")

PRODUCT_COUNTS = ("display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num",
                  "comment_ct", "good_comment_ct")
PRODUCT_AMOUNTS = ("order_amount", "payment_amount", "refund_amount")
PRODUCT_IDS = {"order_ct": "order_id", "paid_order_ct": "paid_order_id",
               "refund_order_ct": "refund_order_id"}
# Whether a kind of product row may carry an id.
CARRIES_ID = "carries_id"


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _visitor_fields(**counts: Column) -> list[Column]:
    return [counts.get(c, F.lit(0)).cast("bigint").alias(c) for c in VISITOR_SUMS]


def visitor_metrics(pages: DataFrame, uv: DataFrame, uj: DataFrame) -> DataFrame:
    """Page views with stay, session entries, daily visitors and bounces as metric rows.

    Inputs are flat page rows.  A page view and the session entry it may open come from
    one pass over the pages.  A missing stay counts as zero.
    """
    stay = F.coalesce("during_time", F.lit(0))
    view = F.struct(*_visitor_fields(pv_ct=F.lit(1), dur_sum=stay))
    entry = F.struct(*_visitor_fields(sv_ct=F.lit(1)))
    kinds = F.when(is_entry(), F.array(view, entry)).otherwise(F.array(view))
    kept = (*VISITOR_KEYS, "ts")
    return union_all([
        pages.select(*kept, F.inline(kinds)),
        uv.select(*kept, *_visitor_fields(uv_ct=F.lit(1))),
        uj.select(*kept, *_visitor_fields(uj_ct=F.lit(1))),
    ])


def _millis(text_time: str) -> str:
    return f"unix_millis(try_cast({text_time} as timestamp))"


def _product_row(df: DataFrame, ts: str, sku: str = "sku_id", **values: str) -> DataFrame:
    """Metric rows from SQL expressions; what is not given is zero, or null for ids."""
    carries = any(c in values for c in PRODUCT_IDS.values())
    return df.selectExpr(
        f"try_cast({sku} as bigint) as sku_id",
        *[f"cast({values.get(c, '0')} as bigint) as {c}" for c in PRODUCT_COUNTS],
        *[f"cast({values.get(c, '0')} as {MONEY.simpleString()}) as {c}"
          for c in PRODUCT_AMOUNTS],
        *[f"cast({values.get(c, 'null')} as bigint) as {c}" for c in PRODUCT_IDS.values()],
        f"{ts} as ts", f"{str(carries).lower()} as {CARRIES_ID}")


def clicks(pages: DataFrame) -> DataFrame:
    """Flat page rows about a product."""
    return _product_row(pages.where("item_type = 'sku_id'"), "ts", "item", click_ct="1")


def displays(shown: DataFrame) -> DataFrame:
    """Flat display rows about a product."""
    return _product_row(shown.where("item_type = 'sku_id'"), "ts", "item", display_ct="1")


# What `seen` reads of log records.
SEEN_FIELDS = ("start", "page.item", "page.item_type", "displays", "ts")


def seen(logs: DataFrame) -> DataFrame:
    """`clicks` and `displays` of log records in one pass, so that a text is parsed once.

    A page's item and item type replace those of its displays.
    """
    def row(click: int, item: str, kind: str) -> str:
        return (f"named_struct('click', {click}, 'display', {1 - click}, 'item', {item},"
                f" 'item_type', {kind})")

    shown = row(0, "coalesce(page.item, d.item)", "coalesce(page.item_type, d.item_type)")
    rows = logs.where("start is null").selectExpr("ts", f"""inline(concat(
        if(page is null, array(), array({row(1, "page.item", "page.item_type")})),
        if(displays is null, array(), transform(displays, d -> {shown}))))""")
    return _product_row(rows.where("item_type = 'sku_id'"), "ts", "item",
                        click_ct="click", display_ct="display")


def favors(df: DataFrame) -> DataFrame:
    return _product_row(df, _millis("create_time"), favor_ct="1")


def carts(df: DataFrame) -> DataFrame:
    return _product_row(df, _millis("create_time"), cart_ct="1")


def orders_m(wide: DataFrame) -> DataFrame:
    return _product_row(wide, _millis("create_time"), order_amount="split_total_amount",
                        order_sku_num="sku_num", order_id="order_id")


def payments_m(paid: DataFrame) -> DataFrame:
    return _product_row(paid, _millis("payment_create_time"),
                        payment_amount="split_total_amount", paid_order_id="order_id")


def refunds_m(df: DataFrame) -> DataFrame:
    return _product_row(df, _millis("create_time"), refund_amount="total_amount",
                        refund_order_id="order_id")


def comments(df: DataFrame) -> DataFrame:
    good = f"case when appraise in {GOOD_APPRAISALS} then 1 else 0 end"
    return _product_row(df, _millis("create_time"), comment_ct="1", good_comment_ct=good)
