"""Record shapes, topic names and code values."""

from __future__ import annotations

from pyspark.sql import types as T

# Topic and table names of the layers.
ODS_LOG = "ods_log"
ODS_DB = "ods_db"
DWD_START = "dwd_start"
DWD_PAGE = "dwd_page"
DWD_DISPLAY = "dwd_display"
DWD_ORDER_INFO = "dwd_order_info"
DWD_ORDER_DETAIL = "dwd_order_detail"
DWD_PAYMENT_INFO = "dwd_payment_info"
DWD_FAVOR_INFO = "dwd_favor_info"
DWD_CART_INFO = "dwd_cart_info"
DWD_REFUND_PAYMENT = "dwd_refund_payment"
DWD_COMMENT_INFO = "dwd_comment_info"
DWM_UV = "dwm_uv"
DWM_UJ = "dwm_uj"
DWM_ORDER_WIDE = "dwm_order_wide"
DWM_PAYMENT_WIDE = "dwm_payment_wide"
DWS_PRODUCT_STATS = "dws_product_stats"
DWS_VISITORS = "dws_visitors"

# Where a configured table goes.
SINK_TOPIC = "kafka"
SINK_DIM = "hbase"

# Appraise codes that count as a good comment (five and four stars).
GOOD_APPRAISALS = ("1205", "1204")

# The pattern of times and dates in text.
DATETIME = "yyyy-MM-dd HH:mm:ss"
DAY = "yyyy-MM-dd"

MONEY = T.DecimalType(20, 2)


_ATOMS = {"string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(),
          "money": MONEY}


def _struct(columns: str, **nested: T.DataType) -> T.StructType:
    """'id bigint, name string' -> schema; works before any session exists."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, nested.get(name) or _ATOMS[kind])
                         for name, kind in pairs])


LOG = _struct(
    "common nested, start nested, page nested, displays nested, ts bigint",
    common=_struct("mid string, vc string, ch string, ar string, is_new string"),
    start=_struct("entry string"),
    page=_struct("page_id string, last_page_id string, item string, item_type string, "
                 "during_time bigint"),
    displays=T.ArrayType(_struct("item string, item_type string, display_type string, "
                                 "order bigint, pos_id bigint")))

DISPLAY = _struct("""
    mid string, vc string, ch string, ar string, is_new string, page_id string,
    last_page_id string, item string, item_type string, during_time bigint,
    display_type string, order bigint, pos_id bigint, ts bigint""")

CHANGELOG = _struct("""
    database string, table string, type string, ts bigint, xid bigint,
    xoffset bigint, data string""")

CONFIG = _struct("""
    source_table string, operate_type string, sink_type string, sink_table string,
    sink_columns string, sink_pk string, sink_extend string""")

ORDER_INFO = _struct("""
    id bigint, province_id bigint, order_status string, user_id bigint,
    total_amount money, activity_reduce_amount money,
    coupon_reduce_amount money, original_total_amount money,
    feight_fee money, expire_time string, create_time string,
    operate_time string""")

ORDER_DETAIL = _struct("""
    id bigint, order_id bigint, sku_id bigint, sku_price money, sku_num bigint,
    sku_name string, create_time string, split_total_amount money,
    split_activity_amount money, split_coupon_amount money""")

PAYMENT_INFO = _struct("""
    id bigint, order_id bigint, user_id bigint, total_amount money,
    subject string, payment_type string, create_time string, callback_time string""")

FAVOR_INFO = _struct("sku_id bigint, create_time string")
CART_INFO = _struct("sku_id bigint, create_time string")
REFUND_PAYMENT = _struct(
    "sku_id bigint, order_id bigint, total_amount money, create_time string")
COMMENT_INFO = _struct("sku_id bigint, appraise string, create_time string")

ORDER_WIDE = _struct("""
    detail_id bigint, order_id bigint, sku_id bigint, sku_price money,
    sku_num bigint, sku_name string, province_id bigint, order_status string,
    user_id bigint, total_amount money, activity_reduce_amount money,
    coupon_reduce_amount money, original_total_amount money,
    feight_fee money, split_feight_fee money,
    split_activity_amount money, split_coupon_amount money,
    split_total_amount money, expire_time string, create_time string,
    operate_time string, create_date string, create_hour string, province_name string,
    province_area_code string, province_iso_code string, province_3166_2_code string,
    user_age int, user_gender string, spu_id bigint, tm_id bigint, category3_id bigint,
    spu_name string, tm_name string, category3_name string""")

PAYMENT_WIDE = _struct("""
    payment_id bigint, subject string, payment_type string, payment_create_time string,
    callback_time string, detail_id bigint, order_id bigint, sku_id bigint,
    sku_price money, sku_num bigint, sku_name string, province_id bigint,
    order_status string, user_id bigint, total_amount money,
    activity_reduce_amount money, coupon_reduce_amount money,
    original_total_amount money, feight_fee money,
    split_feight_fee money, split_activity_amount money,
    split_coupon_amount money, split_total_amount money,
    order_create_time string, province_name string, province_area_code string,
    province_iso_code string, province_3166_2_code string, user_age int,
    user_gender string, spu_id bigint, tm_id bigint, category3_id bigint,
    spu_name string, tm_name string, category3_name string""")

PRODUCT_STATS = _struct("""
    stt string, edt string, sku_id bigint, sku_name string, sku_price money,
    spu_id bigint, spu_name string, tm_id bigint, tm_name string, category3_id bigint,
    category3_name string, display_ct bigint, click_ct bigint, favor_ct bigint,
    cart_ct bigint, order_sku_num bigint, order_amount money, order_ct bigint,
    payment_amount money, paid_order_ct bigint, refund_order_ct bigint,
    refund_amount money, comment_ct bigint, good_comment_ct bigint, ts bigint""")
