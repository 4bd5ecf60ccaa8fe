"""Daily sales figures read from the result tables, and their chart documents."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmart.schemas import MONEY


def of_day(stats: DataFrame, yyyymmdd: int) -> DataFrame:
    """Rows whose window starts on the day.

    A range over the stored text, which reaches the Parquet scan; a table partitioned by
    `day` is also pruned to one partition.
    """
    day = datetime.strptime(str(yyyymmdd), "%Y%m%d")
    lo, hi = f"{day:%Y-%m-%d}", f"{day + timedelta(days=1):%Y-%m-%d}"
    rows = stats.where((F.col("stt") >= lo) & (F.col("stt") < hi))
    return rows.where(F.col("day") == lo) if "day" in stats.columns else rows


def _money(c: str) -> Column:
    return F.sum(c).cast(MONEY).alias(c)


def gmv(product_stats: DataFrame, yyyymmdd: int) -> DataFrame:
    return of_day(product_stats, yyyymmdd).agg(_money("order_amount"))


def gmv_by_brand(product_stats: DataFrame, yyyymmdd: int) -> DataFrame:
    return of_day(product_stats, yyyymmdd).groupBy("tm_name").agg(_money("order_amount"))


def sales_by_province(province_stats: DataFrame, yyyymmdd: int) -> DataFrame:
    """Orders are added up over windows: one that shows in two windows counts twice."""
    return (of_day(province_stats, yyyymmdd).groupBy("province_name")
            .agg(_money("order_amount"), F.sum("order_count").alias("order_count")))


def _document(data: Column) -> Column:
    return F.to_json(F.struct(F.lit(0).alias("status"), F.lit("").alias("msg"),
                              data.alias("data"))).alias("payload")


def gmv_payload(gmv_row: DataFrame) -> DataFrame:
    return gmv_row.select(_document(F.col("order_amount")))


def brand_payload(by_brand: DataFrame) -> DataFrame:
    """One chart document; it lists every brand, in order of name."""
    brands = F.array_sort(F.collect_list(F.struct("tm_name", "order_amount")))
    # Fixed value: title of the series.
    series = F.struct(F.lit("商品品牌").alias("name"),
                      F.col("b.order_amount").alias("data"))
    data = F.struct(F.col("b.tm_name").alias("categories"), F.array(series).alias("series"))
    return by_brand.agg(brands.alias("b")).select(_document(data))


def province_payload(by_province: DataFrame) -> DataFrame:
    """One map document; it lists every region, in order of name."""
    rows = F.array_sort(F.collect_list(F.struct(
        F.col("province_name").alias("name"), F.col("order_amount").alias("value"),
        F.array("order_count").alias("tooltipvalues"))))
    # Captions of the map.
    data = F.struct(F.col("m").alias("mapData"), F.lit("销售额").alias("valueName"),
                    F.array(F.lit("订单数")).alias("tooltipNames"),
                    F.array(F.lit("个")).alias("tooltipUnits"))
    return by_province.agg(rows.alias("m")).select(_document(data))
