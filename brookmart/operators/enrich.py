"""Filling in dimension columns by joins."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Columns that the enrichment takes of each dimension.
DIM_COLUMNS = {
    "user_info": ["id", "gender", "birthday"],
    "base_province": ["id", "name", "iso_3166_2", "area_code", "iso_code"],
    "sku_info": ["id", "sku_name", "price", "spu_id", "tm_id", "category3_id"],
    "spu_info": ["id", "spu_name"], "base_trademark": ["id", "tm_name"],
    "base_category3": ["id", "name"]}


@dataclass(frozen=True)
class DimSpec:
    """Take columns of `dim`, found by its text `id`, for the bigint `fact_key`."""

    dim: DataFrame
    fact_key: str
    # Output name -> source column or expression.
    columns: dict[str, Column | str] = field(default_factory=dict)


def _lookup_side(spec: DimSpec) -> DataFrame:
    chosen = [(F.col(c) if isinstance(c, str) else c).alias(out)
              for out, c in spec.columns.items()]
    return spec.dim.select(F.col("id").cast("bigint").alias("_dim_id"), *chosen)


def enrich(df: DataFrame, specs: list[DimSpec], how: str = "inner") -> DataFrame:
    """Join each dimension in turn.

    No hint is given: a dimension is broadcast when the size of its files allows, and
    sort-merge joined otherwise, with hot keys split by AQE.
    A row without its dimension row is dropped; `how='left'` keeps it.
    """
    for spec in specs:
        side = _lookup_side(spec)
        df = df.join(side, F.col(spec.fact_key) == side["_dim_id"], how).drop("_dim_id")
    return df


def lookup_dim(df: DataFrame, dim: DataFrame, fact_key: str, columns: list[str]) -> DataFrame:
    """The named columns of the dimension row of each fact row."""
    return enrich(df, [DimSpec(dim, fact_key, {c: c for c in columns})])


def unmatched(df: DataFrame, dim: DataFrame, fact_key: str) -> DataFrame:
    """Fact rows whose dimension row is missing."""
    side = dim.select(F.col("id").cast("bigint").alias("_dim_id"))
    return df.join(side, F.col(fact_key) == F.col("_dim_id"), "left_anti")


def product_lookup(dims: dict[str, DataFrame]) -> DataFrame:
    """Products with the names of their unit, brand and category.

    The chain is resolved among the dimensions first, so a fact table is shuffled for it
    once and not once per link.
    """
    sku = dims["sku_info"].select(
        "id", "sku_name", F.col("price").cast("decimal(20,2)").alias("sku_price"),
        *[F.col(c).cast("bigint").alias(c) for c in ("spu_id", "tm_id", "category3_id")])
    return enrich(sku, [
        DimSpec(dims["spu_info"], "spu_id", {"spu_name": "spu_name"}),
        DimSpec(dims["base_trademark"], "tm_id", {"tm_name": "tm_name"}),
        DimSpec(dims["base_category3"], "category3_id", {"category3_name": "name"}),
    ])


PRODUCT_COLUMNS = ("sku_name", "sku_price", "spu_id", "spu_name", "tm_id", "tm_name",
                   "category3_id", "category3_name")


def enrich_product(df: DataFrame, dims: dict[str, DataFrame], how: str = "inner") -> DataFrame:
    """Fill in the product columns from `sku_id`.

    AQE sees the size of the resolved products at run time and broadcasts them if it can.
    """
    return enrich(df, [DimSpec(product_lookup(dims), "sku_id", {c: c for c in PRODUCT_COLUMNS})],
                  how)
