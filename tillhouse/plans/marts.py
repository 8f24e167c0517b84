"""Reporting tables over the facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.functions import decode
from tillhouse.functions.calendar import calendar, is_weekend, month_key, week_start
from tillhouse.functions.contracts import EXCLUDED_STORE_PREFIX, EXCLUDED_STORES
from tillhouse.functions.money import EXACT, ratio
from tillhouse.operators.scd import current_slice


def sales_mart(fact: DataFrame, excluded: Sequence[str] = EXCLUDED_STORES,
               excluded_prefix: str = EXCLUDED_STORE_PREFIX) -> DataFrame:
    """Completed sales of reported stores, one row per line, with calendar, channel and customer columns."""
    day, hour = F.col("report_date"), F.hour("transaction_time")
    scope = ((F.col("delivery_status") == "completed") & (F.col("transaction_type") == "Sale Transaction")
             & ~F.col("store_id").isin(*excluded) & ~F.col("store_id").startswith(excluded_prefix))
    return fact.where(scope).withColumn("txn_hour", hour).select(
        day, F.year(day).alias("year"), month_key(day).alias("month_key"), week_start(day).alias("week_start"),
        F.date_format(day, "EEE").alias("day_name"), is_weekend(day).cast("int").alias("is_weekend"),
        "txn_hour", decode.daypart("txn_hour").alias("daypart"),
        decode.report_channel("transaction_7now_source", "channel_name").alias("channel"),
        "store_id", "store_name", "store_type", "transaction_id", "product_id", "quantity",
        F.expr("final_amount_no_tax as revenue_net"), F.expr("final_amount as revenue_gross"), "customer_code",
        F.expr("if(customer_code <> '', 1, 0) as is_identified_customer"), "customer_id",
        *[F.expr(f"nullif({c}, '') as {c}") for c in ("customer_gender", "customer_age_range", "customer_nationality")],
        "rating", F.expr("purchase_price_without_tax * quantity as cogs"))


def sales_daily(mart: DataFrame) -> DataFrame:
    """Per day and channel. Lines fold to baskets and stores first, so the two distinct counts see little data."""
    keys = ["report_date", "year", "month_key", "week_start", "is_weekend", "channel"]
    money = lambda name: F.sum(F.col(name).cast(EXACT)).alias(name)
    baskets = mart.groupBy(*keys, "transaction_id", "store_id").agg(
        F.sum("quantity").alias("units"), money("revenue_net"), money("revenue_gross"))
    totals = baskets.groupBy(*keys).agg(
        F.count_distinct("transaction_id").alias("baskets"), F.count_distinct("store_id").alias("stores"),
        F.sum("units").alias("units"), F.sum("revenue_net").alias("net"), F.sum("revenue_gross").alias("gross"))
    whole = lambda c: F.round(c, 0).cast("double")
    return totals.select(
        *keys, "baskets", "stores", "units", whole(F.col("net")).alias("revenue_net"),
        whole(F.col("gross")).alias("revenue_gross"),
        F.round(ratio(F.col("net"), F.col("baskets")), 0).alias("basket_size"))


def product_dim_mart(dim_product: DataFrame, brands: DataFrame) -> DataFrame:
    """Current version of each product with its brand: one row per product, whatever the history holds."""
    return (current_slice(dim_product).join(brands, "product_id", "left").select(
        "product_id", "product_name", F.col("product_category_name").alias("product_category"),
        F.col("product_group_name").alias("product_group"),
        F.col("product_sub_category_name").alias("product_sub_category"), "retail_business_type",
        F.col("product_brand_name").alias("brand"), F.col("product_manufacturer_name").alias("manufacturer")))


def date_dim(mart: DataFrame) -> DataFrame:
    return calendar(mart, "report_date")
