"""The query shapes behind the dashboards, each one grouped query."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.calendar import is_weekend, weekday_no
from tillhouse.functions.money import EXACT
from tillhouse.plans import metrics

CARD_METRICS = ("revenue", "baskets", "units", "basket_size", "apsd", "units_per_basket", "customer_penetration")
STORE_METRICS = ("revenue", "baskets", "basket_size", "units", "units_per_basket", "apsd")
PRODUCT_METRICS = ("units", "revenue", "baskets", "gross_margin", "margin_pct")


def overview(mart: DataFrame, where: Mapping | None = None) -> DataFrame:
    return metrics.sales(mart, CARD_METRICS, where=where)


def by_daypart(mart: DataFrame, where: Mapping | None = None) -> DataFrame:
    """The label starts with its rank, so sorting by it is chronological."""
    return metrics.sales(mart, ("revenue", "baskets"), ["daypart"], where).orderBy("daypart")


def daily_series(mart: DataFrame, where: Mapping | None = None) -> DataFrame:
    return (metrics.sales(mart, ("revenue", "baskets", "units"), ["report_date"], where)
            .withColumn("day_type", F.when(is_weekend(F.col("report_date")), "Weekend").otherwise("Weekday"))
            .orderBy("report_date"))


def by_weekday(mart: DataFrame, where: Mapping | None = None) -> DataFrame:
    """Labels in the order of the week, which is that of their number and not of their letters."""
    numbered = mart.withColumn("weekday_no", weekday_no(F.col("report_date")))
    return metrics.sales(numbered, ("revenue", "baskets"), ["weekday_no", "day_name"], where).orderBy("weekday_no")


def chosen_weeks(mart: DataFrame, weeks: Sequence[date], where: Mapping | None = None) -> DataFrame:
    """Some weeks, each still compared with the one before it, which need not be among them: only those are read."""
    near = sorted({day - timedelta(days=n) for day in weeks for n in (0, 7)})
    return weekly(mart, {**(where or {}), "week_start": near}).where(F.col("week_start").isin(list(weeks)))


def weekly(mart: DataFrame, where: Mapping | None = None) -> DataFrame:
    """Weeks with baskets and basket size next to the week-over-week change."""
    change = metrics.week_over_week(mart, where=where)
    own = metrics.sales(mart, ("baskets", "basket_size"), ["week_start"], where)
    return change.join(own, "week_start", "left").orderBy("week_start")


def by_store(mart: DataFrame, where: Mapping | None = None) -> DataFrame:
    return (metrics.sales(mart, STORE_METRICS, ["store_id", "store_name"], where)
            .orderBy(F.desc("revenue"), "store_id"))


def by_store_channel(mart: DataFrame, where: Mapping | None = None) -> DataFrame:
    return metrics.sales(mart, ("revenue",), ["store_id", "store_name", "channel"], where)


def with_product(mart: DataFrame, products: DataFrame, *keep: str) -> DataFrame:
    """Lines folded per product and `keep`, then the star join; unknown products stay under a blank member."""
    total = lambda name: F.sum(F.col(name).cast(EXACT)).alias(name)
    folded = mart.groupBy("product_id", *keep).agg(total("revenue_net"), total("cogs"), F.sum("quantity").alias("quantity"))
    return folded.join(products.select("product_id", "product_name", "product_category", "product_group", "brand"),
                     "product_id", "left")


def by_product(mart: DataFrame, products: DataFrame, where: Mapping | None = None) -> DataFrame:
    """Fold lines per product first, then attach the few attributes."""
    folded = metrics.sales(mart, PRODUCT_METRICS, ["product_id"], where)
    return (folded.join(products.select("product_id", "product_name", "product_category", "brand"), "product_id", "left")
            .orderBy(F.desc("revenue"), "product_id"))


def top_products(mart: DataFrame, products: DataFrame, n: int = 10, where: Mapping | None = None) -> DataFrame:
    """The best sellers are chosen before names are looked up."""
    best = (metrics.sales(mart, ("revenue", "units"), ["product_id"], where)
            .orderBy(F.desc_nulls_last("revenue"), "product_id").limit(n))
    return (best.join(products.select("product_id", "product_name"), "product_id", "left")
            .orderBy(F.desc_nulls_last("revenue"), "product_id"))


def category_channel_matrix(mart: DataFrame, products: DataFrame, channels: Sequence[str],
                            where: Mapping | None = None) -> DataFrame:
    """Category rows, channel columns, revenue and units in the cells, with a total row."""
    money = F.col("revenue_net").cast(EXACT)
    cells = []
    for channel in channels:
        inside = F.col("channel") == channel
        cells.append(F.sum(F.when(inside, money)).cast("double").alias(f"{channel}_revenue"))
        cells.append(F.sum(F.when(inside, F.col("quantity"))).alias(f"{channel}_units"))
    total = [F.sum(money).cast("double").alias("total_revenue"), F.sum("quantity").alias("total_units")]
    rows = with_product(metrics.slice_rows(mart, where), products, "channel")
    return (rows.rollup("product_category").agg(*cells, *total, F.grouping("product_category").alias("is_total"))
            .withColumn("is_total", F.col("is_total").cast("int")))


def by_category(mart: DataFrame, products: DataFrame, where: Mapping | None = None) -> DataFrame:
    rows = with_product(metrics.slice_rows(mart, where), products)
    return metrics.sales(rows, ("revenue", "units", "gross_margin"), ["product_category", "product_group"])


def by_customer_group(mart: DataFrame, where: Mapping | None = None) -> DataFrame:
    return metrics.sales(mart, ("baskets", "revenue"), ["customer_gender", "customer_age_range"], where)


def rating_by_channel(mart: DataFrame, where: Mapping | None = None) -> DataFrame:
    return metrics.sales(mart, ("avg_rating",), ["channel"], where)


def identified_by_day(mart: DataFrame, where: Mapping | None = None) -> DataFrame:
    return metrics.sales(mart, ("identified_baskets", "baskets", "identified_rate"), ["report_date"], where)


def service_matrix(mart: DataFrame, where: Mapping | None = None) -> DataFrame:
    return metrics.services(mart, ("total_revenue", "transaction_count"), ["service_name", "provider_id"], where)


def service_by_store(mart: DataFrame, where: Mapping | None = None) -> DataFrame:
    return metrics.services(mart, ("total_revenue", "gross_margin", "transaction_count", "aov"),
                            ["store_id", "store_name"], where)


def live_by_store(mart: DataFrame, where: Mapping | None = None) -> DataFrame:
    return metrics.live(mart, ("revenue", "transactions", "aov"), ["store_id", "store_name"], where)


def live_by_category(mart: DataFrame, where: Mapping | None = None) -> DataFrame:
    return metrics.live(mart, ("revenue", "units", "lines"), ["product_category_name"], where)


def live_by_hour(mart: DataFrame, where: Mapping | None = None) -> DataFrame:
    hours = mart.withColumn("hour", F.date_trunc("hour", "transaction_time").cast("timestamp_ntz"))
    return metrics.live(hours, ("revenue", "transactions"), ["hour"], where)
