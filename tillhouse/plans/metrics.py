"""Business metrics. `by` is the visual axis, `where` the slicers; every metric is computed at the asked grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.functions.money import EXACT, exact_sum, ratio

# Ratio metrics as (part, whole).
SALES_RATIOS: dict[str, tuple[str, str]] = {
    "basket_size": ("revenue", "baskets"),
    "apsd": ("revenue", "store_days"),
    "units_per_basket": ("units", "baskets"),
    "customer_penetration": ("identified_baskets", "baskets"),
    "identified_rate": ("identified_baskets", "baskets"),
    "margin_pct": ("gross_margin", "revenue"),
}
SERVICE_RATIOS = {"margin_pct": ("gross_margin", "total_revenue"), "aov": ("total_revenue", "transaction_count")}
LIVE_RATIOS = {"aov": ("revenue", "transactions")}


def _baskets(rule: Column | None = None) -> Column:
    return F.count_distinct("transaction_id" if rule is None else F.when(rule, F.col("transaction_id")))


def _sales_measures() -> dict[str, Column]:
    customer = F.col("customer_id")
    return {
        "revenue": exact_sum(F.col("revenue_net")),
        "units": F.sum("quantity"),
        "total_cogs": exact_sum(F.col("cogs")),
        "baskets": _baskets(),
        "store_days": F.count_distinct(F.struct("report_date", "store_id")),
        "identified_baskets": _baskets(F.col("is_identified_customer") == 1),
        "unique_customers": F.count_distinct(F.when(customer > 0, customer)),
        "avg_rating": F.avg("rating"),
    }


def _service_measures() -> dict[str, Column]:
    total, cost = F.col("total_amount"), F.col("purchase_price_with_tax")
    return {
        "total_revenue": F.sum(total),
        "commission_income": F.sum("total_commission"),
        "product_cost": F.sum(cost),
        "cost_service_margin": F.sum(F.when(cost > 0, total - cost)),
        "transaction_count": _baskets(),
    }


def _live_measures() -> dict[str, Column]:
    amount, source = F.col("total_amount"), F.col("source")
    return {
        "revenue": exact_sum(amount),
        "net_revenue": exact_sum(F.col("final_amount")),
        "units": F.sum("quantity"),
        "transactions": _baskets(),
        "lines": F.count("*"),
        "realtime_revenue": exact_sum(F.when(source == "rlt", amount)),
        "batch_revenue": exact_sum(F.when(source == "eod", amount)),
    }


def slice_rows(df: DataFrame, where: Mapping[str, object] | None) -> DataFrame:
    """Slicers: a pair (lo, hi) is a between, a list is an IN, anything else an equality."""
    for name, value in (where or {}).items():
        if isinstance(value, tuple):
            df = df.where(F.col(name).between(*value))
        elif isinstance(value, (list, set)):
            df = df.where(F.col(name).isin(*value))
        else:
            df = df.where(F.col(name) == value)
    return df


def _measure(df, by, names, basics, ratios, sums, where):
    """One aggregate over the basic measures the asked ones rest on, then arithmetic on its few rows.

    `ratios` and `sums` name measures made of others: (part, whole) and (column, inputs).
    """
    needed: list[str] = []

    def require(name: str) -> None:
        for part in ratios.get(name) or (sums[name][1] if name in sums else ()):
            require(part)
        if name in basics and name not in needed:
            needed.append(name)

    for name in names:
        require(name)
    out = slice_rows(df, where).groupBy(*by).agg(*[basics[n].alias(n) for n in needed])
    out = out.withColumns({name: column for name, (column, inputs) in sums.items() if set(inputs) <= set(needed)})
    out = out.withColumns({name: ratio(F.col(ratios[name][0]), F.col(ratios[name][1]))
                           for name in names if name in ratios})
    return out.select(*by, *names)


def _add(a: str, b: str, sign: int = 1) -> Column:
    """Blank plus a number is the number."""
    both = F.coalesce(F.col(a), F.lit(0)) + sign * F.coalesce(F.col(b), F.lit(0))
    return F.when(F.col(a).isNotNull() | F.col(b).isNotNull(), both)


# What each distinct count of the sales measures counts.
COUNTED = {"baskets": ("transaction_id",), "identified_baskets": ("transaction_id",),
           "store_days": ("report_date", "store_id"), "unique_customers": ("customer_id",)}


def _folded(rows: DataFrame, by: Sequence[str], counted: set[str]) -> DataFrame:
    """Lines to one row per combination of what is counted; sums stay sums and flags stay flags.

    Several distinct counts copy their input once each; after this they copy baskets, not lines.
    """
    keys = list(dict.fromkeys([*by, *[k for name in COUNTED if name in counted for k in COUNTED[name]]]))
    exact = {"revenue_net": EXACT, "cogs": EXACT, "quantity": None}
    out = [F.sum(F.col(name).cast(kind) if kind else F.col(name)).alias(name)
           for name, kind in exact.items() if name in rows.columns and name not in keys]
    if "is_identified_customer" in rows.columns and "is_identified_customer" not in keys:
        out.append(F.max("is_identified_customer").alias("is_identified_customer"))
    if "rating" in rows.columns and "rating" not in keys:
        out += [F.sum("rating").alias("rating_sum"), F.count("rating").alias("rating_n")]
    return rows.groupBy(*keys).agg(*out)


def sales(mart: DataFrame, names: Sequence[str], by: Sequence[str] = (), where: Mapping | None = None) -> DataFrame:
    sums = {"gross_margin": (_add("revenue", "total_cogs", -1), ("revenue", "total_cogs"))}
    measures = _sales_measures()
    parts = {p for name in names for p in (name, *SALES_RATIOS.get(name, ()))}
    counted = parts & set(COUNTED)
    if len(counted) > 1:
        mart, where = _folded(slice_rows(mart, where), by, counted), None
        measures["avg_rating"] = F.try_divide(F.sum("rating_sum").cast("double"), F.sum("rating_n"))
    return _measure(mart, by, names, measures, SALES_RATIOS, sums, where)


def services(mart: DataFrame, names: Sequence[str], by: Sequence[str] = (), where: Mapping | None = None) -> DataFrame:
    sums = {"gross_margin": (_add("commission_income", "cost_service_margin"),
                             ("commission_income", "cost_service_margin"))}
    return _measure(mart, by, names, _service_measures(), SERVICE_RATIOS, sums, where)


def live(mart: DataFrame, names: Sequence[str], by: Sequence[str] = (), where: Mapping | None = None) -> DataFrame:
    return _measure(mart, by, names, _live_measures(), LIVE_RATIOS, {}, where)


def repeat_customers(mart: DataFrame, by: Sequence[str] = (), where: Mapping | None = None) -> DataFrame:
    """Known customers, those with two or more baskets, and their share."""
    per_customer = (slice_rows(mart, where).where("customer_id > 0").groupBy(*by, "customer_id")
                    .agg(F.count_distinct("transaction_id").alias("baskets")))
    out = per_customer.groupBy(*by).agg(F.count("*").alias("unique_customers"),
                                        F.count_if(F.col("baskets") >= 2).alias("repeat_customers"))
    return out.withColumn("repeat_rate", ratio(F.col("repeat_customers"), F.col("unique_customers")))


def channel_share(mart: DataFrame, by: Sequence[str] = (), where: Mapping | None = None,
                  dim: str = "channel") -> DataFrame:
    """Revenue and its share of the revenue over all values of one dimension."""
    out = sales(mart, ["revenue"], [*by, dim], where)
    whole = Window.partitionBy(*by)
    return out.withColumn("share", ratio(F.col("revenue"), exact_sum_over(F.col("revenue"), whole)))


def exact_sum_over(amount: Column, window) -> Column:
    return F.sum(amount.cast("decimal(28,6)")).over(window).cast("double")


# ---- time intelligence ----------------------------------------------------------------------------
# Each day's revenue is also booked on the day it is compared with, then both are grouped by the axis. The
# calendar is contiguous, so "exists in the calendar" means "not after the last day".

def daily_revenue(mart: DataFrame, by: Sequence[str] = (), where: Mapping | None = None) -> DataFrame:
    return sales(mart, ["revenue"], [*by, "report_date"], where)


def last_day(mart: DataFrame) -> Column:
    """End of the calendar, as a scalar subquery over one column."""
    return mart.agg(F.max("report_date")).scalar()


def compared(daily: DataFrame, shifted: Column, end: Column, axis: Column, axis_name: str,
             by: Sequence[str], base: str, change: str) -> DataFrame:
    """Revenue per axis value next to the revenue of the shifted period, and the relative change."""
    booked = F.array(
        F.struct(F.col("report_date").alias("on"), F.col("revenue").alias("now"), F.lit(None).cast("double").alias("then")),
        F.struct(shifted.alias("on"), F.lit(None).cast("double").alias("now"), F.col("revenue").alias("then")))
    rows = daily.select(*by, F.explode(booked).alias("b")).select(*by, "b.*").where(F.col("on") <= end)
    out = rows.groupBy(*by, axis.alias(axis_name)).agg(
        exact_total(F.col("now")).alias("revenue"), exact_total(F.col("then")).alias(base))
    return out.withColumn(change, ratio(_add("revenue", base, -1), F.col(base)))


def exact_total(amount: Column) -> Column:
    return F.sum(amount.cast("decimal(28,6)")).cast("double")


def week_over_week(mart: DataFrame, by: Sequence[str] = (), where: Mapping | None = None) -> DataFrame:
    """Per week: revenue, the revenue of the same days a week earlier, and the change."""
    return compared(daily_revenue(mart, by, where), F.date_add("report_date", 7), last_day(mart),
                    F.trunc("on", "week"), "week_start", by, "revenue_lw", "wow_pct")


def month_over_month(mart: DataFrame, by: Sequence[str] = (), where: Mapping | None = None) -> DataFrame:
    """Per month: revenue, the revenue of the month before, and the change."""
    return compared(daily_revenue(mart, by, where), F.add_months("report_date", 1), last_day(mart),
                    F.date_format("on", "yyyy-MM"), "month_key", by, "revenue_pm", "mom_pct")


def trailing_average(mart: DataFrame, days: int = 7, by: Sequence[str] = (), where: Mapping | None = None) -> DataFrame:
    """Per calendar day: revenue of the last `days` days divided by `days`, also while the window is still filling."""
    daily = daily_revenue(mart, by, where)
    reach = F.sequence(F.col("report_date"), F.date_add("report_date", days - 1))
    return (daily.select(*by, F.explode(reach).alias("date"), "revenue").where(F.col("date") <= last_day(mart))
            .groupBy(*by, "date")
            .agg((exact_total(F.col("revenue")) / F.lit(float(days))).alias("revenue_avg_day")))
