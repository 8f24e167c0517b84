"""Every registered query: name -> (spark, folder) -> DataFrame. All run over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.functions import calendar as cal
from tillhouse.functions import decode
from tillhouse.functions.contracts import BASELINE_TOLERANCE, LIVE_FACT, PRODUCT_FACT, SALE_ITEMS, SERVICE_FACT, STATUS_TIMES
from tillhouse.functions.money import exact_sum
from tillhouse.functions.nested import read_nested, store_as_text
from tillhouse.functions.types import conform, split_codes, void_to_string
from tillhouse.operators import quality
from tillhouse.operators.dedup import distinct_rows, one_per_key
from tillhouse.operators.joins import as_of_join, range_join_effective
from tillhouse.operators.pivot import status_times
from tillhouse.operators.scd import current_slice, scd2_apply, scd2_initial
from tillhouse.plans import dashboards, identity, lines, marts, metrics, runs, services
from tillhouse.plans.dims import dimension, price_timeline
from tillhouse.plans.lakehouse import Lakehouse
from tillhouse.plans.refresh import refresh_mart
from tillhouse.session import scratch_path, tune
from tillhouse.sources import landing as fixture
from tillhouse.sources import tables
from tillhouse.sources.sinks import append, read_slices, write_slices
from tillhouse.streaming import eventtime, live

AS_OF = datetime.fromisoformat(fixture.AS_OF)
SCAN_WINDOW = cal.RunWindow.for_days("1996-03-01", 31)
RUN_LOG_AS_OF = datetime(1998, 3, 15)

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[Lakehouse], DataFrame], name: str | None = None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return flat(build(Lakehouse(tune(spark), sf_dir)))
    _queries[name or build.__name__] = run
    return build


def named(name: str):
    return lambda build: query(build, name)


def flat(df: DataFrame) -> DataFrame:
    """Code lists as sorted text, so results compare as plain rows."""
    lists = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    return df.withColumns({c: F.array_join(F.sort_array(c), "|") for c in lists}) if lists else df


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_queries)


# ---- types and scalar functions -------------------------------------------------------------------
@query
def schema_conform(lake):
    return conform(lake.landing.raw("customer"), {
        "c_custkey": "str", "c_acctbal": "int", "c_mktsegment": "int", "c_nationkey": "bool",
        "c_name": "list_from_str", "missing_amount": "float", "missing_list": "list", "missing_text": "anything"})


BILL_DOCUMENT = "_id string, documentDate string, paymentMethod bigint, storeCode string, cash double, saleNormalItems " + SALE_ITEMS


@query
def landed_documents(lake):
    """Bills and returns as files of JSON texts, some broken; a third collection never came. Broken texts are kept aside."""
    root = scratch_path(lake.spark, "landed")
    for name, docs in (("sale_bill", lake.landing.sale_bill()), ("sale_return_bill", lake.landing.sale_return_bill())):
        text = F.when(F.substring("_id", -1, 1) == "7", F.concat(F.lit('{"_id": "'), "_id")).otherwise(
            F.to_json(F.struct("_id", F.col("documentDate").cast("string").alias("documentDate"), "paymentMethod", "storeCode",
                               "cash", "saleNormalItems")))
        docs.select(text.alias("value")).write.text(f"{root}/{name}", compression="gzip")
    read = lambda name: lambda: tables.parsed_documents(lake.spark, f"{root}/{name}", BILL_DOCUMENT)
    parsed = tables.union_present({n: read(n) for n in ("sale_bill", "sale_return_bill", "transfer_bill")}, "bills")
    append(tables.quarantined(parsed), f"{root}/quarantine")
    kept = lake.spark.read.parquet(f"{root}/quarantine")
    good = tables.good_documents(parsed).select(
        F.col("_id").alias("transaction_id"), F.to_date("documentDate").alias("document_day"), F.col("storeCode").alias("store_id"),
        F.coalesce(F.size("saleNormalItems"), F.lit(0)).alias("items"), "cash", F.lit(None).cast("string").alias("broken"))
    bad = kept.select(F.lit(None).cast("string").alias("transaction_id"), F.lit(None).cast("date").alias("document_day"),
                      F.lit(None).cast("string").alias("store_id"), F.lit(None).cast("int").alias("items"),
                      F.lit(None).cast("double").alias("cash"), F.col("text").alias("broken"))
    return good.unionByName(bad)


@query
def void_cast(lake):
    return void_to_string(lake.landing.raw("customer").select("c_custkey", F.lit(None).alias("note")))


@query
def json_roundtrip(lake):
    """Bills stored as a copy job lands them, nested columns as text, and read back."""
    landed = store_as_text(lake.landing.sale_bill())
    items = landed.select("_id", F.explode_outer(read_nested(landed, "saleNormalItems", SALE_ITEMS)).alias("i"))
    return items.select(F.col("_id").alias("transaction_id"), F.col("i.productCode").alias("product_id"),
                        F.col("i.quantity").alias("quantity"), F.col("i.totalAmount").alias("total_amount"),
                        F.col("i.totalAmountByPromotion").alias("promotion_amount"),
                        F.col("i.winPromotion").alias("win"), F.col("i.productGroupId").alias("product_group_id"))


@query
def explode_outer(lake):
    docs = lake.landing.sale_bill()
    return (docs.select("_id", F.explode_outer("saleNormalItems").alias("i"))
            .groupBy(F.col("_id").alias("transaction_id"))
            .agg(F.count("*").alias("line_rows"), F.count("i.productCode").alias("items")))


@query
def business_day(lake):
    moment = cal.local_time(F.col("ts"))
    day = F.to_date(moment)
    return lake.landing.raw("events").select(
        "event_id", moment.alias("local_ts"), day.alias("report_date"), cal.month_key(day).alias("month_key"),
        cal.week_start(day).alias("week_start"), F.date_format(day, "EEE").alias("day_name"),
        cal.weekday_no(day).alias("weekday_no"), cal.is_weekend(day).alias("is_weekend"))


@query
def daypart(lake):
    local = lake.landing.raw("events").select("event_id", F.hour(cal.local_time(F.col("ts"))).alias("hour"))
    return local.withColumn("daypart", decode.daypart("hour"))


@query
def channel_decode(lake):
    rows = lake.landing.orders().selectExpr(
        "o_orderkey", "delivery_no", "case o_orderkey % 11 when 0 then 'app' when 1 then '' end as source_7now",
        """case o_orderkey % 5 when 0 then 'Savyu Web' when 1 then 'via 7now' when 2 then 'GrabFood' when 3 then '' end
           as channel_name""",
        "case o_orderkey % 3 when 0 then 'GrabFood' when 1 then '' end as external_source",
        "if(o_orderkey % 7 <> 0, o_orderkey, null) as order_id")
    return rows.select("o_orderkey", decode.bill_channel("delivery_no").alias("bill_channel"),
                       decode.delivery_channel("external_source", "order_id").alias("delivery_channel"),
                       decode.report_channel("source_7now", "channel_name").alias("report_channel"))


@query
def payment_decode(lake):
    return lake.landing.orders().select("o_orderkey", "pay_code",
                                        decode.payment_method("pay_code").alias("payment_method_name"))


@query
def demographics(lake):
    """The same codes as numbers and as text; unknown ages blank or passed through."""
    blank = decode.demographics("c_custkey % 3", "cast(c_custkey % 6 as string)", "c_nationkey % 5")
    kept = decode.demographics("cast(c_custkey % 3 as string)", "c_custkey % 6", "cast(c_nationkey % 5 as string)", True)
    return lake.landing.raw("customer").select(
        "c_custkey", *[col.alias(name) for name, col in blank.items()],
        *[col.alias(f"{name}_kept") for name, col in kept.items()])


@query
def voucher_split(lake):
    codes = split_codes(F.col("originalVoucherCode"))
    return lake.landing.bill_heads().select(F.col("_id").alias("transaction_id"), F.size(codes).alias("codes"),
                                            F.element_at(codes, 1).alias("first_code"), codes.alias("code_list"))


# ---- scans ----------------------------------------------------------------------------------------
@query
def windowed_scan(lake):
    orders = lake.landing.raw("orders")
    business = tables.in_business_window(orders, "o_orderdate", SCAN_WINDOW).select(
        "o_orderkey", "o_orderdate", F.lit("business").alias("scan"))
    cover = tables.windowed(orders, "o_orderdate", SCAN_WINDOW).select(
        "o_orderkey", "o_orderdate", F.lit("cover").alias("scan"))
    return business.unionByName(cover)


@query
def parent_windowed_scan(lake):
    kids = lake.landing.raw("lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    found = tables.parent_windowed(kids, lake.landing.raw("orders"), "o_orderkey", "o_orderdate", SCAN_WINDOW)
    return found.select("o_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice")


# ---- typed tables ---------------------------------------------------------------------------------
@query
def sale_line(lake):
    return lake.sale_lines()


@query
def promotion_agg(lake):
    return lake.promotions()


@query
def pivot_status_times(lake):
    return status_times(lake.landing.delivery_order_audits(), "order_id", "status", "created_at", STATUS_TIMES)


@query
def delivery(lake):
    return lake.deliveries()


@query
def transaction_enrich(lake):
    return lake.transactions()


@query
def point_history(lake):
    return lake.points()


@query
def dedup_latest(lake):
    """Last event per user and type, and the whole-row distinct count beside it."""
    events = lake.landing.raw("events").select("user_id", "event_type", "ts", "event_id", "value")
    last = one_per_key(events, ["user_id", "event_type"], [F.col("ts").desc(), F.col("event_id").desc()])
    kinds = distinct_rows(events.select("user_id", "event_type")).groupBy("user_id").agg(F.count("*").alias("kinds"))
    return last.join(kinds, "user_id")


@query
def dim_product(lake):
    return dimension("dim_product", lake.landing)


@query
def dim_store(lake):
    return dimension("dim_store", lake.landing)


@query
def dim_brand(lake):
    return dimension("dim_brand", lake.landing)


@query
def dim_payment(lake):
    return dimension("dim_payment", lake.landing)


@query
def dim_customer(lake):
    return dimension("dim_customer", lake.landing)


@query
def dim_partner_store(lake):
    return dimension("dim_partner_store", lake.landing)


@query
def dim_purchase_price(lake):
    return lake.prices()


@query
def dim_date(lake):
    return cal.calendar(lake.landing.raw("orders").select(F.to_date("o_orderdate").alias("day")), "day")


# ---- joins ----------------------------------------------------------------------------------------
def _priced_lines(lake):
    land = lake.landing
    stores = land.raw("customer").join(land.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    orders = (land.raw("orders").join(stores, F.col("o_custkey") == F.col("c_custkey"))
              .select("o_orderkey", cal.local_time(F.col("o_orderdate")).alias("sold_at"),
                      F.col("n_regionkey").cast("int").alias("sale_area_id")))
    return (land.raw("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("product_id"),
                    "sale_area_id", "sold_at", "l_quantity"))


@named("range_join_effective")
def priced_lines(lake):
    return range_join_effective(_priced_lines(lake), lake.landing.purchase_price_timeline(),
                                ["product_id", "sale_area_id"], "sold_at", "purchase_price_effective_date",
                                "next_purchase_price_effective_date", span=lake.span, bucket_days=365)


def _half_span(lake):
    """Half the time the data covers: what lies outside must be joined all the same."""
    lo, hi = lake.span
    return lo, lo + (hi - lo) / 2


@query
def range_join_outside_span(lake):
    """The same join told that the lines end half-way."""
    return range_join_effective(_priced_lines(lake), lake.landing.purchase_price_timeline(),
                                ["product_id", "sale_area_id"], "sold_at", "purchase_price_effective_date",
                                "next_purchase_price_effective_date", span=_half_span(lake), bucket_days=365)


def _stored_orders(lake):
    land = lake.landing
    orders = (land.raw("orders").join(land.raw("customer"), F.col("o_custkey") == F.col("c_custkey"))
              .select("o_orderkey", F.col("c_nationkey").cast("string").alias("store_id"),
                      cal.local_time(F.col("o_orderdate")).alias("sold_at")))
    return orders


@named("as_of_join")
def stored_orders(lake):
    """Every order with its store's attributes of that day."""
    return as_of_join(_stored_orders(lake), lake.stores(), ["store_id"], "sold_at", span=lake.span)


@query
def as_of_outside_span(lake):
    return as_of_join(_stored_orders(lake), lake.stores(), ["store_id"], "sold_at", span=_half_span(lake))


@query
def identity_coalesce(lake):
    found = identity.resolved(lake.gathered(lake.bill_heads()), fixture.FLIP_DATE)
    return found.select("transaction_id", "report_date", *identity.choices(fixture.FLIP_DATE))


# ---- versioned dimensions -------------------------------------------------------------------------
@named("scd2_initial")
def first_load(lake):
    return scd2_initial(lake.landing.oms_store())


@named("scd2_apply")
def daily_applies(lake):
    """Four daily snapshots applied one after the other."""
    snaps = lake.landing.store_snapshots()
    of_day = lambda d: snaps.where(F.col("snapshot_day") == F.lit(d).cast("date")).drop("snapshot_day")
    first, *rest = fixture.SNAPSHOT_DAYS
    state = scd2_initial(of_day(first))
    for day in rest:
        state = scd2_apply(state, of_day(day), ["store_id"], day)
    return state


@query
def scd2_from_snapshots(lake):
    return lake.stores()


@query
def scd2_current(lake):
    return current_slice(lake.stores())


@query
def product_history(lake):
    """Three masters of all products, the second with a column more, as one versioned dimension."""
    return lake.product_history().select("product_id", "product_name", "product_group_name", "product_category_name", "shelf",
                                         "valid_from", "valid_to", "is_current")


@query
def canceled_history(lake):
    """Canceled orders with the product as it was when they were placed."""
    return lake.canceled(lake.product_history()).select(
        "order_id", "transaction_id", "product_id", "product_name", "product_group_name", "report_date", "final_amount",
        "row_num_transaction_id", "number_of_line_item")


# ---- facts ----------------------------------------------------------------------------------------
@query
def fact_merge(lake):
    return lake.shaped("fact_merge", lambda rows: rows.select(
        "transaction_id", "row_num_transaction_id", "product_id", "order_no", "store_id", "sale_area_id", "customer_id",
        "channel_name", "rating", "capture_method", "is_passive_capture", "final_amount",
        "purchase_price_without_tax", "promotion_id_arr", "voucher_name_arr", "total_voucher_amount", "put_in_cart_order"))


@query
def put_in_cart(lake):
    return lake.cart_positions()


@query
def canceled_orders(lake):
    return lake.canceled().select(
        "order_id", "transaction_id", "order_no", "product_id", "product_name", "product_group_name", "report_date",
        "transaction_time", "final_amount", "bill_amount", "payment_method_name", "order_cancel_reason", "channel_name",
        "row_num_transaction_id", "number_of_line_item", "customer_id")


@query
def fact_product(lake):
    return lake.whole_fact().select(*PRODUCT_FACT)


@query
def service_line(lake):
    return lake.service_lines()


@query
def fact_service(lake):
    return lake.service_fact().select(*SERVICE_FACT)


# ---- sinks and runs -------------------------------------------------------------------------------
def _daily_orders(lake):
    day = F.to_date("o_orderdate")
    return lake.landing.raw("orders").groupBy(day.alias("report_date")).agg(
        F.count("*").alias("orders"), exact_sum(F.col("o_totalprice")).alias("amount"))


@query
def idempotent_rerun(lake):
    """The same slices written twice; the table is what one write leaves."""
    daily = _daily_orders(lake).withColumn("month_key", cal.month_key(F.col("report_date")))
    path = scratch_path(lake.spark, "rerun")
    for _ in range(2):
        write_slices(daily, path, "month_key", lake.months())
    return read_slices(lake.spark, path, daily.schema).select("report_date", "month_key", "orders", "amount")


@query
def backfill_equals_daily(lake):
    """Customers and sales per day for the whole range in one job, on both sides of the identity flip."""
    bills = identity.resolved(lake.gathered(lake.bill_heads()), fixture.FLIP_DATE)
    daily = bills.groupBy("report_date").agg(
        F.count_distinct("transaction_id").alias("bills"), F.count_distinct("customer_id").alias("customers"),
        exact_sum(F.col("bill_amount")).alias("amount")).withColumn("month_key", cal.month_key(F.col("report_date")))
    path = scratch_path(lake.spark, "backfill")
    runs.backfill(lambda: daily, path, "month_key", lake.months())
    return read_slices(lake.spark, path, daily.schema).select("report_date", "bills", "customers", "amount")


def _halves(lake) -> tuple[list[date], list[date]]:
    """First days of the months in the data, cut in two; the second half begins with the last month of the first."""
    days = [date.fromisoformat(f"{month}-01") for month in lake.months()]
    middle = len(days) // 2
    return days[:middle + 1], days[middle:]


@query
def daily_run_fact(lake):
    """The product run over all days of the data in two ranges, which share a month, each reading its own window."""
    run = runs.ProductRun(lake.for_many_runs(), scratch_path(lake.spark, "product-run"), runs.BLOCKING_CHECKS[:3], unit=runs.MONTHS)
    for days in _halves(lake):
        run.run(days)
    return run.fact().select(*PRODUCT_FACT, "created_by")


BAD_MONTH = "1997-05"
_service_runs: dict[tuple[str, str], runs.ServiceRun] = {}


class FaultyServiceRun(runs.ServiceRun):
    """The service run over a month that came with service names nobody knows."""

    def build(self, lake):
        unknown = F.when(cal.month_key(F.col("report_date")) == BAD_MONTH, F.lit("?")).otherwise(F.col("service_name"))
        return super().build(lake).withColumn("service_name", unknown)


def _years_of_services(lake) -> runs.ServiceRun:
    """The service run year by year, after the bad month was run while it was still good; once per application."""
    key = (lake.spark.sparkContext.applicationId, lake.sf_dir)
    if key not in _service_runs:
        path, lake = scratch_path(lake.spark, "service-run"), lake.for_many_runs()
        good = runs.ServiceRun(lake, path, runs.SERVICE_CHECKS, unit=runs.MONTHS)
        good.run([date.fromisoformat(f"{BAD_MONTH}-01")])
        faulty = FaultyServiceRun(lake, path, runs.SERVICE_CHECKS, unit=runs.MONTHS)
        days = [date.fromisoformat(f"{month}-01") for month in lake.months()]
        for year in sorted({d.year for d in days}):
            try:
                faulty.run([d for d in days if d.year == year])
            except runs.SlicesHeld:
                pass
        _service_runs[key] = good
    return _service_runs[key]


@query
def gated_publish(lake):
    """All years published but for the slice that failed its checks, which keeps what it had."""
    return _years_of_services(lake).fact().select(*SERVICE_FACT, "created_by")


@query
def gated_publish_mart(lake):
    return services.service_mart(_years_of_services(lake).mart_table()).groupBy("report_date", "service_name").agg(
        F.count(F.lit(1)).alias("lines"), exact_sum(F.col("total_amount")).alias("revenue"))


@query
def published_runs(lake):
    """What those runs logged, by step and status."""
    return runs.run_summary(_years_of_services(lake).log()).select("pipeline", "step", "status", "runs")


@query
def published_failures(lake):
    log = _years_of_services(lake).log()
    return runs.failed_runs(log, datetime.now(timezone.utc).replace(tzinfo=None)).select("pipeline", "run_date", "step", "status", "error")


@query
def bad_documents(lake):
    """Bills with a cash amount that is no number, from a collection without one of the tenders."""
    docs = lake.landing.bill_heads().drop("cashAtBank").withColumn(
        "cash", F.when(F.col("customerGender") == 1, "n/a").otherwise(F.col("cash").cast("string")))
    return lines.bill_header(docs, is_return=False).select("transaction_id", "cash", "voucher", "receivable_amount",
                                                           "cash_at_bank", "bill_amount")


def _run_log(lake):
    """A run log in the shape runs write it: one step per order, failed where the order is pending."""
    k = F.col("o_orderkey")
    started = F.timestamp_add("HOUR", (k % 24).cast("int"), F.col("o_orderdate"))
    seconds = (k % 600).cast("double")
    return lake.landing.raw("orders").select(
        F.concat(F.lit("eod_"), k % 3).alias("pipeline"), F.to_date("o_orderdate").cast("string").alias("run_date"),
        F.when(k % 9 < 3, "ingest").when(k % 9 < 6, "silver").otherwise("gold").alias("step"),
        F.when(F.col("o_orderstatus") == "P", "Failed").when((k % 50 == 0), "Cancelled").otherwise("Succeeded")
         .alias("status"),
        started.alias("started_at"), F.timestamp_add("SECOND", (k % 600).cast("int"), started).alias("ended_at"),
        seconds.alias("duration_s"), F.lit(None).cast("string").alias("error"))


@query
def run_log_summary(lake):
    return runs.run_summary(_run_log(lake))


@query
def failed_runs(lake):
    return runs.failed_runs(_run_log(lake), RUN_LOG_AS_OF).select("pipeline", "run_date", "step", "status", "started_at")


@query
def baseline_diff(lake):
    """Daily numbers against a stored baseline that misses days and drifts on others."""
    daily = _daily_orders(lake)
    dom = F.dayofmonth("report_date")
    moved = F.when(dom == 15, 25.0).when(dom == 10, 5.0).otherwise(0.0)
    baseline = (daily.where(dom != 20)
                .withColumns({"amount": F.col("amount") + moved, "orders": F.col("orders") + F.when(dom == 7, 11).otherwise(0)}))
    actual = daily.where(dom != 28)
    return quality.baseline_diff(actual, baseline, "report_date", ["amount", "orders"], BASELINE_TOLERANCE)


@query
def dq_product(lake):
    return quality.product_checks(lake.stored_fact(), by=["report_date"])


@query
def dq_service(lake):
    return quality.service_checks(lake.service_fact(), by=["report_date"])


# ---- marts ----------------------------------------------------------------------------------------
@query
def mart_sales(lake):
    return lake.sales_mart()


@query
def mart_sales_daily(lake):
    return marts.sales_daily(lake.sales_mart())


CHANGED_DAYS = ("1996-03-01", "1998-07-04")


@query
def mart_refresh(lake):
    """The daily mart built from the whole fact, then refreshed after two days of the fact have changed."""
    fact, mart = scratch_path(lake.spark, "refresh-fact"), scratch_path(lake.spark, "refresh-mart")
    first = lake.sales_mart()
    write_slices(first, fact, "month_key", lake.months())
    read = lambda: read_slices(lake.spark, fact, first.schema)
    refresh_mart(read(), mart, "month_key", marts.sales_daily)
    months = sorted({day[:7] for day in CHANGED_DAYS})
    doubled = F.when(F.col("report_date").isin([date.fromisoformat(d) for d in CHANGED_DAYS]), 2.0).otherwise(1.0)
    write_slices(read().where(F.col("month_key").isin(months)).withColumn("revenue_net", F.col("revenue_net") * doubled),
                 fact, "month_key", months)
    refresh_mart(read(), mart, "month_key", marts.sales_daily)
    return read_slices(lake.spark, mart, marts.sales_daily(first).schema)


@query
def mart_dim_product(lake):
    return lake.product_dim_mart()


@query
def mart_dim_date(lake):
    return marts.date_dim(lake.sales_mart())


@query
def service_mart(lake):
    return lake.service_mart().drop("month_key")


# ---- metrics --------------------------------------------------------------------------------------
@query
def metric_base(lake):
    return metrics.sales(lake.sales_mart(), ["revenue", "units", "total_cogs", "baskets"], ["month_key", "channel"])


@query
def metric_ratios(lake):
    return metrics.sales(lake.sales_mart(), ["basket_size", "apsd", "units_per_basket"], ["month_key"])


@query
def metric_store_days(lake):
    return metrics.sales(lake.sales_mart(), ["store_days"], ["channel"])


@query
def metric_identified(lake):
    return metrics.sales(lake.sales_mart(), ["customer_penetration", "identified_baskets", "identified_rate"], ["month_key"])


@query
def metric_margin(lake):
    return metrics.sales(lake.sales_mart(), ["gross_margin", "margin_pct"], ["store_id"])


@query
def metric_customers(lake):
    return metrics.repeat_customers(lake.sales_mart(), ["channel"])


@query
def metric_rating(lake):
    return metrics.sales(lake.sales_mart(), ["avg_rating"], ["channel"])


@query
def metric_channel_share(lake):
    return metrics.channel_share(lake.sales_mart(), ["month_key"])


@query
def metric_wow(lake):
    return dashboards.weekly(lake.sales_mart())


@query
def metric_mom(lake):
    return metrics.month_over_month(lake.sales_mart(), ["channel"])


@query
def metric_7d_avg(lake):
    return metrics.trailing_average(lake.sales_mart())


@query
def metric_service(lake):
    return metrics.services(lake.service_mart(), [
        "total_revenue", "commission_income", "product_cost", "cost_service_margin", "gross_margin", "margin_pct",
        "transaction_count", "aov"], ["service_name"])


@query
def metric_realtime(lake):
    return metrics.live(live.live_mart(lake.serving(), datetime(2024, 1, 24)), [
        "revenue", "net_revenue", "units", "transactions", "lines", "aov", "realtime_revenue", "batch_revenue"],
        ["report_date"])


# ---- dashboards -----------------------------------------------------------------------------------
@query
def daily_series(lake):
    return dashboards.daily_series(lake.sales_mart())


@query
def top_products(lake):
    return dashboards.top_products(lake.sales_mart(), lake.product_dim_mart())


@query
def dash_overview(lake):
    return dashboards.overview(lake.sales_mart())


@query
def dash_daypart(lake):
    return dashboards.by_daypart(lake.sales_mart())


@query
def dash_weekday(lake):
    return dashboards.by_weekday(lake.sales_mart())


@query
def dash_weeks(lake):
    return dashboards.chosen_weeks(lake.sales_mart(), [date(1996, 3, 4), date(1997, 12, 29), date(1998, 7, 6)])


@query
def dash_store(lake):
    """With slicers: a date range and a channel list."""
    between = (datetime(1996, 1, 1).date(), datetime(1999, 12, 31).date())
    return dashboards.by_store(lake.sales_mart(), {"report_date": between, "channel": ["Store", "7NOW"]})


@query
def dash_store_channel(lake):
    return dashboards.by_store_channel(lake.sales_mart())


@query
def dash_product(lake):
    return dashboards.by_product(lake.sales_mart(), lake.product_dim_mart())


@query
def dash_matrix(lake):
    return dashboards.category_channel_matrix(lake.sales_mart(), lake.product_dim_mart(),
                                              ["Store", "7NOW", "Savyu", "GrabFood"])


@query
def dash_category(lake):
    return dashboards.by_category(lake.sales_mart(), lake.product_dim_mart())


@query
def dash_customer(lake):
    return dashboards.by_customer_group(lake.sales_mart())


@query
def dash_identified(lake):
    return dashboards.identified_by_day(lake.sales_mart())


@query
def dash_service(lake):
    return dashboards.service_matrix(lake.service_mart())


@query
def dash_service_store(lake):
    return dashboards.service_by_store(lake.service_mart())


@query
def dash_realtime(lake):
    return dashboards.live_by_store(live.live_mart(lake.serving(), datetime(2024, 1, 24)))


@query
def dash_realtime_category(lake):
    return dashboards.live_by_category(live.live_mart(lake.serving(), datetime(2024, 1, 24)))


@query
def dash_realtime_hour(lake):
    return dashboards.live_by_hour(live.live_mart(lake.serving(), datetime(2024, 1, 24)))


# ---- speed layer ----------------------------------------------------------------------------------
@query
def stream_conform(lake):
    return live.sale_messages(fixture.stream_values(lake.landing.raw("events")))


@query
def stream_upsert(lake):
    """The events as a stream, upserted in micro-batches until the source is empty."""
    table = live.LiveTable(lake.spark, scratch_path(lake.spark, "live"), newest=live.EVENT_TIME)
    run = live.run_upserts(fixture.stream_values(lake.landing.event_stream()), table,
                           scratch_path(lake.spark, "live-checkpoint"))
    run.awaitTermination()
    return table.read()


@query
def stream_restart(lake):
    """Two halves of the events, each under a checkpoint of its own; the second replaces nothing of the first."""
    table = live.LiveTable(lake.spark, scratch_path(lake.spark, "live"), newest=live.EVENT_TIME)
    for half in (0, 1):
        events = lake.landing.event_stream().where(F.col("event_id") % 2 == half)
        live.run_upserts(fixture.stream_values(events), table, scratch_path(lake.spark, "live-checkpoint")).awaitTermination()
    return table.read()


@query
def stream_correction(lake):
    """All events, then a third of them again, dated a day earlier and ten dearer: what arrives later holds."""
    table = live.LiveTable(lake.spark, scratch_path(lake.spark, "live"))
    events = lake.landing.event_stream()
    again = events.where("event_id % 3 = 0").withColumns({"ts": F.expr("ts - interval 1 day"), "value": F.expr("value + 10")})
    for part in (events, again):
        live.run_upserts(fixture.stream_values(part), table, scratch_path(lake.spark, "live-checkpoint")).awaitTermination()
    return table.read()


def _to_folder(lake, stream, name):
    """What a run of a stream, to the end of its source, has written."""
    path = scratch_path(lake.spark, name)
    eventtime.run_to_folder(stream, path, scratch_path(lake.spark, f"{name}-checkpoint")).awaitTermination()
    return lake.spark.read.schema(stream.schema).parquet(path)


@query
def stream_retention(lake):
    """Two halves of the events, with retention after each batch: a generation holds no day that has left it."""
    table = live.LiveTable(lake.spark, scratch_path(lake.spark, "live-retained"))
    for half in (0, 1):
        events = lake.landing.event_stream().where(F.col("event_id") % 2 == half)
        live.run_upserts(fixture.stream_values(events), table, scratch_path(lake.spark, "live-checkpoint"),
                         clock=lambda: AS_OF).awaitTermination()
    return table.read()


@query
def frontier_union(lake):
    """The completed fact's lines, moved to the days of the live table, and live lines after their store's last day."""
    moved = F.date_add("report_date", fixture.LIVE_SHIFT_DAYS)
    day_of_store = F.date_sub(F.lit(fixture.BATCH_BOUND).cast("date"), F.pmod(F.col("store_id").cast("int"), F.lit(5)))
    batch = lake.shaped("frontier_batch", lambda rows: conform(rows.withColumn("report_date", moved), LIVE_FACT)
                        .where(F.col("report_date") <= day_of_store))
    return live.frontier_view(batch, lake.live_lines()).select(
        "transaction_id", "product_id", "store_id", "report_date", "quantity", "final_amount", "source")


@query
def stream_dedup(lake):
    """Every event's messages delivered twice; each line is written once."""
    events = lake.landing.event_stream()
    twice = fixture.stream_values(events.unionAll(lake.landing.event_stream()))
    return _to_folder(lake, eventtime.deduplicated(live.sale_messages(twice)), "stream-dedup")


@query
def stream_hourly(lake):
    """Hours and stores that the watermark, an hour behind the newest sale, has closed."""
    lines = live.sale_messages(fixture.stream_values(lake.landing.event_stream()))
    return _to_folder(lake, eventtime.hourly(lines), "stream-hourly")


@query
def retention_filter(lake):
    return live.retained(lake.live_lines(), AS_OF).select("transaction_id", "product_id", "product_uom_id",
                                                          "report_date", "transaction_time", "total_amount")


@query
def lambda_union(lake):
    return lake.serving().select(*LIVE_FACT, "source")


@query
def mart_realtime(lake):
    return live.live_mart(lake.serving(), AS_OF)
