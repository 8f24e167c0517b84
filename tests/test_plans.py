import re
from datetime import date, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tillhouse.functions.calendar import RunWindow
from tillhouse.functions.contracts import PRODUCT_FACT
from tillhouse.plans import metrics, runs
from tillhouse.plans.catalog import registered
from tillhouse.plans.lakehouse import Lakehouse
from tillhouse.plans.oracles import ORACLES
from tillhouse.sources import tables

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
CHECKED = ["schema_conform", "json_roundtrip", "explode_outer", "channel_decode", "parent_windowed_scan", "sale_line", "promotion_agg",
           "delivery", "point_history", "range_join_effective", "as_of_join", "scd2_apply", "scd2_from_snapshots", "canceled_orders",
           "fact_product", "dq_product", "mart_sales_daily", "metric_base", "metric_wow", "metric_mom", "metric_7d_avg", "metric_customers",
           "dash_matrix", "dash_category", "dash_overview", "dash_store", "metric_ratios", "metric_identified", "top_products",
           "fact_service", "metric_service", "stream_upsert", "stream_restart", "stream_correction", "range_join_outside_span",
           "as_of_outside_span", "lambda_union", "stream_dedup", "stream_hourly",
           "daily_run_fact", "gated_publish", "gated_publish_mart", "published_runs", "published_failures",
           "stream_retention", "frontier_union", "mart_refresh", "product_history", "canceled_history", "landed_documents", "dash_weekday",
           "dash_weeks"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def rows(table):
    names = sorted(table.column_names)
    return names, sorted(map(repr, zip(*[table.column(n).to_pylist() for n in names])))


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql(spark, duck, name):
    assert rows(contract.queries()[name](spark, SF).toArrow()) == rows(duck.sql(contract.oracle_sql()[name]).to_arrow_table())


def test_every_query_has_its_sql():
    assert set(registered()) == set(ORACLES) and len(ORACLES) > 70
    assert set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_windows_reach_the_scan(spark):
    orders = Lakehouse(spark, SF).landing.raw("orders")
    text = plan(tables.windowed(orders, "o_orderdate", RunWindow.for_day("1996-03-01")).select("o_orderkey"))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(o_orderdate.*LessThan\(o_orderdate", text)
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>", text)


def test_fact_plan_has_no_cross_join_and_no_python(spark):
    text = plan(Lakehouse(spark, SF).product_fact())
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert word not in text


def test_bill_joins_share_the_numbering_partitioning(spark):
    """Promotions, transactions, points and deliveries join on the exchange the bill numbering already made."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lake = Lakehouse(spark, SF)
        from tillhouse.plans import lines
        bills = lines.numbered_bills(lake.landing.sale_bill(), lake.landing.sale_return_bill())
        text = plan(lake.gathered(bills).select("transaction_id", "promotion_id_arr", "rated.rating", "earned", "shipped.order_id", "_items"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the items travel in one exchange by transaction id, and in one more for the order-number join
    with_items = [line for line in re.findall(r"Exchange hashpartitioning\((\w+)", text)]
    assert with_items.count("order_no") == 2


@pytest.mark.parametrize("name", ["metric_ratios", "metric_identified", "dash_overview", "dash_store", "dash_identified"])
def test_distinct_counts_copy_baskets_not_lines(spark, name):
    text = plan(contract.queries()[name](spark, SF))
    if "Expand" in text:
        below = text[text.rindex("Expand"):]
        assert re.search(r"HashAggregate\(keys=\[[^]]*transaction_id", below)


@pytest.mark.parametrize("name", ["dash_matrix", "dash_category"])
def test_lines_fold_per_product_before_the_star_join(spark, name):
    text = plan(contract.queries()[name](spark, SF))
    assert re.search(r"Join.*HashAggregate\(keys=\[product_id", text, re.S)


def test_product_run_writes_checked_slices_and_can_be_repeated(spark, tmp_path):
    lake = Lakehouse(spark, SF)
    fact = lake.product_fact()
    days = [r.report_date for r in fact.select("report_date").distinct().orderBy("report_date").limit(3).collect()]
    run = runs.ProductRun(lake, str(tmp_path), runs.BLOCKING_CHECKS[:3])
    for part in (days, days[1:2]):
        run.run(part)
    key = lambda df: sorted(map(str, df.select(*PRODUCT_FACT).drop("feedback_at").collect()))
    assert key(run.fact()) == key(fact.where(F.col("report_date").isin(days)))
    assert run.fact().where("created_by <> 'eod_product' or created_at is null").count() == 0
    assert run.daily_mart().count() > 0
    assert sorted((r.step, r.status) for r in run.log().collect()) == sorted(
        [(step, "Succeeded") for step in ("gold", "gate", "mart")] * 2)


def test_a_run_reads_its_window(spark):
    """Every scan of orders is bounded by date, and lines, audits and details are read for orders in the window."""
    lake = Lakehouse(spark, SF).during(date(1996, 3, 1), date(1996, 3, 1))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        text = plan(lake.product_fact()) + plan(lake.service_fact())
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in text.splitlines() if "FileScan" in line]
    orders = [line for line in scans if "/orders.parquet" in line]
    assert len(orders) > 10
    assert all("GreaterThanOrEqual(o_orderdate" in line and "LessThan(o_orderdate" in line for line in orders)
    children = [line for line in scans if "/lineitem.parquet" in line or "/events.parquet" in line]
    assert children and text.count("LeftSemi") >= len(children)


@pytest.mark.parametrize("day", [date(1997, 12, 29), date(2001, 7, 28)])
def test_days_built_from_their_window_are_those_of_the_whole(spark, whole_facts, day):
    lake = Lakehouse(spark, SF).during(day, day + timedelta(days=6))
    chosen = F.col("report_date").between(F.lit(day), F.lit(day + timedelta(days=6)))
    for whole, part in zip(whole_facts, (lake.product_fact(), lake.service_fact())):
        key = lambda df: sorted(map(str, df.where(chosen).collect()))
        assert key(part) == key(whole) and key(whole)


@pytest.fixture(scope="module")
def whole_facts(spark):
    lake = Lakehouse(spark, SF)
    return lake.product_fact(), lake.service_fact()


def test_slicers(spark):
    mart = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "channel string, n int")
    count = lambda where: metrics.slice_rows(mart, where).count()
    assert (count({"n": (2, 3)}), count({"channel": ["a", "c"]}), count({"channel": "b"}), count(None)) == (2, 2, 1, 3)


def test_ratio_is_null_on_zero(spark):
    mart = spark.createDataFrame([("x", "T1", 0.0, 1.0)], "k string, transaction_id string, revenue_net double, cogs double")
    row = metrics.sales(mart, ["gross_margin", "margin_pct"], ["k"]).first()
    assert row.gross_margin == -1.0 and row.margin_pct is None


def test_month_shift_clamps_like_a_calendar(spark):
    mart = spark.createDataFrame([("2024-01-30", 1.0), ("2024-01-31", 2.0), ("2024-02-10", 4.0), ("2024-03-05", 8.0)],
                                 "report_date string, revenue_net double").withColumn("report_date", F.to_date("report_date"))
    got = {r.month_key: (r.revenue, r.revenue_pm) for r in metrics.month_over_month(mart).collect()}
    # March ends on the 5th, so February's 10th is not yet compared with anything
    assert got == {"2024-01": (3.0, None), "2024-02": (4.0, 3.0), "2024-03": (8.0, None)}


def test_trailing_average_divides_by_seven_from_the_first_day(spark):
    mart = spark.createDataFrame([("2024-01-01", 7.0), ("2024-01-09", 14.0)], "report_date string, revenue_net double").withColumn(
        "report_date", F.to_date("report_date"))
    got = {r.date.day: r.revenue_avg_day for r in metrics.trailing_average(mart).collect()}
    assert got[1] == 1.0 and got[7] == 1.0 and 8 not in got and got[9] == 2.0
