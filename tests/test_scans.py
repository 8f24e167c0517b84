from datetime import datetime

import pytest

from tillhouse.functions.calendar import RunWindow
from tillhouse.sources import tables

WINDOW = RunWindow.for_day("2025-11-17")
ORDERS = [(1, datetime(2025, 11, 15, 16, 59, 59)), (2, datetime(2025, 11, 15, 17)), (3, datetime(2025, 11, 18, 16, 59, 59)),
          (4, datetime(2025, 11, 18, 17)), (5, datetime(2025, 11, 16, 17)), (6, datetime(2025, 11, 17, 17))]


@pytest.fixture(scope="module")
def orders(spark):
    df = spark.createDataFrame(ORDERS, "order_id int, created_at timestamp_ntz")
    df.createOrReplaceTempView("delivery_orders")
    spark.createDataFrame([(n, f"d{n}") for n in (1, 2, 2, 3, 4, 9)], "order_id int, x string").createOrReplaceTempView("details")
    return df


def ids(df):
    return sorted(r.order_id for r in df.collect())


def test_windows_are_half_open(orders):
    assert ids(tables.windowed(orders, "created_at", WINDOW)) == [2, 3, 5, 6]
    assert ids(tables.in_business_window(orders, "created_at", WINDOW)) == [5]


def test_windowed_text_and_its_result(spark, orders):
    text = tables.windowed_sql("delivery_orders", "created_at", WINDOW)
    assert text == ("SELECT * FROM delivery_orders WHERE created_at >= TIMESTAMP '2025-11-15 17:00:00' "
                    "AND created_at < TIMESTAMP '2025-11-18 17:00:00'")
    assert ids(spark.sql(text)) == ids(tables.windowed(orders, "created_at", WINDOW))


def test_children_follow_their_parent(spark, orders):
    frame = tables.parent_windowed(spark.table("details"), orders, "order_id", "created_at", WINDOW)
    text = tables.parent_windowed_sql("details", "delivery_orders", "order_id", "created_at", WINDOW)
    assert ids(frame) == ids(spark.sql(text)) == [2, 2, 3]


def test_extract_policy_and_repair_switch(spark, orders):
    given = {"delivery_orders": orders, "delivery_order_details": spark.table("details"), "users": spark.range(3)}
    daily = tables.extract(given, WINDOW, tables.TRANSACTIONAL, tables.CHILDREN)
    assert ids(daily["delivery_orders"]) == [2, 3, 5, 6] and ids(daily["delivery_order_details"]) == [2, 2, 3]
    assert daily["users"].count() == 3
    whole = tables.extract(given, None, tables.TRANSACTIONAL, tables.CHILDREN)
    assert whole["delivery_orders"].count() == 6 and whole["delivery_order_details"].count() == 6


def test_optional_sources(spark, tmp_path):
    spark.range(2).write.json(str(tmp_path / "a"))
    read = lambda name: lambda: tables.landed_json(spark, str(tmp_path / name), "id long")
    assert tables.union_present({"a": read("a"), "b": read("b")}, "services").count() == 2
    with pytest.raises(ValueError, match="services"):
        tables.union_present({"b": read("b"), "c": read("c")}, "services")


def test_table_names():
    assert tables.table_name("gold", "fact") == "gold.fact"
    assert tables.table_name("gold", "fact", schemas=False) == "gold_fact"
