from datetime import date, datetime

from pyspark.sql import functions as F

from tillhouse.functions import calendar as cal
from tillhouse.functions import decode


def test_business_day_window():
    w = cal.RunWindow.for_day("2025-11-17")
    assert (w.utc_lo, w.utc_hi) == (datetime(2025, 11, 16, 17), datetime(2025, 11, 17, 17))
    assert (w.cover_lo, w.cover_hi) == (datetime(2025, 11, 15, 17), datetime(2025, 11, 18, 17))
    assert cal.RunWindow.for_day("2025-11-17", cover_days=0).cover_lo == w.utc_lo
    assert cal.RunWindow.for_days("2025-11-17", 3).utc_hi == datetime(2025, 11, 19, 17)


def test_default_run_day_is_yesterday_in_local_time():
    assert cal.yesterday(datetime(2025, 11, 17, 16, 59)) == date(2025, 11, 16)
    assert cal.yesterday(datetime(2025, 11, 17, 17, 0)) == date(2025, 11, 17)


def test_local_time_crosses_midnight(spark):
    df = spark.sql("select timestamp_ntz'2024-01-31 18:30:00' as t").select(cal.local_time(F.col("t")).alias("t"))
    assert df.first().t == datetime(2024, 2, 1, 1, 30)


def test_epoch_ms_keeps_millis_in_any_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        df = spark.createDataFrame([(1700000000123,)], "ms long").select(cal.from_epoch_ms(F.col("ms")).alias("t"))
        assert df.first().t == datetime(2023, 11, 14, 22, 13, 20, 123000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_calendar_has_every_day_and_monday_weeks(spark):
    days = spark.createDataFrame([(date(2024, 2, 28),), (date(2024, 3, 3),)], "d date")
    got = cal.calendar(days, "d").orderBy("date").collect()
    assert [r.date.day for r in got] == [28, 29, 1, 2, 3]
    assert [r.weekday_no for r in got] == [3, 4, 5, 6, 7]
    assert [r.day_type for r in got][-2:] == ["Weekend", "Weekend"]
    assert got[-1].week_start == date(2024, 2, 26)
    assert cal.calendar(days.where("false"), "d").count() == 0


def test_demographics_from_numbers_text_and_unknowns(spark):
    df = spark.createDataFrame([("1", "2", "0"), ("9", "0", "7"), (None, None, None)], "g string, a string, n string")
    pick = lambda frame, **kw: [tuple(r) for r in frame.select(
        *[c.alias(k) for k, c in decode.demographics("g", "a", "n", **kw).items()]).collect()]
    assert pick(df) == [("Male", "Student", "Vietnamese"), ("", "", ""), ("", "", "")]
    assert pick(df, keep_unknown_age=True) == [("Male", "Student", "Vietnamese"), ("", "0", ""), ("", None, "")]
    numbers = df.selectExpr("cast(g as int) g", "cast(a as int) a", "cast(n as int) n")
    assert pick(numbers) == pick(df)


def test_report_channel_order_of_rules(spark):
    df = spark.createDataFrame([("app", "Savyu"), ("", "my SAVYU shop"), (None, "x7Now"), (None, "Grab"), (None, ""), (None, None)],
                               "s string, c string")
    assert [r[0] for r in df.select(decode.report_channel("s", "c")).collect()] == [
        "7NOW", "Savyu", "7NOW", "Grab", "Store", "Store"]


def test_daypart_bounds(spark):
    df = spark.createDataFrame([(h,) for h in (5, 6, 10, 11, 13, 14, 16, 17, 21, 22)], "h int")
    assert [r[0][0] for r in df.select(decode.daypart("h")).collect()] == list("5112233445")
