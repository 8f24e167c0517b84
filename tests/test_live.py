import itertools
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tillhouse.functions.contracts import LIVE_FACT, LIVE_KEY
from tillhouse.sources.landing import Landing, stream_values
from tillhouse.streaming import live

SF = "/root/testdata/sf0.001"


def snapshot(df):
    return sorted(map(str, df.select(*LIVE_FACT).collect()))


@pytest.fixture(scope="module")
def messages(spark, tmp_path_factory):
    """The events' messages in three landed files; corrections may sit in any of them."""
    path = str(tmp_path_factory.mktemp("topic"))
    values = stream_values(Landing(spark, SF).raw("events"))
    values.repartition(3, F.xxhash64("value")).write.mode("overwrite").text(path)
    return path


@pytest.fixture(scope="module")
def expected(spark):
    return snapshot(live.latest(live.sale_messages(stream_values(Landing(spark, SF).raw("events")))))


def test_stream_equals_batch_and_restart_reads_nothing_twice(spark, tmp_path, messages, expected):
    table = live.LiveTable(spark, str(tmp_path / "live"), newest=live.EVENT_TIME)
    assert table.read().count() == 0
    for _ in range(2):
        source = spark.readStream.option("maxFilesPerTrigger", "1").text(messages)
        live.run_upserts(source, table, str(tmp_path / "checkpoint")).awaitTermination()
        assert snapshot(table.read()) == expected


def test_any_file_order_and_replays_give_the_same_table(spark, tmp_path, messages, expected):
    files = [f for f in spark.read.text(messages).inputFiles()]
    for n, order in enumerate(itertools.islice(itertools.permutations(files), 0, None, 2)):
        table = live.LiveTable(spark, str(tmp_path / f"live{n}"), newest=live.EVENT_TIME)
        for batch_id, file in enumerate(order):
            table.upsert(spark.read.text(file), batch_id)
        table.upsert(spark.read.text(order[1]), 1)  # redelivered after a crash
        assert snapshot(table.read()) == expected


def test_null_unit_ids_are_one_key(spark):
    sale = ('{"stream_type":"SALE_TRANSACTION","payload":{"store_code":"1","sale_transaction":[{"transaction_id":"A","document_date":%d,'
            '"sale_normal_items":[{"product_code":"p","total_amount":%d}]}]}}')
    df = spark.createDataFrame([(sale % (1000, 5),), (sale % (2000, 7),)], "value string")
    out = live.latest(live.sale_messages(df)).collect()
    assert [(r.product_uom_id, r.total_amount) for r in out] == [(None, 7.0)]


SALE = ('{"stream_type":"SALE_TRANSACTION","payload":{"store_code":"1","sale_transaction":[{"transaction_id":"%s",%s'
        '"sale_normal_items":[{"product_code":"p","total_amount":%d}]}]}}')


def sale(name, amount, ms=None):
    return (SALE % (name, "" if ms is None else f'"document_date":{ms},', amount),)


def test_a_new_checkpoint_replaces_no_rows(spark, tmp_path):
    table = live.LiveTable(spark, str(tmp_path / "live"))
    for n, names in enumerate(("AB", "CD")):
        topic = str(tmp_path / f"topic{n}")
        spark.createDataFrame([sale(x, n, 1000) for x in names], "value string").write.text(topic)
        for _ in range(2):  # the same checkpoint again reads nothing twice
            live.run_upserts(spark.readStream.text(topic), table, str(tmp_path / f"check{n}")).awaitTermination()
    assert sorted(r.transaction_id for r in table.read().collect()) == list("ABCD")


def test_the_later_arrival_wins_even_with_an_older_date(spark, tmp_path):
    frames = [spark.createDataFrame([sale("A", v, t)], "value string") for v, t in ((5, 9000), (7, 1000))]
    for newest, amount in ((live.ARRIVAL, 7.0), (live.EVENT_TIME, 5.0)):
        table = live.LiveTable(spark, str(tmp_path / newest), newest=newest)
        for n, frame in enumerate(frames):
            table.upsert(frame, n)
        assert [r.total_amount for r in table.read().collect()] == [amount]
    both = spark.createDataFrame([(*sale("A", 5, 9000), 1), (*sale("A", 7, 1000), 2)], "value string, offset long")
    table = live.LiveTable(spark, str(tmp_path / "offsets"))
    table.upsert(both, 0)
    assert [r.total_amount for r in table.read().collect()] == [7.0]


def test_retention_keeps_lines_of_unknown_age(spark):
    lines = live.sale_messages(spark.createDataFrame([sale("A", 1), sale("B", 2, 0), sale("C", 3, 1705700000000)], "value string"))
    kept = live.retained(lines, datetime(2024, 1, 20)).collect()
    assert sorted(r.transaction_id for r in kept) == ["A", "C"]


def test_noise_bad_text_and_itemless_sales_give_no_lines(spark):
    df = spark.createDataFrame([("{",), ('{"stream_type":"VIEW"}',), (None,),
                                ('{"stream_type":"SALE_TRANSACTION","payload":{"sale_transaction":[{"transaction_id":"A"}]}}',)], "value string")
    assert live.sale_messages(df).count() == 0


def test_large_amounts_keep_their_last_digit(spark):
    text = ('{"stream_type":"SALE_TRANSACTION","payload":{"sale_transaction":[{"transaction_id":"A","document_date":0,'
            '"sale_normal_items":[{"product_code":"p","total_amount":43330801}]}]}}')
    assert live.sale_messages(spark.createDataFrame([(text,)], "value string")).first().total_amount == 43330801.0


def test_retention_and_compaction(spark, tmp_path, messages):
    table = live.LiveTable(spark, str(tmp_path / "live"))
    table.upsert(spark.read.text(messages), 0)
    as_of = datetime(2024, 1, 20)
    kept = snapshot(live.retained(table.read(), as_of))
    assert 0 < len(kept) < table.read().count()
    compact = table.compact(as_of, str(tmp_path / "compact"))
    assert snapshot(compact.read()) == kept
    compact.upsert(spark.read.text(messages), 1)
    assert compact.read().count() == table.read().count()


def test_a_run_rolls_generations_and_readers_keep_theirs(spark, tmp_path, messages):
    as_of = datetime(2024, 1, 20)
    whole = live.LiveTable(spark, str(tmp_path / "whole"))
    rolled = live.LiveTable(spark, str(tmp_path / "rolled"))
    source = lambda: spark.readStream.option("maxFilesPerTrigger", "1").text(messages)
    live.run_upserts(source(), whole, str(tmp_path / "check-w")).awaitTermination()
    live.run_upserts(source(), rolled, str(tmp_path / "check-r"), clock=lambda: as_of).awaitTermination()
    assert rolled.generation() == 3 and len(list((tmp_path / "rolled").iterdir())) == 2
    assert snapshot(rolled.read()) == snapshot(whole.read(as_of)) == snapshot(live.retained(whole.read(), as_of))
    days = {p.name for p in (tmp_path / "rolled" / "generation-000003").rglob("report_date=*")}
    assert min(days) == "report_date=2024-01-17"
    before = rolled.read()
    kept = snapshot(before)
    rolled.roll(datetime(2024, 1, 25))
    assert snapshot(before) == kept and 0 < rolled.read().count() < len(kept)
    live.run_upserts(source(), rolled, str(tmp_path / "check-again")).awaitTermination()
    assert rolled.generation() == 4 and rolled.read().count() == whole.read().count()


def test_a_correction_out_of_retention_deletes_the_line(spark, tmp_path):
    """The newest version is dated before the days that are kept; the older one does not come back."""
    day = 86_400_000
    table = live.LiveTable(spark, str(tmp_path / "live"))
    for n, rows in enumerate(([sale("A", 5, 19 * day), sale("B", 1, 19 * day)], [sale("A", 7, 2 * day)])):
        table.upsert(spark.createDataFrame(rows, "value string"), n)
    assert [r.transaction_id for r in table.read(datetime(1970, 1, 21)).collect()] == ["B"]


def test_retention_reaches_the_scan(spark, tmp_path, messages):
    table = live.LiveTable(spark, str(tmp_path / "live"))
    table.upsert(spark.read.text(messages), 0)
    plan = table.read(datetime(2024, 1, 20))._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    wide = [line for line in scans if "product_name" in line]
    assert len(wide) == 1 and "report_date" in wide[0].split("PartitionFilters: [")[1].split("]")[0]
    assert all("product_name" not in line for line in scans if line not in wide)


def test_a_store_behind_keeps_its_live_lines(spark, messages):
    lines = live.latest(live.sale_messages(spark.read.text(messages)))
    stores = [r.store_id for r in lines.select("store_id").distinct().orderBy("store_id").limit(2).collect()]
    batch = lines.where(F.col("report_date") <= F.when(F.col("store_id") == stores[0], F.lit("2024-01-05").cast("date"))
                        .otherwise(F.lit("2024-01-20").cast("date"))).where(F.col("store_id") != stores[1])
    view = live.frontier_view(batch, lines.withColumn("staff_name", F.lit("live")))
    first = {r.store_id: r.d for r in view.where("source = 'rlt'").groupBy("store_id").agg(F.min("report_date").alias("d")).collect()}
    alone = lines.where(F.col("store_id") == stores[1]).agg(F.min("report_date")).first()[0]
    assert "2024-01-05" < str(first[stores[0]]) <= "2024-01-20" and first[stores[1]] == alone
    assert all(str(d) > "2024-01-20" for s, d in first.items() if s not in stores)
    assert view.where("source = 'eod'").count() == batch.count()
    assert view.groupBy(*LIVE_KEY).count().where("count > 1").count() == 0


def test_serving_view_hides_late_lines_of_batch_days(spark, messages):
    lines = live.latest(live.sale_messages(spark.read.text(messages)))
    batch = lines.where("report_date <= date'2024-01-10' and transaction_id <> 'E0'").where("product_uom_id is not null")
    view = live.serving_view(batch, lines)
    assert view.where("source = 'eod'").count() == batch.count()
    assert view.where("source = 'rlt'").agg(F.min("report_date")).first()[0].day == 11
    assert live.serving_view(batch, lines, prefer="latest").count() == lines.count()
    assert live.serving_view(batch.where("false"), lines).count() == lines.count()
    assert live.live_mart(view, datetime(2024, 1, 20)).agg(F.min("report_date")).first()[0].day == 13
    assert lines.groupBy(*LIVE_KEY).count().where("count > 1").count() == 0
