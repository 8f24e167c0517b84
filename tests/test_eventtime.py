from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tillhouse.functions.contracts import LIVE_FACT
from tillhouse.sources.landing import Landing, stream_values
from tillhouse.streaming import eventtime
from tillhouse.streaming.live import sale_messages

SF = "/root/testdata/sf0.001"
START = datetime(2024, 1, 1)


def sale(name, minute, amount=1.0, store="1"):
    ms = "null" if minute is None else int((START - datetime(1970, 1, 1) + timedelta(minutes=minute)).total_seconds() * 1000)
    return ('{"stream_type":"SALE_TRANSACTION","payload":{"store_code":"%s","sale_transaction":[{"transaction_id":"%s","document_date":%s,'
            '"sale_normal_items":[{"product_code":"p","quantity":1,"total_amount":%s}]}]}}' % (store, name, ms, amount))


class Topic:
    """Landed text files, run to empty after each delivery under one checkpoint."""

    def __init__(self, spark, folder, shape):
        self.spark, self.folder, self.shape, self.n = spark, folder, shape, 0

    def deliver(self, *messages):
        path = self.folder / "topic"
        path.mkdir(exist_ok=True)
        (path / f"{self.n:03d}.txt").write_text("\n".join(messages))
        self.n += 1

    def run(self):
        stream = self.spark.readStream.option("maxFilesPerTrigger", 1).text(str(self.folder / "topic"))
        query = eventtime.run_to_folder(self.shape(sale_messages(stream)), str(self.folder / "out"), str(self.folder / "check"))
        query.awaitTermination()
        eventtime.record_progress(query, str(self.folder / "progress"))
        return query

    def rows(self):
        return self.spark.read.parquet(str(self.folder / "out")).collect()

    def progress(self):
        return self.spark.read.parquet(str(self.folder / "progress")).orderBy("batch").collect()


def test_batches_and_restarts_give_what_one_batch_gives(spark, tmp_path):
    """The given events, delivered twice in one batch, and over two files and a restart."""
    values = [r.value for r in stream_values(Landing(spark, SF).raw("events").orderBy("ts")).collect()]
    half = len(values) // 2
    seen = []
    for n, deliveries in enumerate(([values + values], [values[:half] + values[:50], values[half - 20:] + values[-50:], values[-30:]])):
        folder = tmp_path / str(n)
        folder.mkdir()
        topic = Topic(spark, folder, lambda lines: eventtime.deduplicated(lines, "400 days"))
        for i, messages in enumerate(deliveries):
            topic.deliver(*messages)
            if i:
                topic.run()  # two files in the first run, the third after a restart
        if len(deliveries) == 1:
            topic.run()
        topic.run()          # nothing new
        seen.append(sorted(map(str, (tuple(r[c] for c in LIVE_FACT) for r in topic.rows()))))
    once = sale_messages(spark.createDataFrame([(v,) for v in values], "value string"))
    want = sorted(map(str, (tuple(r[c] for c in LIVE_FACT) for r in once.where("transaction_time is not null").collect())))
    assert seen[0] == want and seen[1] == want


def test_dedup_state_is_bounded_and_late_copies_do_not_return(spark, tmp_path):
    topic = Topic(spark, tmp_path, lambda lines: eventtime.deduplicated(lines, "10 minutes"))
    for hour in range(4):
        topic.deliver(*[sale(f"{hour}-{i}", 60 * hour + i) for i in range(20)] * 2)
        topic.run()
    topic.deliver(sale("0-3", 3), sale("3-19", 199))      # long past, and just seen
    topic.run()
    assert sorted(r.transaction_id for r in topic.rows()) == sorted(f"{h}-{i}" for h in range(4) for i in range(20))
    progress = topic.progress()
    assert max(r.state_rows for r in progress) <= 40       # 80 keys went through
    assert progress[-1].late_rows == 1 or sum(r.late_rows for r in progress) == 1


def test_nulls_in_the_key_are_one_and_lines_without_a_moment_stay_out(spark, tmp_path):
    topic = Topic(spark, tmp_path, eventtime.deduplicated)
    topic.deliver(sale("A", 1), sale("A", 1), sale("A", 2), sale("B", None))
    topic.run()
    assert sorted((r.transaction_id, r.transaction_time.minute) for r in topic.rows()) == [("A", 1), ("A", 2)]


@pytest.mark.parametrize("files_per_run", [1, 3])
def test_hours_are_written_once_when_the_watermark_passes(spark, tmp_path, files_per_run):
    topic = Topic(spark, tmp_path, lambda lines: eventtime.hourly(lines, "30 minutes"))
    deliveries = [[sale("a", 5, 1.5), sale("b", 50, 2), sale("c", 55, 4, "2")],
                  [sale("d", 80, 8), sale("e", 58, 16)],              # e is late, but before the watermark
                  [sale("f", 130, 32)],                               # closes the first hour
                  [sale("g", 59, 64), sale("h", 70, 128), sale("i", 230, 256)]]  # g is behind the watermark, h is not
    for i, messages in enumerate(deliveries):
        topic.deliver(*messages)
        if i % files_per_run == files_per_run - 1 or i == len(deliveries) - 1:
            topic.run()
    got = {((r.hour - timedelta(hours=START.hour)).hour, r.store_id): (r.lines, r.revenue) for r in topic.rows()}
    first = min(h for h, _ in got)
    assert got == {(first, "1"): (3, 19.5), (first, "2"): (1, 4.0), (first + 1, "1"): (2, 136.0), (first + 2, "1"): (1, 32.0)}
    assert sum(r.late_rows for r in topic.progress()) == 1
