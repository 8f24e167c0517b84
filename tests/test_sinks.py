from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from tillhouse.plans import runs
from tillhouse.sources import sinks
from tillhouse.sources.sinks import SnapshotTable, advance_dimension, append, exists, read_slices, write_slices

SCHEMA = "id int, note string, report_date date"
D = [date(2025, 11, n) for n in range(1, 5)]


def content(spark, path):
    return sorted((r.id, r.report_date) for r in read_slices(spark, path, SCHEMA).collect())


@pytest.fixture()
def frame(spark):
    return lambda *rows: spark.createDataFrame([(i, "x", d) for i, d in rows], SCHEMA)


def test_only_named_slices_change_and_reruns_repeat(spark, tmp_path, frame):
    path = str(tmp_path / "t")
    assert content(spark, path) == []
    write_slices(frame((1, D[0]), (2, D[1])), path, "report_date", D[:2])
    for _ in range(2):
        write_slices(frame((3, D[1]), (4, D[1])), path, "report_date", [D[1]])
        assert content(spark, path) == [(1, D[0]), (3, D[1]), (4, D[1])]


def test_an_empty_slice_is_removed(spark, tmp_path, frame):
    path = str(tmp_path / "t")
    write_slices(frame((1, D[0]), (2, D[1])), path, "report_date", D[:2])
    assert write_slices(frame((5, D[2])), path, "report_date", D[1:3]) == {"2025-11-03"}
    assert content(spark, path) == [(1, D[0]), (5, D[2])]
    write_slices(frame((9, D[0])).where("false"), path, "report_date", [D[0]])
    assert content(spark, path) == [(5, D[2])]


@pytest.mark.parametrize("stray", [D[3], None])
def test_a_row_outside_the_slices_fails_and_leaves_the_table(spark, tmp_path, frame, stray):
    path = str(tmp_path / "t")
    write_slices(frame((1, D[0])), path, "report_date", [D[0]])
    with pytest.raises(Exception, match="outside the written slices"):
        write_slices(frame((2, D[0]), (3, stray)), path, "report_date", [D[0]])
    assert content(spark, path) == [(1, D[0])]
    with pytest.raises(ValueError):
        write_slices(frame((1, D[0])), path, "report_date", [])


@pytest.mark.parametrize("dies_at", range(5))
def test_a_write_that_dies_while_publishing_is_finished_by_the_next(spark, tmp_path, frame, monkeypatch, dies_at):
    """Two slices replaced and one cleared; the run stops before its n-th change to the table."""
    path = str(tmp_path / "t")
    write_slices(frame((1, D[0]), (2, D[1]), (3, D[2]), (4, D[3])), path, "report_date", D)
    original, left = sinks._fs, [dies_at]

    class Dying:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            def call(*args):
                if name in ("delete", "rename") and "_intents" not in args[0].toString():
                    if not left[0]:
                        raise KeyboardInterrupt
                    left[0] -= 1
                return getattr(self.fs, name)(*args)
            return call

    monkeypatch.setattr(sinks, "_fs", lambda s, p: (Dying(original(s, p)[0]), original(s, p)[1]))
    with pytest.raises(KeyboardInterrupt):
        write_slices(frame((5, D[0]), (6, D[1]), (7, D[1])), path, "report_date", D[:3])
    monkeypatch.setattr(sinks, "_fs", original)
    write_slices(frame((8, D[3])), path, "report_date", [D[3]])
    assert content(spark, path) == [(5, D[0]), (6, D[1]), (7, D[1]), (8, D[3])]
    assert sinks.recover(spark, path) == [] and not list((tmp_path / "t" / "_staged").iterdir())


def test_staged_rows_are_not_read_until_they_are_published(spark, tmp_path, frame):
    path = str(tmp_path / "t")
    write_slices(frame((1, D[0]), (2, D[1])), path, "report_date", D[:2])
    run = sinks.new_run()
    written = sinks.stage_slices(frame((3, D[0]), (4, D[2])), path, "report_date", D[:3], run)
    assert written == {str(D[0]), str(D[2])} and content(spark, path) == [(1, D[0]), (2, D[1])]
    sinks.publish_slices(spark, path, "report_date", run, [D[0], D[1]], written)  # the third slice is held back
    assert content(spark, path) == [(3, D[0])]


def test_snapshot_table_replaces_itself_and_may_change_schema(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "dim"))
    assert table.read() is None
    rows = lambda tier: spark.createDataFrame([("S1", tier)], "store_id string, tier string")
    table.replace(rows("T0"))                                              # no versions yet
    advance_dimension(table, rows("T1"), ["store_id"], "2026-07-01")       # starts history
    before = table.read()
    advance_dimension(table, rows("T2"), ["store_id"], "2026-07-10")
    assert sorted((r.tier, r.is_current) for r in table.read().collect()) == [("T1", False), ("T2", True)]
    assert before.count() == 1  # readers keep the state they opened


def test_a_failed_snapshot_is_never_seen(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "dim"))
    table.replace(spark.range(3))
    with pytest.raises(Exception, match="broken"):
        table.replace(spark.range(5).select(F.when(F.col("id") > 3, F.raise_error(F.lit("broken"))).otherwise("x").alias("y")))
    assert table.read().count() == 3
    assert table.replace(spark.range(7)).count() == 7


def test_void_columns_can_be_appended(spark, tmp_path):
    path = str(tmp_path / "log")
    for _ in range(2):
        append(spark.range(1).withColumn("n", F.lit(None)), path)
    assert exists(spark, path) and spark.read.parquet(path).dtypes == [("id", "bigint"), ("n", "string")]
    assert spark.read.parquet(path).count() == 2


def boom():
    raise RuntimeError("silver exploded")


def test_run_log_on_success_failure_and_skipped_ingest(spark, tmp_path):
    log = str(tmp_path / "log")
    ok = lambda: None
    runs.run_steps(spark, "good", "2025-11-17", {"ingest": ok, "silver": ok, "gold": ok}, log)
    with pytest.raises(RuntimeError, match="silver exploded"):
        runs.run_steps(spark, "bad", "2025-11-18", {"ingest": ok, "silver": boom, "gold": ok}, log)
    runs.run_steps(spark, "short", "2025-11-19", {"silver": ok, "gold": ok}, log)
    steps = lambda name: sorted((r.step, r.status) for r in spark.read.parquet(log).where(F.col("pipeline") == name).collect())
    assert steps("good") == [("gold", "Succeeded"), ("ingest", "Succeeded"), ("silver", "Succeeded")]
    assert steps("bad") == [("ingest", "Succeeded"), ("silver", "Failed")]
    assert steps("short") == [("gold", "Succeeded"), ("silver", "Succeeded")]
    failed = runs.failed_runs(spark.read.parquet(log), datetime.now(timezone.utc).replace(tzinfo=None))
    assert [(r.pipeline, r.step, r.error) for r in failed.collect()] == [("bad", "silver", "silver exploded")]
    assert runs.failed_runs(spark.read.parquet(log), datetime(2020, 1, 1)).count() >= 1
    assert runs.run_summary(spark.read.parquet(log)).count() == 7


def test_a_broken_log_never_fails_the_run(spark):
    heard = []
    runs.run_steps(spark, "p", "2025-11-17", {"gold": lambda: None}, "nosuchfs://x/log", warn=heard.append)
    assert len(heard) == 1


def test_backfill_equals_one_run_per_day(spark, tmp_path):
    facts = spark.range(40).selectExpr("cast(id as int) id", "'x' note", "date_add(date'2025-11-01', cast(id % 4 as int)) report_date")
    once, daily = str(tmp_path / "once"), str(tmp_path / "daily")
    runs.backfill(lambda: facts, once, "report_date", D)
    for d in D:
        write_slices(facts.where(F.col("report_date") == F.lit(d)), daily, "report_date", [d])
    assert content(spark, once) == content(spark, daily) and len(content(spark, once)) == 40
