from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillhouse.plans.dims import Dimensions
from tillhouse.plans.refresh import refresh_mart
from tillhouse.sources.sinks import SnapshotTable, read_slices, write_slices
from tillhouse.sources.tables import good_documents, parsed_documents, quarantined, union_present

SCHEMA, MART = "id int, amount double, report_date date", "n bigint, amount double, report_date date"
D = [date(2025, 11, n) for n in range(1, 6)]


def build(fact):
    return fact.groupBy("report_date").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))


def files(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet") if "_staged" not in str(p)}


def test_only_slices_with_other_rows_are_built_again(spark, tmp_path):
    fact, mart = str(tmp_path / "fact"), str(tmp_path / "mart")
    frame = lambda *rows: spark.createDataFrame([(i, float(i), d) for i, d in rows], SCHEMA)
    read = lambda: read_slices(spark, fact, SCHEMA)
    refresh = lambda: refresh_mart(read(), mart, "report_date", build)
    content = lambda: sorted((r.report_date, r.n, r.amount) for r in read_slices(spark, mart, MART).collect())
    write_slices(frame(*[(i, d) for i in range(6) for d in D[:4]]), fact, "report_date", D[:4])
    assert refresh() == {str(d) for d in D[:4]}
    assert refresh() == set()
    before = files(mart)
    # one day changed, one written again with the same rows in other files, one gone, one new
    write_slices(frame((1, D[0]), (1, D[0])), fact, "report_date", [D[0]])
    write_slices(frame(*[(i, D[1]) for i in range(5, -1, -1)]).repartition(3), fact, "report_date", [D[1]])
    write_slices(frame((9, D[4])), fact, "report_date", [D[2], D[4]])
    assert refresh() == {str(D[0]), str(D[2]), str(D[4])}
    assert content() == sorted((r.report_date, r.n, r.amount) for r in build(read()).collect())
    after = files(mart)
    untouched = [f for f in before if f"report_date={D[1]}" in f or f"report_date={D[3]}" in f]
    assert untouched and all(after.get(f) == before[f] for f in untouched)
    assert refresh() == set()


def test_a_refresh_that_dies_is_done_again(spark, tmp_path, monkeypatch):
    fact, mart = str(tmp_path / "fact"), str(tmp_path / "mart")
    write_slices(spark.createDataFrame([(1, 1.0, D[0])], SCHEMA), fact, "report_date", [D[0]])
    monkeypatch.setattr(SnapshotTable, "replace", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        refresh_mart(read_slices(spark, fact, SCHEMA), mart, "report_date", build)
    monkeypatch.undo()
    assert refresh_mart(read_slices(spark, fact, SCHEMA), mart, "report_date", build) == {str(D[0])}


def test_dimensions_follow_the_policy_and_changing_columns(spark, tmp_path):
    dims = Dimensions(spark, str(tmp_path), {"store": ("id",)})
    with pytest.raises(ValueError):
        dims.read("store")
    rows = lambda text, *rows: spark.createDataFrame(list(rows), text)
    dims.advance("store", rows("id int, tier string", (1, "a"), (2, "a")), "2025-01-01")
    # a column more is no change; a changed row opens a version that has it
    dims.advance("store", rows("id int, tier string, area int", (1, "a", 5), (2, "b", 6)), "2025-02-01")
    # a column less is no change either; a changed row opens a version without it
    dims.advance("store", rows("id int, area int", (1, 5), (2, 7), (3, 8)), "2025-03-01")
    got = {(r.id, r.tier, r.area, str(r.valid_from)[:10], r.is_current) for r in dims.read("store").collect()}
    assert got == {(1, "a", 5, "1970-01-01", True), (2, "a", None, "1970-01-01", False), (2, "b", 6, "2025-02-01", False),
                   (2, None, 7, "2025-03-01", True), (3, None, 8, "2025-03-01", True)}
    for tier in "ab":
        dims.advance("plain", rows("id int, tier string", (1, tier)), "2025-01-01")
    assert [tuple(r) for r in dims.read("plain").collect()] == [(1, "b")]


def test_landed_documents_good_broken_and_absent(spark, tmp_path):
    landed = tmp_path / "bills"
    landed.mkdir()
    (landed / "a.json").write_text('{"_id": "A", "n": 1}\n{"_id": "B", "n": \n{"_id": "C", "n": "x"}\nnull\n{"_id": "D"}\n[1]\n')
    read = lambda name: lambda: parsed_documents(spark, str(tmp_path / name), "_id string, n int")
    parsed = union_present({n: read(n) for n in ("bills", "never")}, "bills")
    good = sorted((r._id, r.n) for r in good_documents(parsed).collect() if r._id)
    assert good == [("A", 1), ("D", None)]
    bad = {r.text: r.file for r in quarantined(parsed).collect()}
    assert set(bad) >= {'{"_id": "B", "n": ', '{"_id": "C", "n": "x"}'} and set(bad.values()) == {"a.json"}
    with pytest.raises(ValueError):
        union_present({"never": read("never")}, "bills")
