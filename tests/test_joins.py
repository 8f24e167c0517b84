import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillhouse.operators.dedup import one_per_key
from tillhouse.operators.joins import (
    as_of_join, broadcast_if_small, left_join_spread, range_join_effective, sliced, time_span, timeline_overlaps,
)
from tillhouse.operators.skew import running_sums

PRICE = "product string, area int, eff timestamp_ntz, nxt timestamp_ntz, price double"
FACT = "line int, product string, area int, ts timestamp_ntz"


def at(text):
    return datetime.fromisoformat(text)


def range_join(spark, facts, prices, **kw):
    out = range_join_effective(spark.createDataFrame(facts, FACT), spark.createDataFrame(prices, PRICE),
                               ["product", "area"], "ts", "eff", "nxt", **kw)
    return sorted(((r.line, r.price) for r in out.collect()), key=str)


def test_range_join_keeps_in_range_and_unknown_keys_and_drops_the_rest(spark):
    prices = [("p", 1, at("2024-01-01"), at("2024-06-01"), 1.0), ("p", 1, at("2024-06-01"), at("9999-12-31"), 2.0)]
    facts = [(1, "p", 1, at("2024-01-01")), (2, "p", 1, at("2024-05-31 23:59:59")), (3, "p", 1, at("2024-06-01")),
             (4, "p", 1, at("2023-12-31")),        # known key, before its first range: dropped
             (5, "q", 1, at("2024-02-01")),        # no timeline: kept
             (6, "p", None, at("2024-02-01")),     # null key part: no timeline, kept
             (7, "p", 1, None)]                    # no time: cannot be in range, dropped
    want = sorted([(1, 1.0), (2, 1.0), (3, 2.0), (5, None), (6, None)], key=str)
    for days in (1, 30, 5000):
        assert range_join(spark, facts, prices, bucket_days=days) == want
    assert range_join(spark, facts, prices, broadcast=False) == want


def test_range_join_null_start_matches_always(spark):
    prices = [("p", 1, None, None, 9.0), ("p", 1, at("2024-01-01"), at("2024-02-01"), 1.0)]
    facts = [(1, "p", 1, at("2024-01-05")), (2, "p", 1, at("2025-01-05")), (3, "p", 1, None)]
    assert range_join(spark, facts, prices) == sorted([(1, 1.0), (1, 9.0), (2, 9.0), (3, 9.0)], key=str)


def test_range_join_equals_brute_force(spark):
    rnd = random.Random(7)
    day = lambda: at("2024-01-01") + timedelta(hours=rnd.randrange(24 * 400))
    prices = [(rnd.choice("abcd"), rnd.randrange(2), *sorted((day(), day())), float(n)) for n in range(60)]
    facts = [(n, rnd.choice("abcdef"), rnd.randrange(2), day()) for n in range(300)]
    want = []
    for line, product, area, ts in facts:
        met = [p for p in prices if p[0] == product and p[1] == area]
        want += [(line, p[4]) for p in met if p[2] <= ts < p[3]] or ([] if met else [(line, None)])
    assert range_join(spark, facts, prices, bucket_days=20) == sorted(want, key=str)


def test_overlapping_ranges_are_found(spark):
    df = spark.createDataFrame([("a", 1, at("2024-01-01"), at("2024-03-01"), 1.0), ("a", 1, at("2024-02-01"), at("2024-04-01"), 1.0),
                                ("b", 1, at("2024-01-01"), at("2024-02-01"), 1.0), ("b", 1, at("2024-02-01"), at("2024-04-01"), 1.0)], PRICE)
    assert [r.product for r in timeline_overlaps(df, ["product", "area"], "eff", "nxt").collect()] == ["a"]


DIM = "store string, area int, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"


def test_as_of_join_boundaries_and_gaps(spark):
    dim = spark.createDataFrame([("S1", 1, at("1970-01-01"), at("2026-07-10"), False), ("S1", 2, at("2026-07-10"), at("9999-12-31"), True),
                                 ("S2", 7, at("2026-07-12"), at("9999-12-31"), True)], DIM)
    left = spark.createDataFrame([("t1", "S1", at("2026-07-09 23:59:59")), ("t2", "S1", at("2026-07-10")), ("t3", "S2", at("2026-07-11")),
                                  ("t4", "S9", at("2026-07-11")), ("t5", None, at("2026-07-11")), ("t6", "S1", None)],
                                 "txn string, store string, ts timestamp_ntz")
    out = as_of_join(left, dim, ["store"], "ts")
    assert out.columns == ["txn", "store", "ts", "area"]
    assert {r.txn: r.area for r in out.collect()} == {"t1": 1, "t2": 2, "t3": None, "t4": None, "t5": None, "t6": None}
    with pytest.raises(ValueError, match="area"):
        as_of_join(left.withColumn("area", F.lit(1)), dim, ["store"], "ts")


def test_span_of_an_empty_frame(spark):
    assert time_span(spark.createDataFrame([], FACT), "ts") is None
    assert range_join(spark, [(1, "z", 1, at("2024-01-01"))], [("p", 1, at("2024-01-01"), at("2024-02-01"), 1.0)][:1]) == [(1, None)]


def test_spread_join_is_a_left_join(spark):
    left = spark.range(200).selectExpr("id", "if(id % 3 = 0, null, id % 7) as k")
    right = spark.range(5).selectExpr("id as k", "id * 10 as v")
    got = sorted(map(tuple, left_join_spread(left, right, "k", "id").select("id", "k", "v").collect()), key=str)
    assert got == sorted(map(tuple, left.join(right, "k", "left").select("id", "k", "v").collect()), key=str)


def test_broadcast_needs_a_small_side(spark):
    small, big = spark.range(10), spark.range(10)
    assert "ResolvedHint" in broadcast_if_small(small)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in broadcast_if_small(big, limit=1)._jdf.queryExecution().analyzed().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, many of them exact copies."""
    return spark.range(6000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 500)) as k", "pmod(hash(id), 40) as o",
                                        "1 + id % 3 as w").repartition(6)


def test_numbering_of_a_hot_group_is_exact(skewed):
    spread = running_sums(skewed, ["k"], ["o"], before="b", total="n")
    rows = spread.collect()
    assert len(rows) == 6000
    for key in ("hot", "k1"):
        group = sorted((r for r in rows if r.k == key), key=lambda r: r.b)
        assert [r.b for r in group] == list(range(len(group)))
        assert [r.o for r in group] == sorted(r.o for r in group)
        assert {r.n for r in group} == {len(group)}


def test_running_weight_matches_a_window(skewed):
    unique = skewed.withColumn("u", F.row_number().over(Window.orderBy("k", "o", "w")))
    for slices in (1, 2):
        spread = running_sums(unique, ["k"], ["o", "u"], F.col("w"), before="b", total="n", slices=slices)
        w = Window.partitionBy("k").orderBy("o", "u")
        plain = unique.withColumn("b", F.sum("w").over(w) - F.col("w")).withColumn("n", F.sum("w").over(Window.partitionBy("k")))
        key = lambda df: sorted(map(tuple, df.select("k", "u", "b", "n").collect()))
        assert key(spread) == key(plain)


def test_many_hot_groups_are_exact_and_spread(spark):
    rows = spark.range(60_000).selectExpr("if(id % 3 = 0, null, id % 300) as k", "id div 300 as o", "id % 7 as x")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = running_sums(rows, ["k"], ["o"], before="b", total="n")
        held = out.where("k is null").groupBy(F.spark_partition_id().alias("p")).count().collect()
        bad = out.groupBy("k").agg(F.count("*").alias("c"), F.min("b").alias("lo"), F.max("b").alias("hi"),
                                   F.count_distinct("b").alias("d"), F.max("n").alias("n"))
        assert bad.where("c <> n or lo <> 0 or hi <> n - 1 or d <> n").count() == 0 and bad.count() == 201
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(held) == 8 and max(r["count"] for r in held) < 5000


def test_lines_and_versions_outside_the_span_still_meet(spark):
    spans = [None, (at("2020-01-01"), at("2021-01-01")), (at("2040-01-01"), at("2041-01-01")), (at("1990-01-01"), at("1990-01-02"))]
    dim = spark.createDataFrame([("p", 1, at("2020-01-01"), at("2030-01-01"), 1.0), ("q", 1, at("2000-01-01"), at("2001-01-01"), 2.0),
                                 ("r", 1, None, None, 3.0), ("s", 1, at("2010-01-01"), at("2011-01-01"), 4.0),
                                 ("s", 1, at("2012-01-01"), at("2013-01-01"), 5.0)], PRICE)
    fact = spark.createDataFrame([(i, p, 1, t) for i, (p, t) in enumerate(
        [(p, t) for p in "pqrsz" for t in (None, at("1950-01-01"), at("2000-06-01"), at("2010-06-01"), at("2011-06-01"),
                                           at("2012-06-01"), at("2024-01-01"), at("2035-01-01"))])], FACT)
    results = [sorted((r[0], r.price) for r in range_join_effective(
        fact, dim, ["product", "area"], "ts", "eff", "nxt", span=span, bucket_days=90).collect()) for span in spans]
    assert all(r == results[0] for r in results[1:]) and len(results[0]) == 8 + 8 + 1 + 1 + 2
    versions = dim.selectExpr("product", "price", "eff as valid_from", "nxt as valid_to")
    found = [sorted((r[0], r.price) for r in as_of_join(fact, versions, ["product"], "ts", span=span).collect()) for span in spans]
    assert all(f == found[0] for f in found[1:]) and sum(p is not None for _, p in found[0]) == 4


def test_a_large_exploded_side_gets_no_hint(spark):
    dim = spark.range(100).selectExpr("id as k", "timestamp_ntz'1900-01-01' as s", "timestamp_ntz'2100-01-01' as e")
    pieces = sliced(dim, "s", "e", (at("1900-01-01"), at("2100-01-01")), 1)
    assert "ResolvedHint" not in broadcast_if_small(pieces, limit=10_000_000)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in broadcast_if_small(dim, limit=10_000_000)._jdf.queryExecution().analyzed().toString()


def test_null_keys_are_spread(spark):
    left = spark.range(3000).selectExpr("id", "if(id % 3 = 0, null, cast(id % 50 as string)) as k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = left_join_spread(left, spark.range(50).selectExpr("cast(id as string) as k", "id as v"), "k", "id")
        nulls = out.where("k is null").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(nulls) == 8 and max(r["count"] for r in nulls) < 250


def test_one_per_key_prunes_before_the_shuffle(skewed):
    best = one_per_key(skewed, ["k"], [F.col("o").desc()])
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Partial")
    assert best.where("k = 'hot'").first().o == max(r.o for r in skewed.where("k = 'hot'").collect())
