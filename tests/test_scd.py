import random
from datetime import date, timedelta

import pytest

from tillhouse.operators.scd import current_slice, is_versioned, scd2_apply, scd2_from_snapshots, scd2_initial

DIM, KEYS = "store_id string, tier string, area int", ["store_id"]
OPEN, EPOCH = "9999-12-31", "1970-01-01"


@pytest.fixture(scope="module")
def dim(spark):
    return lambda *rows: spark.createDataFrame(list(rows), DIM)


def state(df):
    return sorted(((r.store_id, r.tier, r.area, str(r.valid_from)[:10], str(r.valid_to)[:10], r.is_current)
                   for r in df.collect()), key=str)


def apply(current, incoming, day, **kw):
    return scd2_apply(current, incoming, KEYS, day, **kw)


def test_first_load_opens_everything_at_the_epoch(dim):
    first = scd2_initial(dim(("S1", "T1", 1), ("S2", "T1", 2)))
    assert is_versioned(first)
    assert state(first) == [("S1", "T1", 1, EPOCH, OPEN, True), ("S2", "T1", 2, EPOCH, OPEN, True)]


@pytest.mark.parametrize("second, want", [
    ([("S1", "T1", 1)], [("S1", "T1", 1, EPOCH, OPEN, True)]),
    ([("S1", "T2", 1)], [("S1", "T1", 1, EPOCH, "2026-07-10", False), ("S1", "T2", 1, "2026-07-10", OPEN, True)]),
    ([("S1", "T1", 1), ("S2", "T1", 2)], [("S1", "T1", 1, EPOCH, OPEN, True), ("S2", "T1", 2, "2026-07-10", OPEN, True)]),
    ([("S9", None, 1)], [("S1", "T1", 1, EPOCH, "2026-07-10", False), ("S9", None, 1, "2026-07-10", OPEN, True)]),
], ids=["same", "changed", "new key", "gone key"])
def test_one_day(dim, second, want):
    assert state(apply(scd2_initial(dim(("S1", "T1", 1))), dim(*second), "2026-07-10")) == want


def test_null_compare(dim):
    first = scd2_initial(dim(("S1", None, 1)))
    assert state(apply(first, dim(("S1", None, 1)), "2026-07-10")) == state(first)
    assert ("S1", "T1", 1, "2026-07-10", OPEN, True) in state(apply(first, dim(("S1", "T1", 1)), "2026-07-10"))


def test_same_day_change_replaces_and_same_day_key_vanishes(dim):
    s = apply(scd2_initial(dim(("S1", "T1", 1))), dim(("S1", "T2", 1), ("S2", "T1", 2)), "2026-07-10")
    assert state(apply(s, dim(("S1", "T3", 1)), "2026-07-10")) == [
        ("S1", "T1", 1, EPOCH, "2026-07-10", False), ("S1", "T3", 1, "2026-07-10", OPEN, True)]


def test_older_day_changes_nothing(dim):
    s = apply(scd2_initial(dim(("S1", "T1", 1))), dim(("S1", "T2", 1)), "2026-07-10")
    assert state(apply(s, dim(("S1", "T9", 9)), "2026-07-01")) == state(s)


def test_strict_guard_counts_closing_days(dim):
    s = apply(scd2_initial(dim(("S1", "T1", 1), ("S2", "T1", 1))), dim(("S1", "T1", 1)), "2026-07-10")
    late = dim(("S1", "T1", 1), ("S2", "T1", 1))
    assert state(apply(s, late, "2026-07-05")) != state(s)
    assert state(apply(s, late, "2026-07-05", strict=True)) == state(s)


def test_untracked_columns_do_not_open_versions(dim):
    s = scd2_initial(dim(("S1", "T1", 1)))
    assert state(apply(s, dim(("S1", "T2", 1)), "2026-07-10", tracked=["area"])) == state(s)


def test_current_slice(dim):
    s = apply(scd2_initial(dim(("S1", "T1", 1))), dim(("S1", "T2", 1)), "2026-07-10")
    assert [tuple(r) for r in current_slice(s).collect()] == [("S1", "T2", 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_snapshots_in_one_pass_equal_daily_applies(spark, dim, seed):
    rnd = random.Random(seed)
    days = [date(2026, 7, 1) + timedelta(days=n) for n in range(5)]
    snaps = {d: [(f"S{k}", rnd.choice(["T1", "T2", None]), rnd.randrange(2)) for k in range(6) if rnd.random() < 0.75] + [("S9", "T", 0)]
             for d in days}
    folded = scd2_initial(dim(*snaps[days[0]]))
    for d in days[1:]:
        folded = apply(folded, dim(*snaps[d]), d)
    rows = [(*row, d) for d, part in snaps.items() for row in part]
    once = scd2_from_snapshots(spark.createDataFrame(rows, DIM + ", day date"), KEYS, "day")
    assert state(once) == state(folded)


def test_guard_is_part_of_the_plan(dim):
    s = apply(scd2_initial(dim(("S1", "T1", 1))), dim(("S1", "T2", 1)), "2026-07-10")
    plan = s._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan and "Cross" not in plan
