"""Running sums and row numbers that stay distributed when one group holds much of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], weight: Column | int = 1, *,
                 before: str, total: str | None = None, slices: int = 1, deal_by: Sequence[str] = (), tie: str | None = None) -> DataFrame:
    """Add `before`, the weight of all earlier rows of the group, and optionally the group's `total`.

    With weight 1, `before + 1` is row_number(). A group is cut into slices by its first `slices` order columns: rows
    are summed up inside their slice, slices inside their group, and each row adds the two. So no task holds more rows
    of a group than have equal leading columns, or more than one row per slice, whatever the group holds; nothing is
    looked up beforehand and small inputs go the same way. Rows equal in all order columns are told apart by a hash
    of the whole row, so the order is total but for exact copies, which are interchangeable. A column that holds such a
    hash already is named as `tie`; then columns that nobody asks for need not be read to be hashed.

    Rows are dealt once. Where keys cannot be null they are dealt by the keys alone, and stay so for what is joined or
    grouped by them next; adaptive execution splits the partition of a hot group. `deal_by` names some of the keys by
    which rows are dealt instead, where what comes next goes by those.
    """
    weight = F.lit(weight) if isinstance(weight, int) else weight
    places = [o if isinstance(o, str) and o not in keys else f"_o{i}" for i, o in enumerate(order)]
    columns = {p: F.col(o) if isinstance(o, str) else o for p, o in zip(places, order, strict=True) if p != o}
    cut, rest = places[:slices], places[slices:]
    # what only orders rows inside a slice is made once they are dealt, and is not sent
    early, late = ({p: c for p, c in columns.items() if p in some} for some in (cut, rest))
    rows = df.withColumns(early) if early else df
    inside = Window.partitionBy(*keys, *cut).orderBy(*rest, "_tie").rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(*keys)
    slice_sums = rows.groupBy(*keys, *cut).agg(F.sum(weight.cast("long")).alias("_sum"))
    sums = (slice_sums.repartition(*deal_by) if deal_by else slice_sums).select(
        *keys, *cut,
        F.coalesce(F.sum("_sum").over(group.orderBy(*cut).rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_earlier"),
        *([F.sum("_sum").over(group.orderBy(*cut).rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing)).alias("_total")] if total else []))
    sums = sums.withColumnsRenamed({c: f"_s_{c}" for c in (*keys, *cut)})
    same = F.lit(True)
    for c in (*keys, *cut):
        mine, theirs = F.col(c), F.col(f"_s_{c}")
        same = same & (mine.eqNullSafe(theirs) if rows.schema[c].nullable else mine == theirs)
    out = rows.join(sums, same).withColumns({**late, "_tie": F.col(tie) if tie else F.xxhash64(*df.columns), "_weight": weight.cast("long")})
    out = out.withColumn("_inside", F.coalesce(F.sum("_weight").over(inside), F.lit(0)))
    return out.select(*df.columns, (F.col("_earlier") + F.col("_inside")).alias(before),
                      *([F.col("_total").alias(total)] if total else []))
