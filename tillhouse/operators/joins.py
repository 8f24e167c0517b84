"""Effective-dated, point-in-time and null-heavy joins."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.session import PACKED, fits, scratch_path

BROADCAST_BYTES = 32 * 1024 * 1024
VERSION_COLUMNS = ("valid_from", "valid_to", "is_current")


def broadcast_if_small(dim: DataFrame, wanted: bool = True, limit: int = BROADCAST_BYTES, otherwise: str | None = None) -> DataFrame:
    """Broadcast hint only below a size that was counted; above it Spark shuffles and adapts.

    Spark may still broadcast what its files make small: well compressed columns are many times their files once they are
    rows on the driver. A hint given as `otherwise` rules that out.
    """
    if wanted and fits(dim, limit):
        return F.broadcast(dim)
    return dim.hint(otherwise) if otherwise else dim


def written(df: DataFrame) -> DataFrame:
    """The frame as a table in the shared folder: made once, and of a size that is known from its files."""
    path = scratch_path(df.sparkSession, "pieces")
    df.write.parquet(path, compression=PACKED)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def left_join_spread(left: DataFrame, right: DataFrame, key: str, spread_by: str) -> DataFrame:
    """Left join whose null-key rows do not meet in one partition.

    Null keys match nothing, so they may go anywhere: the join gets the key's hash as a second key, and rows
    without a key take the hash of `spread_by` there. A stable hash, so a retried task sends them the same way.
    """
    spread = F.when(F.col(key).isNull(), F.xxhash64(spread_by)).otherwise(F.xxhash64(key))
    return (left.withColumn("_spread", spread)
            .join(right.withColumn("_spread", F.xxhash64(key)), [key, "_spread"], "left").drop("_spread"))


def days_bucket(moment: Column, bucket_days: int) -> Column:
    return F.floor(F.unix_date(moment.cast("date")) / F.lit(bucket_days)).cast("int")


def time_span(df: DataFrame, ts: str) -> tuple[datetime, datetime] | None:
    """First and last moment in a frame: two values on the driver."""
    row = df.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).first()
    return None if row["lo"] is None else (row["lo"], row["hi"])


def _edges(span: tuple[datetime, datetime], bucket_days: int) -> tuple[Column, Column]:
    return tuple(days_bucket(F.lit(moment).cast("timestamp_ntz"), bucket_days) for moment in span)


def sliced(dim: DataFrame, start: str, end: str, span: tuple[datetime, datetime], bucket_days: int) -> DataFrame:
    """One row per version and time bucket it touches. A version that starts at null is in force always.

    What lies before or after the span is in the first or last bucket, for versions and for lines alike; a wrong
    span costs speed and no row.
    """
    lo, hi = _edges(span, bucket_days)
    at = lambda name: F.greatest(F.least(days_bucket(F.col(name).cast("timestamp_ntz"), bucket_days), hi), lo)
    first = F.when(F.col(start).isNull(), lo).otherwise(at(start))
    last = F.when(F.col(start).isNull() | F.col(end).isNull(), hi).otherwise(at(end))
    return dim.where(first <= last).withColumn("_bucket", F.explode(F.sequence(first, last)))


def _span_of(left: DataFrame, ts: str, span: tuple[datetime, datetime] | None) -> tuple[datetime, datetime]:
    return span or time_span(left, ts) or (datetime(1970, 1, 1), datetime(1970, 1, 1))


def _covering(left: DataFrame, pieces: DataFrame, keys: Sequence[str], ts: str, start: str, end: str,
              span: tuple[datetime, datetime], bucket_days: int, always: Column) -> DataFrame:
    """Left join on keys, time bucket and start <= ts < end, or where `always` holds; dim columns are `_d_<name>`.

    The bucket in the key keeps a line from meeting every version of its key, and splits a hot key over time. Lines
    without a moment are in the last bucket.
    """
    pieces = pieces.selectExpr(*[f"{c} as _d_{c}" for c in pieces.columns])
    moment = F.col(ts)
    inside = ((F.col(f"_d_{start}") <= moment) & (moment < F.col(f"_d_{end}"))) | always
    lo, hi = _edges(span, bucket_days)
    bucket = F.greatest(F.least(days_bucket(moment.cast("timestamp_ntz"), bucket_days), hi), lo)
    left = left.withColumn("_bucket", F.when(moment.isNull(), hi).otherwise(bucket))
    match = [F.col(k) == F.col(f"_d_{k}") for k in keys]
    match += [F.col("_bucket") == F.col("_d__bucket"), inside]
    return left.join(pieces, reduce(lambda a, b: a & b, match), "left").drop("_bucket")


FIRST_MOMENT, LAST_MOMENT = "0001-01-01 00:00:00", "9999-12-31 23:59:59.999999"


def with_gaps(dim: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """The versions, and between, before and after them the times of a key without one, marked by `_gap`.

    `_gap` is null for versions, 1 for gaps, 2 for the last gap of a key. A key with a version that starts at null has
    no gap.
    """
    edge = lambda moment: F.lit(moment).cast("timestamp_ntz")
    since, until = (F.col(name).cast("timestamp_ntz") for name in (start, end))
    marks = dim.withColumn("_upto", F.when(until > since, until))
    group = Window.partitionBy(*keys)
    ordered = group.orderBy(since, "_upto")
    reached = lambda last: F.greatest(edge(FIRST_MOMENT), F.max("_upto").over(
        ordered.rowsBetween(Window.unboundedPreceding, last)))
    marks = marks.select(*dim.columns, F.max(F.col(start).isNull()).over(group).alias("_covered"), reached(-1).alias("_before"),
                         reached(Window.currentRow).alias("_end"), F.lead(F.lit(1)).over(ordered).isNull().alias("_last"))
    # the version itself, what lies open before it, and what lies open after the last one: a row of the timeline is read once
    gap = lambda wanted, first, last, kind: F.when(~F.col("_covered") & wanted, F.struct(
        first.alias("_from"), last.alias("_to"), kind.cast("int").alias("_gap")))
    nothing = F.lit(None).cast("timestamp_ntz")
    pieces = marks.select(*dim.columns, F.explode(F.array_compact(F.array(
        F.struct(nothing.alias("_from"), nothing.alias("_to"), F.lit(None).cast("int").alias("_gap")),
        gap(since > F.col("_before"), F.col("_before"), since, F.when(since == edge(LAST_MOMENT), 2).otherwise(1)),
        gap(F.col("_last") & (F.col("_end") < edge(LAST_MOMENT)), F.col("_end"), edge(LAST_MOMENT), F.lit(2))))).alias("_g"))
    kinds = {f.name: f.dataType for f in dim.schema.fields}
    version = F.col("_g._gap").isNull()
    bound = lambda name, value: F.when(version, F.col(name)).otherwise(F.col(value).cast(kinds[name])).alias(name)
    return pieces.select(*[F.col(c) if c in keys else bound(c, "_g._from") if c == start else bound(c, "_g._to") if c == end
                           else F.when(version, F.col(c)).alias(c) for c in dim.columns], "_g._gap")


def effective_pieces(dim: DataFrame, keys: Sequence[str], start: str, end: str, span: tuple[datetime, datetime],
                     bucket_days: int) -> DataFrame:
    """A timeline ready to be joined: its versions and its gaps, by time bucket. To be stored where many joins use it."""
    return sliced(with_gaps(dim, keys, start, end), start, end, span, bucket_days)


def range_join_effective(fact: DataFrame, dim: DataFrame, keys: Sequence[str], ts: str, start: str, end: str, *,
                         span: tuple[datetime, datetime] | None = None, bucket_days: int = 90,
                         broadcast: bool = True, pieces: DataFrame | None = None) -> DataFrame:
    """Attributes in force at `ts`, under the price-timeline rule:

    a line whose key has no timeline at all stays with null attributes, a line whose key has one but none of
    its ranges covers `ts` is dropped. The times a timeline leaves open are pieces of their own, so one join tells the
    two apart. `span` says where most of the fact's `ts` lie; without it one pass over the fact finds out.

    The timeline's pieces are stored first, or given as `pieces` of the same span and buckets, so that they are made
    once and Spark knows their size: it sends them to every task only where their files are below its threshold.
    """
    clash = (set(dim.columns) - set(keys)) & set(fact.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    always = F.col(f"_d_{start}").isNull() | ((F.col("_d__gap") == 2) & F.col(ts).isNull())
    span = _span_of(fact, ts, span)
    if pieces is None:
        # dealt before what only orders it is made, which is not sent
        pieces = effective_pieces(dim.repartition(*keys), keys, start, end, span, bucket_days)
        pieces = written(pieces) if broadcast else pieces.hint("merge")
    joined = _covering(fact, pieces, keys, ts, start, end, span, bucket_days, always)
    return joined.where("_d__gap is null").selectExpr(*fact.columns, *[f"_d_{c} as {c}" for c in dim.columns if c not in keys])


def as_of_join(left: DataFrame, dim: DataFrame, keys: Sequence[str], ts: str, *,
               span: tuple[datetime, datetime] | None = None, bucket_days: int = 365,
               broadcast: bool = True) -> DataFrame:
    """Point-in-time left join on a versioned dimension: every left row stays, version columns do not come along."""
    attributes = [c for c in dim.columns if c not in keys and c not in VERSION_COLUMNS]
    clash = set(attributes) & set(left.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    versions = dim.select(*keys, *attributes, "valid_from", "valid_to")
    span = _span_of(left, ts, span)
    pieces = broadcast_if_small(sliced(versions, "valid_from", "valid_to", span, bucket_days), broadcast, otherwise="merge")
    joined = _covering(left, pieces, keys, ts, "valid_from", "valid_to", span, bucket_days, F.lit(False))
    return joined.selectExpr(*left.columns, *[f"_d_{c} as {c}" for c in attributes])


def timeline_overlaps(dim: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Keys whose ranges overlap: each would multiply fact lines in a range join."""
    earlier = Window.partitionBy(*keys).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    return (dim.withColumn("_seen", F.max(end).over(earlier))
            .where(F.col(start) < F.col("_seen"))
            .select(*keys).distinct())
