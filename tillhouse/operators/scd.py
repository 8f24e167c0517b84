"""Slowly changing dimensions with half-open validity [valid_from, valid_to)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.functions.calendar import ntz
from tillhouse.functions.contracts import END_OF_TIME, START_OF_TIME
from tillhouse.operators.joins import VERSION_COLUMNS


def is_versioned(df: DataFrame) -> bool:
    return set(VERSION_COLUMNS) <= set(df.columns)


def current_slice(dim: DataFrame) -> DataFrame:
    return dim.where("is_current").drop(*VERSION_COLUMNS)


def scd2_initial(incoming: DataFrame) -> DataFrame:
    """First load: every row is open since the start of time, so facts older than the dimension still match."""
    return incoming.withColumns({
        "valid_from": ntz(START_OF_TIME), "valid_to": ntz(END_OF_TIME), "is_current": F.lit(True),
    })


def scd2_apply(current: DataFrame, incoming: DataFrame, keys: Sequence[str], effective: str | date,
               tracked: Sequence[str] | None = None, strict: bool = False) -> DataFrame:
    """Next state of a dimension after one day's snapshot of its source.

    One full outer join of the open versions with the snapshot; each joined row yields the versions to keep:
    same -> the open one; changed -> the open one closed plus a new one; changed again on the same day -> the
    new one only; new key -> a new one; key gone -> the open one closed, or nothing if it was opened that day.
    Closed history passes through. A day older than the newest version changes nothing; `strict` also counts
    days that only closed versions.

    Columns may come and go. One that the state lacks is no change of a row: open versions get its value, closed ones
    null. One that the source no longer has stays, null in versions opened from then on, and is not compared.
    """
    given = [c for c in incoming.columns if c not in VERSION_COLUMNS]
    known = [c for c in current.columns if c not in VERSION_COLUMNS]
    added, gone = [c for c in given if c not in known], [c for c in known if c not in given]
    current = current.withColumns({c: F.lit(None).cast(incoming.schema[c].dataType) for c in added})
    incoming = incoming.withColumns({c: F.lit(None).cast(current.schema[c].dataType) for c in gone})
    business = given + gone
    tracked = [c for c in (tracked or business) if c not in keys and c not in added and c not in gone]
    eff = ntz(str(effective)[:10] + " 00:00:00")

    newest = F.max("valid_from")
    if strict:
        newest = F.greatest(newest, F.max(F.when(~F.col("is_current"), F.col("valid_to"))))
    # a scalar subquery of the same plan: no extra job, nothing on the driver
    newest = current.agg(newest).scalar()

    version = current.schema["valid_from"].dataType
    open_now = current.where("is_current").select(
        F.struct(*business).alias("_old"), F.col("valid_from").alias("_since"), *[F.col(k).alias(f"_k_{k}") for k in keys])
    snapshot = incoming.select(F.struct(*business).alias("_new"), *[F.col(k).alias(f"_n_{k}") for k in keys])
    same_key = reduce(lambda a, b: a & b, [F.col(f"_k_{k}") == F.col(f"_n_{k}") for k in keys])
    met = open_now.join(snapshot, same_key, "full")

    had, has = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    pairs = [F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in tracked]
    unchanged = had & has & reduce(lambda a, b: a & b, pairs, F.lit(True))
    skip = F.coalesce(eff < newest, F.lit(False))
    open_end = ntz(END_OF_TIME).cast(version)

    def row(source: str, since: Column, until: Column, is_open: bool, filled: Sequence[str] = ()) -> Column:
        return F.struct(*[F.col(f"{'_new' if c in filled else source}.{c}").alias(c) for c in business], since.cast(version).alias("valid_from"),
                        until.cast(version).alias("valid_to"), F.lit(is_open).alias("is_current"))

    stays = row("_old", F.col("_since"), open_end, True)
    closed = row("_old", F.col("_since"), eff, False)
    opened = row("_new", eff, open_end, True)
    closes = had & (F.col("_since") < eff)
    result = (F.when(skip, F.when(had, F.array(stays)).otherwise(F.array()))
              .when(unchanged, F.array(row("_old", F.col("_since"), open_end, True, added)))
              .otherwise(F.concat(F.when(closes, F.array(closed)).otherwise(F.array()),
                                  F.when(has, F.array(opened)).otherwise(F.array()))))
    next_open = met.select(F.explode(result).alias("_v")).select("_v.*")
    history = current.where(~F.col("is_current")).select(*next_open.columns)
    return history.unionByName(next_open)


def scd2_from_snapshots(snapshots: DataFrame, keys: Sequence[str], day: str,
                        tracked: Sequence[str] | None = None) -> DataFrame:
    """The state scd2_apply reaches after all daily snapshots, in one pass over them instead of one run per day."""
    business = [c for c in snapshots.columns if c != day]
    tracked = [c for c in (tracked or business) if c not in keys]
    # the distinct days are few; each knows the one before and after it
    order = Window.orderBy("_day")
    days = (snapshots.select(F.col(day).alias("_day")).distinct()
            .withColumn("_previous", F.lag("_day").over(order))
            .withColumn("_following", F.lead("_day").over(order)))
    per_key = Window.partitionBy(*keys).orderBy("_day")
    rows = (snapshots.withColumnRenamed(day, "_day").join(F.broadcast(days), "_day")
            .withColumn("_now", F.struct(*tracked))
            .withColumn("_seen", F.lag("_day").over(per_key))
            .withColumn("_was", F.lag("_now").over(per_key))
            .withColumn("_next_seen", F.lead("_day").over(per_key)))
    continues = F.col("_seen").isNotNull() & F.col("_seen").eqNullSafe(F.col("_previous"))
    starts = ~(continues & F.col("_now").eqNullSafe(F.col("_was")))
    vanishes = F.col("_following").isNotNull() & ~F.col("_next_seen").eqNullSafe(F.col("_following"))
    upto = per_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = (rows.withColumn("_starts", starts).withColumn("_gone_at", F.when(vanishes, F.col("_following")))
            .withColumn("_run", F.sum(F.col("_starts").cast("int")).over(upto)))
    # a version: its first day, the values it opened with, and the day its key vanished
    first_values = [F.min_by(c, "_day").alias(c) for c in business if c not in keys]
    versions = (runs.groupBy(*keys, "_run")
                .agg(*first_values, F.min("_day").alias("_from"), F.max("_gone_at").alias("_gone"),
                     F.max(F.col("_previous").isNull()).alias("_bootstrap")))
    by_run = Window.partitionBy(*keys).orderBy("_run")
    end = F.least(F.col("_gone"), F.lead("_from").over(by_run))
    since = F.when(F.col("_bootstrap"), ntz(START_OF_TIME)).otherwise(F.col("_from").cast("timestamp_ntz"))
    return (versions.withColumn("_end", end)
            .select(*business, since.alias("valid_from"),
                    F.coalesce(F.col("_end").cast("timestamp_ntz"), ntz(END_OF_TIME)).alias("valid_to"),
                    F.col("_end").isNull().alias("is_current")))
