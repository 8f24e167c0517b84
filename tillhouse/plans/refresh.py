"""Refreshing a mart behind a fact: only slices whose fact rows changed are built again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.sources.sinks import SnapshotTable, empty, write_slices

STATE = "slice string, files decimal(38,0), rows long, content decimal(38,0)"


def _sum_of_hashes(*columns: str) -> Column:
    """Free of order, and two equal rows do not cancel out."""
    return F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))


def refresh_mart(fact: DataFrame, path: str, column: str, build: Callable[[DataFrame], DataFrame]) -> set[str]:
    """Bring a sliced mart up to a sliced fact; returns the slices that were built again.

    Beside the mart lies, for each slice, what it was built from: the files by name and size, and the rows by number and
    an order-free hash. Slices with other files than then are hashed, and those with other rows are built and written;
    the rest is neither read nor touched. A slice that is gone from the fact goes from the mart. The record is replaced
    last, so a refresh that dies is done again. `build` must make a slice of the mart from that slice of the fact.
    """
    spark = fact.sparkSession
    record = SnapshotTable(spark, f"{path}_built_from")
    before = record.read()
    if before is None:
        before = empty(spark, STATE)
    name = F.col(column).cast("string")
    files = (fact.select(name.alias("slice"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("size"))
             .distinct().groupBy("slice").agg(_sum_of_hashes("file", "size").alias("now")))
    moved = (before.select("slice", "files").join(files, "slice", "full")
             .where(~F.col("files").eqNullSafe(F.col("now"))))
    suspects = {r["slice"]: r["now"] is not None for r in moved.collect()}  # slices, not rows
    there = sorted(s for s, found in suspects.items() if found)
    hashed = (fact.where(name.isin(there)).groupBy(name.alias("slice"))
              .agg(F.count(F.lit(1)).alias("rows"), _sum_of_hashes(*fact.columns).alias("content")))
    state = files.where(F.col("slice").isin(there)).join(hashed, "slice").selectExpr("slice", "now as files", "rows", "content")
    after = before.where(~F.col("slice").isin(list(suspects))).unionByName(state)
    same = before.join(state.select("slice", "rows", "content"), ["slice", "rows", "content"], "left_semi")
    touched = set(suspects) - {r["slice"] for r in same.select("slice").collect()}
    if touched:
        write_slices(build(fact.where(name.isin(sorted(touched)))), path, column, touched)
    if suspects:
        record.replace(after)
    return touched
