"""Deterministic de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def total_order(df: DataFrame, first: Sequence[Column] = ()) -> list[Column]:
    """The wanted order, then every orderable column: reruns pick the same survivor."""
    plain = [f.name for f in df.schema.fields if not f.dataType.simpleString().startswith("map")]
    return [*first, *[F.col(c).asc_nulls_last() for c in plain]]


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """First row per key. Spark drops all but one row per key and task before the shuffle, so a hot key is cheap."""
    window = Window.partitionBy(*keys).orderBy(*total_order(df, order))
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()
