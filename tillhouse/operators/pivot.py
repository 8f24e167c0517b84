"""Event rows to one time column per status."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def status_times(events: DataFrame, key: str, status: str, moment: str, names: Mapping[int, str]) -> DataFrame:
    """Latest moment per key and status. A status that never occurs is a typed null column.

    One conditional max per listed status: a single partial aggregate, no pass to discover the values.
    """
    return events.groupBy(key).agg(*[
        F.max(F.when(F.col(status) == code, F.col(moment))).alias(name) for code, name in names.items()
    ])
