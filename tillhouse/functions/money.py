"""Order-independent money sums and safe ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(28,6)"


def exact_sum(amount: Column) -> Column:
    """Sum in decimals, hand back a double: reruns give the same bits whatever the task order."""
    return F.sum(amount.cast(EXACT)).cast("double")


def ratio(part: Column, whole: Column) -> Column:
    """Null when the denominator is zero or missing."""
    return F.try_divide(part.cast("double"), whole.cast("double"))
