"""Even shares of a table's keys, for work that is done share by share so that less of it lies on disk at once."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Share:
    """The keys whose hash leaves `index` when divided by `count`; null is a key like any other.

    Every row is in one share only, and all rows of a key are in the same one, so what is done within keys gives the same
    rows share by share. The hash is not the one by which Spark deals rows, which would then meet in few partitions.
    """

    index: int
    count: int

    def of(self, df: DataFrame, key: str) -> DataFrame:
        return df.where(share_no(key, self.count) == self.index)


def share_no(key: str, count: int) -> Column:
    """The index of the share that a key is in."""
    return F.pmod(F.xxhash64(key), F.lit(count))


def of_share(df: DataFrame, key: str, share: Share | None) -> DataFrame:
    """The share's rows, or all of them where there is none."""
    return df if share is None else share.of(df, key)


def shares(count: int) -> Iterator[Share]:
    return (Share(n, count) for n in range(count))
