"""Sharding indivisible groups by best-fit-decreasing bin packing.

A group is all documents of one text. Groups are sorted by size and each enters the open shard whose remaining
capacity is the least that still holds it, found in a balanced tree. With a fixed capacity the fewest shards are
opened; with a fixed number of shards the least capacity that needs no more is searched.

The packing itself is one driver pass: groups above a fixed share of all bytes one by one, at most 1 / LARGE of them,
and the others in BUNDLES bundles by text hash. So for a number of shards the list has the same length at any scale, and
a bundle is as small a part of a shard at any scale. With a capacity, groups above a share of it are packed one by one
too, and bundles are made as many as keep them about such a share; one that comes out larger gives up its groups to be
packed one by one. So no bundle is larger than that share, and the list grows with the number of shards.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.llm.common import numbered, stored

LARGE = 1 / 16_384    # of all bytes: such groups are packed one by one
BUNDLES = 16_384
PART = 1 / 64         # of a given capacity: no bundle is larger
SHARDS = 8
LAW = "bytes"


def best_fit_decreasing(sizes: Sequence[int], capacity: int, most: int | None = None) -> list[int] | None:
    """Bin of each item, items given in falling size; None once more than `most` bins are needed.

    Open bins are kept sorted by remaining capacity, so the tightest one that fits is one search away. An item above
    the capacity has a bin of its own.
    """
    open_bins: list[tuple[int, int]] = []  # (remaining, bin), sorted
    bins, out = 0, []
    for size in sizes:
        at = bisect_left(open_bins, (size, -1))
        if at == len(open_bins):
            if bins == most:
                return None
            remaining, number = max(capacity, size), bins
            bins += 1
        else:
            remaining, number = open_bins.pop(at)
        insort(open_bins, (remaining - size, number))
        out.append(number)
    return out


def least_capacity(sizes: Sequence[int], bins: int) -> tuple[int, list[int]]:
    """Least capacity found by bisection with which best fit decreasing needs no more than `bins`, and its packing."""
    low, high = max([1, *sizes[:1], -(-sum(sizes) // bins)]), max(1, sum(sizes))
    best = best_fit_decreasing(sizes, high, bins)
    while low < high:
        middle = (low + high) // 2
        packed = best_fit_decreasing(sizes, middle, bins)
        if packed is None:
            low = middle + 1
        else:
            high, best = middle, packed
    return high, best or []


def shard(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shards: int | None = SHARDS,
          capacity: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: one row per row.

    Either a number of shards or a capacity in bytes is given. Size is the text's UTF-8 bytes plus one; null texts
    count as empty and form one group with the empty ones. Null ids and repeated rows are rows like any other; an
    empty table gives no rows. A group above the capacity has a shard of its own. The law is `bytes`, so
    grown_shard is null. Other columns are ignored.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    slim = docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
                       F.crc32(body.cast("binary")).alias("text_crc32"), F.xxhash64(body).alias("grp"))
    slim = stored(slim, "shard-docs")
    groups = stored(slim.groupBy("grp").agg(F.sum("size").alias("bytes")), "shard-groups")
    total = groups.agg(F.sum("bytes").alias("b")).first()["b"] or 0
    limit = max(1, total * LARGE)
    n_bundles = BUNDLES
    if capacity:
        limit = min(limit, max(1, capacity * PART))
        # half full on average, so that few exceed the share
        n_bundles = max(BUNDLES, -(-2 * total // max(1, int(capacity * PART))))
    in_bundle = F.pmod("grp", F.lit(n_bundles))
    large = F.col("bytes") > limit
    if capacity:
        heavy = (groups.where(~large).groupBy(in_bundle.alias("h_item")).agg(F.sum("bytes").alias("h_bytes"))
                 .where(F.col("h_bytes") > max(1, capacity * PART)).select("h_item"))
        groups = groups.join(stored(heavy, "shard-heavy"), in_bundle == F.col("h_item"), "left")
        large = large | F.col("h_item").isNotNull()
    # two texts of one hash stay together, which no law forbids
    bundle = F.when(large, F.col("grp")).otherwise(in_bundle)
    items = (groups.groupBy(large.alias("large"), bundle.alias("item")).agg(F.sum("bytes").alias("bytes")).collect())
    items.sort(key=lambda r: (-r["bytes"], r["large"], r["item"]))
    sizes = [r["bytes"] for r in items]
    packed = best_fit_decreasing(sizes, capacity) if capacity else least_capacity(sizes, shards)[1]
    schema = T.StructType([T.StructField("p_large", T.BooleanType(), False), T.StructField("p_item", T.LongType(), False),
                           T.StructField("shard", T.IntegerType(), False)])
    plan = docs.sparkSession.createDataFrame([(r["large"], r["item"], s) for r, s in zip(items, packed, strict=True)], schema)
    plan = stored(plan.coalesce(1), "shard-plan")
    whole = plan.where("p_large").select(F.col("p_item").alias("w_item"), F.col("shard").alias("w_shard"))
    bundles = plan.where("not p_large").select("p_item", F.col("shard").alias("b_shard"))
    placed = (slim.join(whole, F.col("grp") == F.col("w_item"), "left")
              .join(bundles, in_bundle == F.col("p_item"), "left")
              .select("doc_id", "size", "text_crc32", F.coalesce("w_shard", "b_shard").alias("shard")))
    return numbered(stored(placed, "shard-placed"), ["shard"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
