"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed 128-bit hash, 32 hex digits. A source whose target is k whole passes and a rest takes each
of its documents k times, and once more those whose hash is at most the source's threshold. The threshold is found
without sorting: word sums by source and the first digits of the hash, a running sum over those bins, and then the
next digits of the one bin in which the rest runs out. Bins of smaller budgets lie inside those of larger ones, so
mixes are nested: raising a budget only adds documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.llm.common import stored, word_count

DIGITS = 3           # hex digits per level: 4,096 bins a source at most
LEVELS = 5           # 15 of 32 digits; documents equal in those are taken together
PASSES = 2           # a document is used twice at most
WEIGHTS = (5, 2, 1)
SHARE = 1.5


def document_hash(doc_id: Column, text: Column) -> Column:
    """Depends on id and text alone; rows equal in both are taken or left together."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"),
                          F.md5(F.coalesce(text, F.lit("")))))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                   passes: int = PASSES) -> DataFrame:
    """(source, source_size) to (source, source_size, target): one row per source, so a single small sort.

    Sources by code point, null last, take the weights in turn. `share` of all words is dealt by weight; a target
    stops at `passes` times its source, and the excess is dealt again until none is above. That fixed point has
    one level: sorted by the words per weight at which a source is full, the first sources are full, the others get
    weight times level.
    """
    n = len(weights)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % n
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (turn + 1).cast("int")).cast("long")
    t = sizes.withColumn("weight", weight).withColumn("full", (F.lit(passes) * F.col("source_size")).cast("long"))
    fill = Window.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last())
    upto = fill.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    budget = F.least(F.lit(float(share)), F.lit(float(passes))) * F.sum("source_size").over(everything)
    t = (t.withColumn("level", (budget - (F.sum("full").over(upto) - F.col("full")))
                      / (F.sum("weight").over(everything) - (F.sum("weight").over(upto) - F.col("weight"))))
         # the first source that is not full sets the level; if every one is, none is needed
         .withColumn("open", F.col("level") * F.col("weight") < F.col("full"))
         .withColumn("level", F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(
             fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    target = F.coalesce(F.least(F.col("full").cast("double"), F.col("level") * F.col("weight")),
                        F.col("full").cast("double"))
    return t.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[int] = WEIGHTS, share: float = SHARE, passes: int = PASSES,
        carry: Sequence[str] = ()) -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target, copies, taken, and the carried columns.

    Null or blank texts have size 0 and are used as often as their hash says, which takes no words. Null ids, null
    sources (a source of their own) and repeated rows are ordinary; rows equal in id and text stand or fall
    together. An empty table gives an empty result. Other columns are ignored unless carried, and then come back
    under their own names.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), word_count(F.col(text)).alias("size"),
                       F.col(source).alias("source"), document_hash(F.col(doc_id), F.col(text)).alias("h"),
                       *([F.struct(*carry).alias("carried")] if carry else []))
    slim = stored(slim, "mix-docs")
    targets = source_targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, passes)
    targets = stored(targets, "mix-targets").withColumn("passes", F.floor(
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)))
    rest = F.col("target") - F.col("passes") * F.col("source_size")

    # where the search stands: the digits fixed so far, and the words still wanted among hashes that begin so
    state = targets.select(F.col("source").alias("s"), F.lit("").alias("prefix"), rest.alias("wanted"))
    for level in range(LEVELS):
        known, more = level * DIGITS, (level + 1) * DIGITS
        inside = (F.col("source").eqNullSafe(F.col("s"))) & (F.substring("h", 1, known) == F.col("prefix"))
        rows = slim.select("source", "h", "size")
        rows = rows.join(state.select("s", "prefix"), inside) if level else rows
        bins = rows.groupBy("source", F.substring("h", 1, more).alias("bin")).agg(F.sum("size").alias("words"))
        below = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        last = level == LEVELS - 1
        found = (bins.withColumn("below", F.coalesce(F.sum("words").over(below), F.lit(0)))
                 .join(state, F.col("source").eqNullSafe(F.col("s")))
                 # the last level takes its boundary bin whole if that ends nearer to the target
                 .where(F.col("below") + (F.col("words") / 2 if last else F.lit(0)) <= F.col("wanted"))
                 .groupBy("s").agg(F.max(F.struct("bin", "below")).alias("m"))
                 .select(F.col("s").alias("f"), "m"))
        # without a bin the shorter prefix stays: it is greater than every hash below it, less than those in it
        state = stored(state.join(found, F.col("s").eqNullSafe(F.col("f")), "left")
                       .select("s", F.coalesce("m.bin", "prefix").alias("prefix"),
                               (F.col("wanted") - F.coalesce("m.below", F.lit(0))).alias("wanted")), f"mix-level{level}")
    limits = state.select("s", F.col("prefix").alias("threshold"))
    plan = stored(targets.join(limits, F.col("source").eqNullSafe(F.col("s")), "left")
                  .select(F.col("source").alias("s"), "source_size", "target", "passes", "threshold"), "mix-plan")
    under = F.coalesce(F.substring("h", 1, LEVELS * DIGITS) <= F.col("threshold"), F.lit(False))
    copies = F.least(F.col("passes") + F.when(under, 1).otherwise(0), F.lit(passes)).cast("int")
    return (slim.join(plan, F.col("source").eqNullSafe(F.col("s")))
            .select("doc_id", "size", "source", "source_size", "target", copies.alias("copies"),
                    (copies * F.col("size")).cast("long").alias("taken"),
                    *([F.col("carried")] if carry else [])))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is used."""
    out = mix(docs, carry=docs.columns, **options).where("copies > 0")
    return (out.select("carried", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
            .select(*[F.col("carried").getField(c).alias(c) for c in docs.columns]))
