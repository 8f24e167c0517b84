"""Threshold-scaled document sketches.

A sketch keeps every five-word shingle whose 64-bit hash is below a fixed fraction of the range. The threshold is the
same for all texts, so sketches of parts merge by union, and the shared part of two sketches estimates the shared part
of two texts however unequal their lengths are. A text of a few words may have no hash below the threshold; its sketch
is its least hash, above the threshold and thereby marked: it is looked for among all shingles of the other text, and
gives way when sketches merge. Only a text without words has an empty sketch. Everything is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.llm.common import stored, words_of

WORDS = 5
FRACTION = 8          # one hash in this many is kept
LIMIT = (1 << 63) // FRACTION - 1
DIGITS = 16           # hex digits of a hash in the text form


def with_hashes(docs: DataFrame, text: str, name: str) -> DataFrame:
    """Add the array `name` of all shingle hashes of a text column, in order; none for a text without words."""
    words = F.col(f"{name}_words")
    # hashes as non-negative longs: the top bit is dropped
    value = lambda *parts: F.shiftrightunsigned(F.xxhash64(*parts), 1)
    shingles = F.transform(F.slice(words, WORDS, F.greatest(F.size(words) - WORDS + 1, F.lit(0))), lambda last, i: value(
        *[F.get(words, i + k) for k in range(WORDS - 1)], last))
    short = F.when(F.size(words) > 0, F.array(value(words))).otherwise(F.array().cast("array<bigint>"))
    return (docs.withColumn(f"{name}_words", words_of(F.col(text)))
            .withColumn(name, F.when(F.size(words) >= WORDS, shingles).otherwise(short)).drop(f"{name}_words"))


def with_sketch(docs: DataFrame, hashes: str, name: str) -> DataFrame:
    """Add the sorted array `name` of the hashes at or below the limit; where there are none, the least one, as a mark."""
    last = F.col(f"{name}_last")
    docs = docs.withColumn(f"{name}_last", F.greatest(F.array_min(hashes), F.lit(LIMIT)))
    # named twice: a column that is named once would be written out inside the filter, and run for every hash
    kept = F.when(last >= 0, F.sort_array(F.array_distinct(F.filter(hashes, lambda h: h <= last))))
    return docs.withColumn(name, F.coalesce(kept, F.array().cast("array<bigint>"))).drop(f"{name}_last")


def mark_of(sketch: Column) -> Column:
    """The one hash of a sketch that has none below the limit, else null."""
    return F.when(F.get(sketch, F.lit(0)) > LIMIT, F.get(sketch, F.lit(0)))


def as_text(sketch: Column) -> Column:
    """Hex form: DIGITS digits a hash, in order."""
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.lpad(F.hex(h), DIGITS, "0"))), "")


def likeness(a: Column, b: Column, a_in_b: Column | None = None, b_in_a: Column | None = None) -> Column:
    """Share of the smaller sketch that the other has; 1 for two empty ones, 0 for one.

    A mark is no sample of the shingles below the limit. Whether the other text holds it, among all its shingles, is
    the estimate then: a_in_b for a's mark, b_in_a for b's. Left out, only the other's sketch is looked at.
    """
    a_in_b = F.array_contains(b, mark_of(a)) if a_in_b is None else a_in_b
    b_in_a = F.array_contains(a, mark_of(b)) if b_in_a is None else b_in_a
    smaller = F.least(F.size(a), F.size(b))
    held = F.coalesce(a_in_b, F.lit(False)) | F.coalesce(b_in_a, F.lit(False))
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when(smaller == 0, F.lit(0.0))
            .when(mark_of(a).isNotNull() | mark_of(b).isNotNull(), held.cast("double"))
            .otherwise(F.size(F.array_intersect(a, b)) / smaller))


def merge(a: Column, b: Column) -> Column:
    """Sketch of two parts together (shingles across the cut aside): marks give way to hashes, or to the lesser mark."""
    both = F.array_union(a, b)
    below = F.sort_array(F.filter(both, lambda h: h <= LIMIT))
    return F.when((F.size(below) > 0) | (F.size(both) == 0), below).otherwise(F.array(F.array_min(both)))


def following(ids: DataFrame, blocks: int) -> DataFrame:
    """Distinct ids (id, half, marks) to (id, half, marks, next_id) in descending order, cyclic, null last.

    Ids are dealt out in ranges; inside a range a window looks one row ahead, and the one row that ends each range
    takes the first of the range after it, so no window holds more than a range, or one row per range.
    """
    table = stored(ids.repartitionByRange(blocks, F.col("id").desc_nulls_last())
                   .select("id", "half", "marks", F.spark_partition_id().alias("part")), "follow-ranges")
    inside = Window.partitionBy("part").orderBy(F.col("id").desc_nulls_last())
    ahead = table.select("id", "half", "marks", "part", F.lead(F.struct("id")).over(inside).alias("ahead"),
                         F.row_number().over(inside).alias("nth"))
    ahead = stored(ahead, "follow-inside")
    order = Window.orderBy("part")
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = (ahead.where("nth = 1").select("part", F.struct("id").alias("first"))
              .select(F.col("part").alias("f_part"), F.coalesce(
                  F.lead("first").over(order), F.first("first").over(everything)).alias("after")))
    return (ahead.join(stored(firsts, "follow-firsts"), F.col("part") == F.col("f_part"))
            .select("id", "half", "marks", F.coalesce("ahead", "after").getField("id").alias("next_id")))


def fingerprint_documents(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next: one row per row.

    The edited text is the text with its last half replaced by the start of the next document's. The next document is
    the one with the next smaller doc_id, after the least (or null) id the greatest; where several rows have that
    id, the one with the greatest text. Rows of equal id have the same next document. Null texts count as empty;
    a table of one id is its own next. An empty table gives no rows. Other columns are ignored.
    """
    mine = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    mine = with_sketch(with_hashes(mine, "body", "hashes"), "hashes", "sketch").drop("hashes")
    half = lambda body: F.floor(F.length(body) / 2).cast("int")
    asks = mine.groupBy("id").agg(F.max(half("body")).alias("half"), F.collect_set(mark_of(F.col("sketch"))).alias("marks"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    follow = stored(following(asks, parts), "follow-ids")
    # a key that is never null lets plain equality do
    key = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    # Whole texts are dealt by id once. Both uses below take the whole struct, so that Spark sees one and the same
    # exchange: what one of them leaves out would be pruned before it, and make it another.
    dealt = mine.select(key("id").alias("key"), F.struct("body", "sketch", "id").alias("doc")).repartition("key")
    # of the next text travel its sketch, the longest start that a text of the asking id needs, and the marks it holds
    given = (dealt.groupBy("key").agg(F.max("doc").alias("doc"))
             .join(follow.select(key("id").alias("asker"), F.col("half").alias("most"), "marks",
                                 key("next_id").alias("next_key")), F.col("key") == F.col("next_key"))
             .withColumn("asked", F.when(F.size("marks") > 0, F.col("doc.body"))))
    given = (with_hashes(given, "asked", "asked_hashes")
             .select("asker", F.substring("doc.body", F.lit(1), F.col("most")).alias("next_body"),
                     F.col("doc.sketch").alias("next_sketch"), F.array_intersect("marks", "asked_hashes").alias("held")))
    both = (dealt.select("key", "doc.*").join(given, F.col("key") == F.col("asker"))
            .select("id", "body", F.length("body").cast("long").alias("n_chars"), "sketch", "next_sketch", "held", F.concat(
                F.substring("body", F.lit(1), F.length("body") - half("body")),
                F.substring("next_body", F.lit(1), half("body"))).alias("edited")))
    both = with_sketch(with_hashes(both, "edited", "edited_hashes"), "edited_hashes", "edited_sketch")
    # a text's own shingles are only needed against a mark
    marked = mark_of(F.col("next_sketch")).isNotNull() | mark_of(F.col("edited_sketch")).isNotNull()
    both = with_hashes(both.withColumn("own", F.when(marked, F.col("body"))), "own", "own_hashes")
    sketch, edited, after = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return both.select(
        F.col("id").alias("doc_id"), "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(sketch).alias("fingerprint"), as_text(edited).alias("edited_fingerprint"),
        likeness(sketch, edited, F.array_contains("edited_hashes", mark_of(sketch)),
                 F.array_contains("own_hashes", mark_of(edited))).alias("near_edited"),
        likeness(sketch, after, F.array_contains("held", mark_of(sketch)),
                 F.array_contains("own_hashes", mark_of(after))).alias("near_next"))
