"""Removal of line chunks that repeat anywhere in the corpus.

Chunks end where a rolling hash over the hashes of neighbouring lines is least among its neighbours. Such a place
depends on four lines around it and on nothing else, so an insertion shifts no boundary but those beside it, and no
two boundaries are adjacent: a chunk has two lines at least, but for the last one of a text. Repeats are found by
hash; the bytes of the candidates decide.

`dedup_passages` removes what chunks miss as well: every two neighbouring lines, and every long line alone, that stand
earlier in the corpus are found in the same way, and runs of them with enough words go, wherever chunks end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.common import free_name, stored, word_count

MIN_LINES = 2
PASSAGE_WORDS = 50     # a run of repeated lines with more words than this goes, wherever chunks end


def _chunked(docs: DataFrame) -> DataFrame:
    """Replace `body` by its chunks: array of (line, n_lines, chunk), `line` being the first line's number from 0.

    Every array that a later step looks up by place is a column of its own that is named more than once there, so Spark
    makes it once per text and does not write it out inside the step.
    """
    lines, hashes, rolling, starts = (F.col(c) for c in ("lines", "hashes", "rolling", "starts"))
    length = lambda s, k: F.coalesce(F.get(starts, k + 1), F.size(lines)) - s
    steps = {
        "lines": F.split(F.coalesce(F.col("body"), F.lit("")), "\n"),
        "hashes": F.transform(lines, lambda line: F.md5(line)),
        "rolling": F.transform(hashes, lambda h, i: F.md5(F.concat(F.coalesce(F.get(hashes, i - 1), F.lit("")), h))),
        # a line begins a chunk if the rolling hash of the line before is below the one before that and not above its own
        "starts": F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: (i == 0) | (
            (F.get(rolling, i - 1) < F.get(rolling, i - 2)) & (F.get(rolling, i - 1) <= F.get(rolling, i)))),
        "chunks": F.transform(starts, lambda s, k: F.struct(
            s.alias("line"), length(s, k).alias("n_lines"),
            F.array_join(F.slice(lines, s + 1, length(s, k)), "\n").alias("chunk"))),
    }
    for name, column in steps.items():
        docs = docs.withColumn(name, column)
    return docs.drop("body", *[name for name in steps if name != "chunks"])


def _multi_line(docs: DataFrame) -> DataFrame:
    """The chunks that can be removed: several lines, one of them with a word."""
    # the outer form: for the plain one Spark infers a filter on the array, and pushes it below the steps written out
    return (_chunked(docs).select("id", "key", F.posexplode_outer("chunks").alias("nth", "c"))
            .where((F.col("c.n_lines") >= MIN_LINES) & F.regexp_like("c.chunk", F.lit(r"[^\x20\x09-\x0D]")))
            .select("id", "key", "nth", F.col("c.chunk").alias("chunk"), F.xxhash64("c.chunk").alias("hash")))


def _gone_chunks(row: DataFrame) -> DataFrame:
    """(id, key, body) to (g_id, g_key, gone): numbers of the chunks that repeat an earlier one."""
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "key", "nth")
    # narrow: hashes and places; repeats are summed up where they lie, so a chunk in every document is no hot group
    repeated = stored(_multi_line(row).select("hash", place.alias("place")).groupBy("hash")
                      .agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first")).where("n > 1")
                      .select(F.col("hash").alias("r_hash"), "first"), "lines-repeated")
    # merge: both joins move the texts at any size, in place of a broadcast that a larger corpus could not have
    found = stored(_multi_line(row).join(repeated.hint("merge"), F.col("hash") == F.col("r_hash"))
                   .select("id", "key", "nth", "chunk", "hash", (place == F.col("first")).alias("is_first")),
                   "lines-found")
    # rows given twice have their first chunk twice
    first = found.where("is_first").select(F.col("hash").alias("f_hash"), F.col("chunk").alias("f_chunk")).distinct()
    equal = (F.col("hash") == F.col("f_hash")) & (F.col("chunk") == F.col("f_chunk"))
    gone = (found.where("not is_first").join(stored(first, "lines-first"), equal)
            .groupBy("id", "key").agg(F.collect_set("nth").alias("gone"))
            .select(F.col("id").alias("g_id"), F.col("key").alias("g_key"), "gone"))
    return stored(gone, "lines-gone")


def dedup_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of `docs`, `text` without repeated chunks, and a struct `removed` (chunks, lines, spans).

    Of equal multi-line chunks the one in the smallest (doc_id, text hash, place) stays, null ids last; the others go
    with their line ends. `removed.spans` lists first line and number of lines, counted in the old text. Single-line
    chunks and chunks of blank lines stay. Null texts stay null; a text that repeats others throughout becomes
    empty. Rows equal in id and text are one document given twice: each keeps what the other keeps. An empty table
    gives no rows. If the input has a column `removed`, the new one gets underscores in front.
    """
    row = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("key"), F.col(text).alias("body"))
    gone = _gone_chunks(row)
    whole = F.struct(*[F.col(c) for c in docs.columns]).alias("whole")
    out = docs.select(whole, F.col(doc_id).alias("id"), F.xxhash64(text).alias("key"))
    out = out.join(gone.hint("merge"), F.col("id").eqNullSafe(F.col("g_id")) & (F.col("key") == F.col("g_key")), "left")
    # only texts that lose something are cut again
    out = _chunked(out.withColumn("body", F.when(F.col("gone").isNotNull(), F.col("whole").getField(text))))
    cut = F.col("gone").isNotNull()
    chunks = F.col("chunks")
    spans = F.transform(F.sort_array("gone"), lambda k: F.struct(
        F.get(chunks, k).line.alias("line"), F.get(chunks, k).n_lines.alias("n_lines")))
    none = F.array().cast("array<struct<line:int,n_lines:int>>")
    out = out.withColumn("spans", F.when(cut, spans).otherwise(none))
    stays = F.array_except(F.sequence(F.lit(0), F.size(chunks) - 1), F.col("gone"))
    kept = F.transform(stays, lambda k: F.get(chunks, k).chunk)
    left = F.when(cut, F.array_join(kept, "\n")).otherwise(F.col("whole").getField(text))
    removed = F.struct(F.size("spans").alias("chunks"), F.aggregate(
        "spans", F.lit(0), lambda a, s: a + s.n_lines).alias("lines"), "spans")
    return out.select(*[left.alias(c) if c == text else F.col("whole").getField(c).alias(c) for c in docs.columns],
                      removed.alias(free_name("removed", docs.columns)))


def _with_full(docs: DataFrame) -> DataFrame:
    """Add `lines` of `body`, and `full`: its lines with a word as (line, at)."""
    docs = docs.withColumn("lines", F.split(F.coalesce(F.col("body"), F.lit("")), "\n"))
    return docs.withColumn("full", F.filter(F.transform("lines", lambda x, i: F.struct(x.alias("line"), i.alias("at"))),
                                            lambda x: F.regexp_like(x.line, F.lit(r"[^\x20\x09-\x0D]"))))


def _units(row: DataFrame) -> DataFrame:
    """(id, key, k, n, hash): every two neighbouring lines with words, and every line of many words; k counts from 0.

    Blank lines do not part neighbours.
    """
    full, size = F.col("full"), F.size("full")
    # the second lines are a column of their own: looked up in the step they would be cut out again for every line
    cut = _with_full(row).withColumn("after", F.slice(full, 2, F.greatest(size - 1, F.lit(0))))
    pairs = F.zip_with(full, "after", lambda a, b: F.struct(
        F.lit(2).alias("n"), F.when(b.isNotNull(), F.xxhash64(a.line, F.lit("\n"), b.line)).alias("hash")))
    # fewer characters cannot hold so many words
    alone = F.transform(full, lambda a: F.struct(F.lit(1).alias("n"), F.when(
        (F.length(a.line) > 2 * PASSAGE_WORDS) & (word_count(a.line) > PASSAGE_WORDS), F.xxhash64(a.line)).alias("hash")))
    found = cut.select("id", "key", F.posexplode_outer(F.arrays_zip(pairs.alias("pair"), alone.alias("one"))).alias("k", "u"))
    return (found.select("id", "key", "k", F.explode(F.array("u.pair", "u.one")).alias("u"))
            .where("u.hash is not null").select("id", "key", "k", "u.n", "u.hash"))


def _gone_runs(row: DataFrame) -> DataFrame:
    """(id, key, body) to (r_id, r_key, runs): maximal runs (a, b) of lines with words that stand earlier too.

    A line is in a run if it and a neighbour, or it alone if it is long, stand at an earlier (id, key, place) as well.
    """
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "key", "k")
    units = _units(row)
    repeated = stored(units.select("hash", place.alias("place")).groupBy("hash")
                      .agg(F.count(F.lit(1)).alias("n_all"), F.min("place").alias("first")).where("n_all > 1")
                      .select(F.col("hash").alias("r_hash"), "first"), "passages-repeated")
    # narrow: no text moves until it is known which places are candidates
    places = (units.join(repeated.hint("merge"), F.col("hash") == F.col("r_hash"))
              .select("id", "key", F.struct("k", "n", "hash", (place == F.col("first")).alias("is_first")).alias("u"))
              .groupBy("id", "key").agg(F.collect_set("u").alias("units"))
              .select(F.col("id").alias("u_id"), F.col("key").alias("u_key"), "units"))
    own = F.col("id").eqNullSafe(F.col("u_id")) & (F.col("key") == F.col("u_key"))
    held = _with_full(row.join(stored(places, "passages-places").hint("merge"), own))
    full = F.col("full")
    held = held.select("id", "key", F.explode(F.transform("units", lambda u: F.struct(
        u.k.alias("k"), u.n.alias("n"), u.hash.alias("hash"), u.is_first.alias("is_first"),
        F.when(u.n == 1, F.get(full, u.k).line).otherwise(F.concat(
            F.get(full, u.k).line, F.lit("\n"), F.get(full, u.k + 1).line)).alias("unit")))).alias("u"))
    found = stored(held.select("id", "key", "u.*"), "passages-found")
    first = found.where("is_first").select(F.col("hash").alias("f_hash"), F.col("unit").alias("f_unit")).distinct()
    same = (F.col("hash") == F.col("f_hash")) & (F.col("unit") == F.col("f_unit"))
    lines = (found.where("not is_first").join(stored(first, "passages-first"), same)
             .select("id", "key", F.explode(F.sequence("k", F.col("k") + F.col("n") - 1)).alias("k"))
             .groupBy("id", "key").agg(F.sort_array(F.collect_set("k")).alias("ks"))
             .select(F.col("id").alias("r_id"), F.col("key").alias("r_key"), "ks"))
    lines = stored(lines, "passages-lines")
    return lines.select("r_id", "r_key", _runs(F.col("ks")).alias("runs"))


def _runs(numbers: Column) -> Column:
    """Sorted distinct numbers of a stored column as the runs (a, b) of neighbours among them."""
    begin = F.filter(numbers, lambda k, i: (i == 0) | (F.get(numbers, i - 1) != k - 1))
    end = F.filter(numbers, lambda k, i: F.coalesce(F.get(numbers, i + 1) != k + 1, F.lit(True)))
    return F.zip_with(begin, end, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def dedup_passages(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """What `dedup_lines` gives, less every run of over PASSAGE_WORDS words of lines that stand earlier too.

    Such a run is found wherever it begins and ends, as one long line or as several. The first copy of every line
    stays. Blank lines inside a run go with it. Nulls, rows given twice, empty tables and a column `removed` are
    treated as by `dedup_lines`; `removed` is (lines, spans), spans listing first line and number of lines.
    """
    key = F.xxhash64(text)
    row = docs.select(F.col(doc_id).alias("id"), key.alias("key"), F.col(text).alias("body"))
    chunks_gone, runs = _gone_chunks(row), _gone_runs(row)
    cuts = (chunks_gone.join(runs, F.col("g_id").eqNullSafe(F.col("r_id")) & (F.col("g_key") == F.col("r_key")), "full")
            .select(F.when(F.col("g_key").isNotNull(), F.col("g_id")).otherwise(F.col("r_id")).alias("c_id"),
                    F.coalesce("g_key", "r_key").alias("c_key"), "gone", "runs"))
    cuts = stored(cuts, "passages-cuts")
    whole = F.struct(*[F.col(c) for c in docs.columns]).alias("whole")
    out = docs.select(whole, F.col(doc_id).alias("id"), key.alias("key"))
    out = out.join(cuts.hint("merge"), F.col("id").eqNullSafe(F.col("c_id")) & (F.col("key") == F.col("c_key")), "left")
    # only texts that may lose something are cut again
    cut = F.col("c_key").isNotNull()
    body = F.when(cut, F.col("whole").getField(text))
    out = _chunked(out.withColumn("body", body)).withColumn("body", body)
    out = _with_full(out)
    chunks, full, lines, numbers = (F.col(c) for c in ("chunks", "full", "lines", "numbers"))
    inside = lambda a, b: F.slice(lines, a + 1, b - a + 1)
    from_chunks = F.transform("gone", lambda k: F.sequence(
        F.get(chunks, k).line, F.get(chunks, k).line + F.get(chunks, k).n_lines - 1))
    ends = F.transform("runs", lambda r: F.struct(F.get(full, r.a).at.alias("a"), F.get(full, r.b).at.alias("b")))
    many = F.filter("ends", lambda r: word_count(F.array_join(inside(r.a, r.b), "\n")) > PASSAGE_WORDS)
    none = F.array().cast("array<array<int>>")
    out = out.withColumn("ends", ends).withColumn("many", F.transform(many, lambda r: F.sequence(r.a, r.b)))
    out = out.withColumn("numbers", F.sort_array(F.array_distinct(F.flatten(F.concat(
        F.coalesce(from_chunks, none), F.coalesce("many", none))))))
    stays = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), numbers)
    kept = F.array_join(F.transform(stays, lambda i: F.get(lines, i)), "\n")
    left = F.when(F.size(numbers) > 0, kept).otherwise(F.col("whole").getField(text))
    spans = F.transform(_runs(numbers), lambda r: F.struct(r.a.alias("line"), (r.b - r.a + 1).alias("n_lines")))
    removed = F.struct(F.size(numbers).alias("lines"), spans.alias("spans"))
    return out.select(*[left.alias(c) if c == text else F.col("whole").getField(c).alias(c) for c in docs.columns],
                      removed.alias(free_name("removed", docs.columns)))
