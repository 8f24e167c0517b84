"""SimHash fingerprints and their links within a few differing bits, compared bit-sliced.

Candidates: 64 bits in six blocks; fingerprints that differ in three bits agree on three blocks at least, so each goes
to twenty buckets, one per choice of three blocks, and no link is missed. Inside a bucket the fingerprints lie
vertically: plane p holds bit p of 64 fingerprints in one word. A fingerprint is compared with such a word at once:
xor with each plane, added up by carry-save counters whose overflow marks the lanes that exceed the radius; words
whose lanes all have are dropped after every few planes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.llm.common import free_name, stored
from tillhouse.llm.graph import components

BITS = 64
WORDS = 3
MAX_BITS = 3
SEED = 42
SPARE_BLOCKS = 3       # blocks beyond the radius: keys have this many blocks, about 32 bits
BLOCK_MEMBERS = 32_768  # a larger bucket is dealt in pairs of blocks of about this many
SAMPLE = 64            # buckets that large are found from one fingerprint in SAMPLE; this only decides the layout
COMPARED = 1 << 17     # words compared at once
LANES = np.arange(64, dtype=np.uint64)
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """SimHash of a UTF-8 text: XXH64 of every run of `words` lower-cased words, repeats counted."""
    import xxhash
    # bytes lower-case A-Z and split at the six ASCII white-space characters
    tokens = text.lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    stops = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = [0, *(stops[:-1] + 1).tolist()]
    stops = stops.tolist()
    n = max(1, len(tokens) - words + 1)
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, dtype=np.int64)
    for first in range(0, n, 65_536):
        part = range(first, min(n, first + 65_536))
        hashes = np.array([digest(joined[starts[i]:stops[min(i + words, len(tokens)) - 1]], SEED) for i in part],
                          dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str, name: str, words: int = WORDS) -> DataFrame:
    """All columns, and the fingerprint as a signed long. Nulls count as empty."""
    body = free_name("body", docs.columns)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(x.as_py() or b"", words) for x in batch.column(batch.num_columns - 1)],
                              dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(prints, pa.int64())],
                                             names=[*batch.schema.names[:-1], name])

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])
    return docs.withColumn(body, F.col(text).cast("string").cast("binary")).mapInArrow(add, schema)


def block_masks(max_bits: int) -> list[int]:
    """Masks of the bits in each choice of SPARE_BLOCKS blocks out of max_bits + SPARE_BLOCKS."""
    n = max_bits + SPARE_BLOCKS
    edges = [round(i * BITS / n) for i in range(n + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(kept) for kept in combinations(blocks, SPARE_BLOCKS)]


class _Sets:
    """Disjoint sets of row numbers; roots are the least members."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.parent[a], self.parent[b]
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.parent[self.parent]
                if np.array_equal(up, self.parent):
                    break
                self.parent = up


def bit_sliced_links(prints: np.ndarray, run: np.ndarray, side: np.ndarray, planes: Sequence[int],
                     max_bits: int) -> np.ndarray:
    """Root row of every row, over links within `max_bits` in `planes` between rows of one run.

    Rows are sorted by (run, side). A run with one side is compared with itself, one with two sides only across.
    """
    n = len(prints)
    sets = _Sets(n)
    if n < 2:
        return sets.parent
    fresh_run = np.r_[True, run[1:] != run[:-1]]
    fresh = fresh_run | np.r_[True, side[1:] != side[:-1]]
    group_of = np.cumsum(fresh) - 1
    group_start = np.flatnonzero(fresh)
    group_size = np.diff(np.r_[group_start, n])
    place = np.arange(n) - group_start[group_of]
    words_in = -(-group_size // 64)
    first_word = np.r_[0, np.cumsum(words_in)[:-1]]
    word = first_word[group_of] + place // 64
    lane = (place % 64).astype(np.uint64)
    word_start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    one = np.uint64(1)
    vertical = [np.bitwise_or.reduceat(((prints >> np.uint64(p)) & one) << lane, word_start) for p in planes]
    valid = np.bitwise_or.reduceat(one << lane, word_start)

    # which words each row meets: its own group's from its own on, or all of the run's second side
    run_of_group = (np.cumsum(fresh_run) - 1)[group_start]
    groups_in_run = np.bincount(run_of_group)[run_of_group]
    second = np.r_[run_of_group[1:] == run_of_group[:-1], False]  # the next group is of the same run
    after = np.r_[first_word[1:], 0]
    size_after = np.r_[words_in[1:], 0]
    alone = groups_in_run[group_of] == 1
    begin = np.where(alone, word, np.where(second[group_of], after[group_of], 0))
    number = np.where(alone, first_word[group_of] + words_in[group_of] - word,
                      np.where(second[group_of], size_after[group_of], 0))
    # a row that has only itself left in its group's last word meets nobody
    number = np.where(alone & (place == group_size[group_of] - 1), 0, number)
    rows_meeting = np.flatnonzero(number)
    counters = max_bits.bit_length()
    headroom = (1 << counters) - 1 - max_bits  # counting starts here, so the overflow comes at max_bits + 1
    upto = np.cumsum(number[rows_meeting])
    at = 0
    while at < len(rows_meeting):
        base = upto[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto, base + COMPARED, side="right")))
        rows = rows_meeting[at:end]
        at = end
        for piece in range(0, int(number[rows].max()), COMPARED):  # one row against very many words
            take = np.clip(number[rows] - piece, 0, COMPARED)
            who = np.repeat(rows, take)
            word_at = (np.arange(len(who)) - np.repeat(np.cumsum(take) - take, take)) + piece + begin[who]
            query = prints[who]
            later = ~((np.uint64(2) << lane[who]) - one)
            over = ~np.where(alone[who] & (word_at == word[who]), valid[word_at] & later, valid[word_at])
            count = [np.full(len(who), ALL if headroom >> k & 1 else 0, dtype=np.uint64) for k in range(counters)]
            for done, (p, plane) in enumerate(zip(planes, vertical, strict=True), 1):
                carry = plane[word_at] ^ (np.uint64(0) - ((query >> np.uint64(p)) & one))
                for k in range(counters):
                    count[k], carry = count[k] ^ carry, count[k] & carry
                over |= carry
                if done % 6 == 0:
                    open_ = over != ALL
                    if not open_.all():
                        who, word_at, query, over = who[open_], word_at[open_], query[open_], over[open_]
                        count = [c[open_] for c in count]
                        if not len(who):
                            break
            hit, at_lane = np.nonzero((~over[:, None] >> LANES[None, :]) & one) if len(who) else ((), ())
            if len(hit):
                sets.unite(who[hit], word_start[word_at[hit]] + at_lane)
    return sets.parent


def _bucket_links(masks: Sequence[int], max_bits: int):
    """Task body: rows (choice, key, a, b, side, print) sorted in that order to edges (u, v)."""

    def edges_of(table: list[np.ndarray]) -> pa.RecordBatch:
        choice, key, a, b, side, prints = table
        us, vs = [], []
        for c in np.unique(choice):
            mine = choice == c
            k, x, y, s, f = key[mine], a[mine], b[mine], side[mine], prints[mine]
            new = np.r_[True, (k[1:] != k[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])]
            run = np.cumsum(new) - 1
            several = np.bincount(run)[run] > 1
            f, run, s = f[several].view(np.uint64), run[several], s[several]
            root = bit_sliced_links(f, run, s, [p for p in range(BITS) if not masks[c] >> p & 1], max_bits)
            linked = np.flatnonzero(root != np.arange(len(root)))
            us.append(f[linked].view(np.int64))
            vs.append(f[root[linked]].view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"])

    def link(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            rows += batch.num_rows
            if rows < 100_000:
                continue
            table = [np.concatenate(c) for c in zip(*held, strict=True)]
            # the last run may go on in the next batch
            same = np.ones(rows, dtype=bool)
            for column in table[:4]:
                same &= column == column[-1]
            cut = rows - int(np.argmin(same[::-1])) if not same.all() else 0
            if cut:
                yield edges_of([c[:cut] for c in table])
            held, rows = [[c[cut:] for c in table]], rows - cut
        if rows:
            yield edges_of([np.concatenate(c) for c in zip(*held, strict=True)])

    return link


def link_edges(prints: DataFrame, max_bits: int = MAX_BITS, block_members: int = BLOCK_MEMBERS) -> DataFrame:
    """Distinct fingerprints (print) to edges (u, v) that connect all links within `max_bits`."""
    masks = block_masks(max_bits)
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    spread = (prints.select("print", F.posexplode(F.array(*[F.lit(m) for m in signed])).alias("choice", "mask"))
              .select(F.col("choice").cast("byte").alias("choice"), F.col("print").bitwiseAND(F.col("mask")).alias("key"),
                      "print"))
    sampled = spread.where(F.pmod(F.xxhash64("print"), F.lit(SAMPLE)) == 0)
    large = (sampled.groupBy("choice", "key").agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") * SAMPLE > block_members)
             .select(F.col("choice").alias("l_choice"), F.col("key").alias("l_key"),
                     F.ceil(F.col("n") * SAMPLE / F.lit(block_members)).cast("int").alias("blocks")))
    large = stored(large, "simhash-large")
    dealt = spread.join(large, (F.col("choice") == F.col("l_choice")) & (F.col("key") == F.col("l_key")), "left")
    blocks = F.coalesce("blocks", F.lit(1))
    dealt = dealt.select("choice", "key", "print", F.pmod(F.xxhash64(F.lit(7), F.col("print")), blocks).cast("int").alias("side"),
                         F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    dealt = dealt.select("choice", "key", F.least("side", "other").alias("a"), F.greatest("side", "other").alias("b"),
                         "side", "print")
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (dealt.repartition(parts, "choice", "key", "a", "b")
            .sortWithinPartitions("choice", "key", "a", "b", "side")
            .mapInArrow(_bucket_links(masks, max_bits), "u long, v long"))


def _labels(prints: DataFrame, max_bits: int, block_members: int) -> DataFrame:
    """Rows (doc_id, print) to (l_print, component_id, root), one per fingerprint."""
    distinct = stored(prints.groupBy("print").agg(F.min("doc_id").alias("low")), "simhash-prints")
    roots = components(link_edges(distinct.select("print"), max_bits, block_members))
    labelled = (distinct.join(roots, F.col("print") == F.col("node"), "left")
                .select("print", "low", F.coalesce("root", "print").alias("root")))
    labelled = stored(labelled, "simhash-roots")
    least = stored(labelled.groupBy("root").agg(F.min("low").alias("component_id")), "simhash-least")
    return stored(labelled.join(least, "root").select(F.col("print").alias("l_print"), "component_id", "root"),
                  "simhash-labels")


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = WORDS,
                    max_bits: int = MAX_BITS, block_members: int = BLOCK_MEMBERS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (least doc_id reachable over links), one row per row.

    Null and blank texts have fingerprint zero and are linked like any other. Null ids never are the least; a
    component of null ids alone has a null component_id. Repeated rows are members like any other. An empty table
    gives no rows. Other columns are ignored.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    slim = stored(with_fingerprint(slim, "text", "print", words).select("doc_id", "print"), "simhash-docs")
    labels = _labels(slim, max_bits, block_members)
    return (slim.join(labels, F.col("print") == F.col("l_print"))
            .select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"))


def one_per_group(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = WORDS,
                  max_bits: int = MAX_BITS, block_members: int = BLOCK_MEMBERS) -> DataFrame:
    """The documents with all columns, one of each component: the least doc_id, of equal ids one row."""
    table = stored(with_fingerprint(docs, text, free_name("print", docs.columns), words), "simhash-whole")
    name = table.columns[-1]
    slim = table.select(F.col(doc_id).alias("doc_id"), F.col(name).alias("print"),
                        F.struct(F.col(doc_id).isNull(), F.col(doc_id), F.col("_metadata.file_name").alias("file"),
                                 F.col("_metadata.row_index").alias("at")).alias("row"))
    labels = _labels(slim, max_bits, block_members)
    kept = (slim.join(labels, F.col("print") == F.col("l_print")).groupBy("root").agg(F.min("row").alias("row"))
            .select(F.col("row.file").alias("k_file"), F.col("row.at").alias("k_at")))
    kept = stored(kept, "simhash-kept")
    whole = table.select(F.struct(*docs.columns).alias("whole"), F.col("_metadata.file_name").alias("file"),
                         F.col("_metadata.row_index").alias("at"))
    return (whole.join(kept.hint("merge"), (F.col("file") == F.col("k_file")) & (F.col("at") == F.col("k_at")), "left_semi")
            .select(*[F.col("whole").getField(c).alias(c) for c in docs.columns]))
