"""Target-distribution importance resampling over hashed words and word pairs.

A dictionary of the corpus' distinct words, bounded by spaces, is an Aho-Corasick automaton whose payloads are CRC and
length of a word. Scanning a text emits one payload per word, and the CRC of two neighbouring words follows from their
payloads alone, so a feature is never spelled out. Buckets so found are counted over all documents and all target texts,
and in a second scan give each document its weight. Words outside the dictionary, which has a fixed size, get their
payload from their bytes.

The draw adds Gumbel noise that hangs on the document's id and takes the highest sums. Sums are whole numbers of a
bounded range, so a histogram names the sum at which the draw ends, and only rows at and above it are put in order.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.llm.common import stored

BUCKETS = 10_000
SEED = 7
LEAST_WORDS = 20
PERCENT = 25
# The dictionary: so many words at most, the more frequent ones, of so many bytes at most.
DICTIONARY = 65_536
LONGEST = 64
# Bytes of text that are scanned together.
BLOCK_BYTES = 4 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DELIMITERS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACE = 0x20
# Every byte of UTF-8 as itself, but upper case lowered and delimiters to spaces.
NORMAL = bytes(b + 32 if chr(b) in UPPER else b if b >= 128 or chr(b) in LOWER or 48 <= b <= 57 else SPACE for b in range(256))


def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map of 32-bit values, given by its outcomes for the four bytes, on an array."""
    return table[0][crc & 255] ^ table[1][(crc >> 8) & 255] ^ table[2][(crc >> 16) & 255] ^ table[3][crc >> 24]


class CrcShift:
    """What a CRC-32 becomes when n more bytes follow, apart from those bytes' own CRC."""

    def __init__(self):
        byte = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            byte = np.where(byte & 1, (byte >> 1) ^ np.uint32(0xEDB88320), byte >> 1).astype(np.uint32)
        low = [np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])]
        for _ in range(256):
            low.append((low[-1] >> np.uint32(8)) ^ byte[low[-1] & 255])
        self.low = np.stack(low[:256])  # by 0 to 255 bytes
        self.high = [low[256]]          # by 256, 512, ... bytes
        while len(self.high) < 40:
            self.high.append(np.stack([_apply(self.high[-1], row) for row in self.high[-1]]))

    def __call__(self, crc: np.ndarray, n: np.ndarray) -> np.ndarray:
        few = n & 255
        out = (self.low[few, 0, crc & 255] ^ self.low[few, 1, (crc >> 8) & 255]
               ^ self.low[few, 2, (crc >> 16) & 255] ^ self.low[few, 3, crc >> 24])
        rest, bit = n >> 8, 0
        while rest.any():
            odd = np.flatnonzero(rest & 1)
            out[odd] = _apply(self.high[bit], out[odd])
            rest, bit = rest >> 1, bit + 1
        return out


class Scanner:
    """Buckets of the words and word pairs of texts, through an automaton over a dictionary of words (bytes)."""

    def __init__(self, words: Iterable[bytes], buckets: int):
        import ahocorasick
        self.buckets, self.shift = buckets, CrcShift()
        self.space = np.uint32(zlib.crc32(b" "))
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        for word in words:  # a byte is a character, so that lengths are those of UTF-8
            self.automaton.add_word(f" {word.decode('latin-1')} ", len(word) << 32 | zlib.crc32(word))
        if len(self.automaton):
            self.automaton.make_automaton()

    def _segments(self, texts: list[str | None]) -> Iterator[tuple[int, bytes]]:
        """(text, bytes): texts in order, long ones cut between words."""
        for i, text in enumerate(texts):
            raw = (text or "").encode().translate(NORMAL)
            start = 0
            while len(raw) - start > BLOCK_BYTES:
                cut = raw.rfind(b" ", start, start + BLOCK_BYTES)
                cut = cut if cut > start else raw.find(b" ", start + BLOCK_BYTES)
                if cut < 0:
                    break
                yield i, raw[start:cut]
                start = cut
            yield i, raw[start:]

    def _blocks(self, texts: list[str | None]) -> Iterator[tuple[list[int], list[bytes]]]:
        of, held, size = [], [], 0
        for i, raw in self._segments(texts):
            if held and size + len(raw) > BLOCK_BYTES:
                yield of, held
                of, held, size = [], [], 0
            of.append(i)
            held.append(raw)
            size += len(raw)
        if held:
            yield of, held

    def payloads(self, block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and CRC of every word of a block that begins and ends with a space."""
        solid = np.frombuffer(block, np.uint8) != SPACE
        starts = np.flatnonzero(solid[1:] & ~solid[:-1]) + 1
        ends = np.flatnonzero(solid[:-1] & ~solid[1:]) + 1
        lengths, crcs = ends - starts, np.zeros(len(starts), np.uint32)
        left = np.ones(len(starts), bool)
        if len(self.automaton):
            found = np.fromiter(chain.from_iterable(self.automaton.iter(block.decode("latin-1"))), np.int64).reshape(-1, 2)
            # a match ends with the space after its word
            nth = np.searchsorted(ends, found[:, 0])
            crcs[nth], left[nth] = (found[:, 1] & 0xFFFFFFFF).astype(np.uint32), False
            lengths[nth] = found[:, 1] >> 32
        for i in np.flatnonzero(left).tolist():
            crcs[i] = zlib.crc32(block[starts[i]:ends[i]])
        return starts, lengths, crcs

    def features(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(text, bucket) of every word and of every two neighbouring words, block by block."""
        last = (np.array([-1]), np.zeros(1, np.uint32))
        for of, held in self._blocks(texts):
            starts, lengths, crcs = self.payloads(b" " + b" ".join(held) + b" ")
            if not len(starts):
                continue
            begins = np.cumsum([1, *[len(raw) + 1 for raw in held[:-1]]])
            text = np.array(of)[np.searchsorted(begins, starts, side="right") - 1]
            # the last word of the block before goes on here if its text does
            before, before_crc = np.r_[last[0], text[:-1]], np.r_[last[1], crcs[:-1]]
            pair = before == text
            head = self.shift(before_crc[pair], np.ones(pair.sum(), np.int64)) ^ self.space
            both = self.shift(head, lengths[pair]) ^ crcs[pair]
            yield np.r_[text, text[pair]], np.r_[crcs, both] % np.uint32(self.buckets)
            last = text[-1:], crcs[-1:]


def words_with_counts(texts: DataFrame, text: str) -> DataFrame:
    """(word, n) over all texts, for words that the dictionary may hold."""
    normal = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    return (texts.select(F.explode(F.split(normal, DELIMITERS)).alias("word"))
            .where((F.col("word") != "") & (F.octet_length("word") <= LONGEST))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def dictionary(texts: DataFrame, text: str, size: int = DICTIONARY) -> list[bytes]:
    """The more frequent words of all texts: those above the least count, in steps of 2 ** 1/4, that `size` words reach."""
    counted = stored(words_with_counts(texts, text), "resample-words")
    level = F.floor(F.log2("n") * 4)
    levels = sorted(((r["level"], r["words"]) for r in counted.groupBy(level.alias("level"))
                     .agg(F.count(F.lit(1)).alias("words")).collect()), reverse=True)
    least, held = None, 0
    for at, words in levels:
        if held + words > size:
            break
        least, held = at, held + words
    if least is None:
        return []
    return sorted(r["word"].encode() for r in counted.where(level >= least).select("word").collect())


def bucket_counts(texts: DataFrame, text: str, words: list[bytes], buckets: int) -> np.ndarray:
    """Features in each bucket over all texts: a vector per task, summed up by bucket."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, total = Scanner(words, buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, found in scanner.features(batch.column(0).to_pylist()):
                total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], names=["bucket", "n"])

    counted = (texts.select(F.col(text).cast("string")).mapInArrow(run, "bucket int, n long")
               .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(buckets, np.int64)
    for r in counted:
        out[r["bucket"]] = r["n"]
    return out


def gains_of(here: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the add-one likelihood ratio) by bucket."""
    n = len(here)
    s_all, t_all = float(here.sum()) + n, float(target.sum()) + n
    return np.array([math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all)))
                     for s, t in zip(here.tolist(), target.tolist(), strict=True)], np.int64)


def weighted(docs: DataFrame, doc_id: str, text: str, words: list[bytes], gains: np.ndarray) -> DataFrame:
    """doc_id, n_features, weight by document, in a second scan."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("n_features", T.LongType()),
                           T.StructField("weight", T.LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(words, len(gains))
        for batch in batches:
            n = batch.num_rows
            sums, features = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for of, found in scanner.features(batch.column(1).to_pylist()):
                # sums of whole numbers below 2 ** 53
                sums += np.bincount(of, weights=gains[found], minlength=n).astype(np.int64)
                features += np.bincount(of, minlength=n)
            weight = sums // np.maximum(features, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(features), pa.array(weight)], names=schema.names)

    return docs.select(F.col(doc_id), F.col(text).cast("string")).mapInArrow(run, schema)


def noise(doc_id: Column, seed: int) -> Column:
    """floor(1000 times a Gumbel variate), the same for an id whenever it is drawn."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"),
                                  256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def in_order(rows: DataFrame, order: list[Column], rank: str) -> DataFrame:
    """Number rows from 1 in an order over all of them: ranges are sorted by themselves, and start where others end."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # this id counts up within a task, from the task's number in its upper bits
    dealt = stored(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                   .withColumn("_at", F.monotonically_increasing_id()), "resample-order")
    part = F.shiftright("_at", 33)
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (dealt.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
              .select(F.col("_part").alias("_of"), F.coalesce(F.sum("_rows").over(upto), F.lit(0)).alias("_start")))
    return (dealt.join(stored(starts, "resample-starts"), part == F.col("_of"))
            .withColumn(rank, F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1)
            .drop("_at", "_of", "_start"))


def resample(docs: DataFrame, target: DataFrame, *, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
             buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED,
             words: int = DICTIONARY) -> DataFrame:
    """doc_id, n_features, weight, score, rank: one row per row; rank is null for documents that are not drawn.

    Null texts have no words, and so no features and weight 0. A null id counts as an empty one for the noise and comes
    last among ties; rows of equal id and score are ranked in any order. Repeated rows are documents of their own. An
    empty target gives each bucket its add-one share. The id keeps its type; an empty table gives no rows; other columns
    are ignored.
    """
    known = dictionary(docs, text, words)
    gains = gains_of(bucket_counts(docs, text, known, buckets), bucket_counts(target, target_text, known, buckets))
    scored = weighted(docs, doc_id, text, known, gains)
    # w words have w features of one word and w - 1 of two
    scored = stored(scored.withColumn("score", (F.col("weight") + noise(F.col("doc_id"), seed)).cast("long"))
                    .withColumn("fit", F.floor((F.col("n_features") + 1) / 2) >= least_words), "resample-scores")
    histogram = sorted(((r["score"], r["n"]) for r in scored.where("fit").groupBy("score")
                        .agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    quota = percent * sum(n for _, n in histogram) // 100
    least, held = None, 0
    for score, n in histogram:
        if held >= quota:
            break
        least, held = score, held + n
    near = F.col("fit") & (F.col("score") >= least) if least is not None else F.lit(False)
    columns = ["doc_id", "n_features", "weight", "score"]
    ranked = in_order(scored.where(near).select(*columns), [F.col("score").desc(), F.col("doc_id").asc_nulls_last()], "rank")
    return (ranked.select(*columns, F.when(F.col("rank") <= quota, F.col("rank")).cast("long").alias("rank"))
            .unionByName(scored.where(~near).select(*columns, F.lit(None).cast("long").alias("rank"))))
