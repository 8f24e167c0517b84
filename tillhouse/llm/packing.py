"""Best-fit-decreasing packing of token sequences.

Lengths are integers up to the sequence length, so best fit decreasing over all documents needs only the number of
pieces of each length: 1,024 counts, whatever the corpus holds. The driver packs those counts with a segment tree
over remaining capacities, taking all open bins of one capacity, or all pieces of one length, at once. The outcome,
runs of pieces with their bins and offsets, is at most quadratic in the sequence length. Pieces are numbered within
their length, and look their run up.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.llm.common import numbered, stored

LENGTH = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k.json"
SPECIAL = "<|endoftext|>"
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


class CapacityTree:
    """Segment tree over remaining capacities: how many open bins have each, and the least one that is enough."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, remaining: int, bins: int) -> None:
        at = remaining + self.leaves
        while at:
            self.count[at] += bins
            at >>= 1

    def tightest(self, size: int) -> int:
        """Least remaining capacity >= size that an open bin has, or -1: up to a right sibling, down its left edge."""
        at = size + self.leaves
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return -1
            at += 1
            while at < self.leaves:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        return at - self.leaves


def best_fit_runs(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Pack counts[size] items of each size; returns (size, rank, items, first_bin, per_bin, offset) runs.

    Item number rank + i of a size, i < items, goes to bin first_bin + i // per_bin, at offset + (i % per_bin) * size.
    This is what packing the items one by one gives: of equal items the next one fits best where the last one went.
    """
    tree = CapacityTree(capacity)
    open_bins: dict[int, list[tuple[int, int]]] = {}  # remaining: [(first bin, bins)]
    runs, bins = [], 0

    def put_back(remaining: int, first: int, number: int) -> None:
        open_bins.setdefault(remaining, []).append((first, number))
        tree.add(remaining, number)

    for size in sorted(counts, reverse=True):
        left, rank = counts[size], 0
        while left:
            room = tree.tightest(size)
            if room < 0:
                room, new = capacity, -(-left // (capacity // size))
                put_back(capacity, bins, new)
                bins += new
            first, number = open_bins[room].pop()
            tree.add(room, -number)
            per_bin = room // size
            used = min(number, left // per_bin)
            if used:
                runs.append((size, rank, used * per_bin, first, per_bin, capacity - room))
                put_back(room - per_bin * size, first, used)
                rank, left = rank + used * per_bin, left - used * per_bin
            elif left:
                runs.append((size, rank, left, first, left, capacity - room))
                put_back(room - left * size, first, 1)
                used, left = 1, 0
            if number > used:
                put_back(room, first + used, number - used)
    return runs


def _encoder(path: str):
    """Token ids of a text, as the tokenizers library gives them for the vocabulary file.

    The rank file beside it holds the same vocabulary; its encoder is about five times faster and gives the same
    ids. Texts that spell the special token go through the tokenizers library itself.
    """
    ranks_path = path.removesuffix(".json") + ".tiktoken"
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(path)

    def slow(text: str) -> list[int]:
        return whole.encode(text, add_special_tokens=False).ids

    if not os.path.exists(ranks_path):
        return slow
    import base64

    import public_tokenizers
    import tiktoken
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    exact = tiktoken.Encoding("exact", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    # the look-ahead only matters between two white-space characters; without it the pattern needs no backtracking
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN.replace(r"|\s+(?!\S)", ""),
                              mergeable_ranks=ranks, special_tokens={})
    double_gap = re.compile(r"\s\s")

    def ids(text: str) -> list[int]:
        if SPECIAL in text:
            return slow(text)
        return (exact if double_gap.search(text) else plain).encode_ordinary(text)

    return ids


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def pieces(docs: DataFrame, doc_id: str, text: str, length: int, vocabulary: str | None, end_id: int) -> DataFrame:
    """One row per piece of at most `length` tokens; a document's first piece is the short one."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(vocabulary or default_vocabulary())
        schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                            ("length", pa.int64()), ("ids_crc32", pa.int64())])
        for batch in batches:
            rows = []
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                tokens = np.array([*encode(value.as_py() or ""), end_id], dtype="<u4")
                at, piece = 0, 0
                upto = len(tokens) % length or length
                while at < len(tokens):
                    rows.append((key, piece, at, upto - at, zlib.crc32(tokens[at:upto].tobytes())))
                    at, upto, piece = upto, upto + length, piece + 1
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
                                             schema=schema)

    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
            .mapInArrow(cut, PIECE_SCHEMA))


def pack(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
         vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece, each sequence gapless.

    A null or empty text is its end token alone. Null ids and repeated rows are packed like any other; an empty
    table gives no rows. Other columns are ignored.
    """
    table = stored(pieces(docs, doc_id, text, length, vocabulary, end_id), "pack-pieces")
    counts = {r["length"]: r["n"] for r in table.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    schema = T.StructType([T.StructField(n, T.LongType(), False)
                           for n in ("size", "rank", "items", "first_bin", "per_bin", "run_offset")])
    runs = table.sparkSession.createDataFrame(best_fit_runs(counts, length), schema)
    runs = stored(runs.coalesce(1), "pack-runs")
    nth = F.col("nth")
    return (numbered(table, ["length"], "nth")
            .join(runs, (F.col("length") == F.col("size")) & (nth >= F.col("rank"))
                  & (nth < F.col("rank") + F.col("items")))
            .withColumn("nth", nth - F.col("rank"))
            .select("doc_id", "piece", "start", "length", "ids_crc32",
                    (F.col("first_bin") + F.floor(nth / F.col("per_bin"))).cast("long").alias("sequence_id"),
                    (F.col("run_offset") + (nth % F.col("per_bin")) * F.col("length")).cast("long").alias("offset")))
