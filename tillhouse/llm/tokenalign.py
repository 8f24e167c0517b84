"""Alignment of two tokenizers over the same texts.

Byte offsets where tokens of both end cut a text into groups; all tokens of a group are linked. A group of one token on
each side holds the same bytes on both, so an array made beforehand from A-id to the B-id of the same bytes names its
pair: such pairs are counted in vectors as long as the vocabulary, one per task. Only pairs of irregular groups, folded
to the distinct ones of a block of documents, are counted by a shuffle and looked up by another.

Texts are encoded once, and each distinct word of a block once. The table that this writes holds, by block, the distinct pairs of each document with their links,
and the pairs of the block with the number of its documents that hold them.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.llm.common import stored

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Bytes of text that are aligned, and looked up, together; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20
# Occurrence pairs that are written out at once; a group of more is folded to its distinct tokens first.
EXPAND = 1 << 20
# Words that are encoded in one call.
TOGETHER = 2048
# A pair that most blocks hold is looked up in this many places.
SALTS = 8
DOCUMENT, COUNTS = 0, 1


def public_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_level_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the rest from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_level(path: str) -> tuple[Callable[[str], list[int]], list[bytes]]:
    """Encoder without special tokens, and the bytes of every id, of a byte-level vocabulary file.

    A rank file beside it holds the same vocabulary without special tokens, and its encoder is faster.
    """
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    alphabet = byte_level_alphabet()
    entries = [b""] * whole.get_vocab_size()
    for entry, i in whole.get_vocab().items():
        entries[i] = bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode()
    ranks_path = path.removesuffix(".json") + ".tiktoken"
    if not os.path.exists(ranks_path):
        return lambda text: whole.encode(text, add_special_tokens=False).ids, entries
    import public_tokenizers
    import tiktoken
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={}).encode_ordinary, entries


def pieces(path: str) -> tuple[Callable[[str], list[int]], list[bytes]]:
    """Encoder and the bytes of every id of a piece model; it puts a space before the text by itself."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    entries = []
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        entries.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return model.encode, entries


def identity(a_bytes: list[bytes], b_bytes: list[bytes]) -> np.ndarray:
    """For every A-id the B-id of the same bytes, or -1; of several (a byte and its character) the last one, the piece."""
    place = {b: i for i, b in enumerate(b_bytes)}
    return np.array([place.get(a, -1) if a else -1 for a in a_bytes], np.int64)


def _folded(keys: list[np.ndarray], numbers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of their numbers."""
    key, number = np.concatenate(keys or [np.empty(0, np.int64)]), np.concatenate(numbers or [np.empty(0, np.int64)])
    if not len(key):
        return key, number
    order = np.argsort(key, kind="stable")
    key, number = key[order], number[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[first], np.add.reduceat(number, first)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places start, ..., start + size - 1 of every run, and which run each belongs to."""
    run = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(sizes.sum()) - np.repeat(sizes.cumsum() - sizes, sizes) + starts[run], run


class Words(NamedTuple):
    """What distinct words give: by word whether both sides spell it, its counts, its groups as text; its links."""

    whole: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    fast: np.ndarray        # word * n_a + A-id, in order
    fast_links: np.ndarray
    pair: np.ndarray        # (word * n_a + A-id) * n_b + B-id, in order
    pair_links: np.ndarray


class Block(NamedTuple):
    """The same by text."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups_sha256: list[str]
    fast: np.ndarray
    fast_links: np.ndarray
    pair: np.ndarray
    pair_links: np.ndarray


class Aligner:
    """Tokens, groups and links of a block of texts.

    No token of either side holds a space after something that is no white space, so both sides cut there, and a text is
    aligned word by word. A block encodes and aligns each of its distinct words once.
    """

    # a space between words: what stands before it is neither white space nor the sign that stands for a space
    gap = re.compile(r"(?<=[^\s▁]) (?!\Z)")
    odd = re.compile(r"(?:^|[\s▁]) | \Z")

    def __init__(self, a_path: str, b_path: str):
        self.encode_a, self.a_bytes = byte_level(a_path)
        self.encode_b, self.b_bytes = pieces(b_path)
        if any(re.search(r"\S ", x.decode(errors="replace")) for x in self.a_bytes + self.b_bytes):
            raise ValueError("a vocabulary whose tokens go on after a space is not aligned word by word")
        self.a_length = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_length = np.array([len(x) for x in self.b_bytes], np.int64)
        self.same = identity(self.a_bytes, self.b_bytes)
        self.n_a, self.n_b = len(self.a_bytes), len(self.b_bytes)
        # what a token is written as, by what follows it: A inside and at the end of its side, then B likewise
        self.written = np.array([f"{i}{end}" for n, ends in ((self.n_a, ",|"), (self.n_b, ",;")) for end in ends
                                 for i in range(n)], dtype=object)

    def words_of(self, text: str | None) -> list[str]:
        """Words of a text, each without the space before it."""
        if not text:
            return []
        return self.gap.split(text) if self.odd.search(text) else text.split(" ")

    def _tokens(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Whether both sides spell a word, tokens of either side by word, and the tokens, word after word.

        Words are encoded many in one call, with a space between them, where both sides cut. A word that cannot stand
        before a space is encoded by itself, and so is each word of a call that does not give back its bytes.
        """
        whole, counts, parts = np.ones(len(words), bool), np.zeros((2, len(words)), np.int64), ([], [])
        spelled = self.a_bytes, self.b_bytes

        def encode(text: str) -> tuple[list[int], list[int]] | None:
            both, raw = (self.encode_a(" " + text), self.encode_b(text)), b" " + text.encode()
            return both if all(b"".join(map(t.__getitem__, x)) == raw for t, x in zip(spelled, both, strict=True)) else None

        def take(first: int, some: list[str]) -> None:
            both = encode(" ".join(some)) if some else ((), ())
            if both is None and len(some) > 1:
                for i, word in enumerate(some, first):
                    take(i, [word])
                return
            whole[first:first + len(some)] = both is not None
            ends = np.cumsum([len(w.encode()) + 1 for w in some])
            for k, length in enumerate((self.a_length, self.b_length)):
                ids = np.array(both[k] if both else (), np.int64)
                counts[k, first:first + len(some)] = np.bincount(np.searchsorted(ends, length[ids].cumsum()), minlength=len(some))
                parts[k].append(ids)

        alone = [i for i, w in enumerate(words) if not w or w[-1].isspace() or w[-1] == "▁"]
        for start, stop in zip([0, *[i + 1 for i in alone]], [*alone, len(words)], strict=True):
            for first in range(start, stop, TOGETHER):
                take(first, words[first:min(stop, first + TOGETHER)])
            if stop < len(words):
                take(stop, [words[stop]])
        return (whole, *counts, *(np.concatenate([*part, np.empty(0, np.int64)]) for part in parts))

    def words(self, words: list[str]) -> Words:
        n = len(words)
        whole, n_a, n_b, a, b = self._tokens(words)
        if not len(a):
            none, zero = np.empty(0, np.int64), np.zeros(n, np.int64)
            return Words(whole, zero, zero, zero, zero, [""] * n, none, none, none, none)
        # offsets run on over the words: both sides of a word have the same bytes
        a_end, b_end = self.a_length[a].cumsum(), self.b_length[b].cumsum()
        at = np.searchsorted(b_end, a_end)
        a_cut = b_end[at] == a_end
        b_cut = np.zeros(len(b), bool)
        b_cut[at[a_cut]] = True
        a_group, b_group = a_cut.cumsum() - a_cut, b_cut.cumsum() - b_cut
        a_size, b_size = np.bincount(a_group), np.bincount(b_group)
        a_first, b_first = a_size.cumsum() - a_size, b_size.cumsum() - b_size
        of_word = np.repeat(np.arange(n), n_a)[a_first]
        links = a_size * b_size
        single = links == 1
        single[single] = self.same[a[a_first[single]]] == b[b_first[single]]
        pair, pair_links = self._pairs(a, b, np.flatnonzero(~single), a_first, b_first, a_size, b_size, of_word)
        head, b_of = np.divmod(pair, self.n_b)
        known = self.same[head % self.n_a] == b_of
        fast, fast_links = _folded([of_word[single] * self.n_a + a[a_first[single]], head[known]],
                                   [np.ones(single.sum(), np.int64), pair_links[known]])
        n_links = np.bincount(of_word, weights=links, minlength=n).astype(np.int64)
        return Words(whole, n_a, n_b, np.bincount(of_word, minlength=n), n_links,
                     self._written(a, b, a_group, b_group, a_cut, b_cut, a_size, b_size, n_a, n_b),
                     fast, fast_links, pair[~known], pair_links[~known])

    def _pairs(self, a, b, groups, a_first, b_first, a_size, b_size, of_word) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (word, A, B) of some groups and the number of occurrence pairs of each."""
        keys, numbers = [], []
        product = a_size[groups] * b_size[groups]
        huge = product > EXPAND
        for g in groups[huge]:
            xs, x_n = np.unique(a[a_first[g]:a_first[g] + a_size[g]], return_counts=True)
            ys, y_n = np.unique(b[b_first[g]:b_first[g] + b_size[g]], return_counts=True)
            for x, times in zip(xs, x_n, strict=True):
                keys.append((of_word[g] * self.n_a + x) * self.n_b + ys)
                numbers.append(times * y_n)
        groups, product = groups[~huge], product[~huge]
        upto = product.cumsum()
        start = 0
        while start < len(groups):
            done = upto[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(upto, done + EXPAND, side="right")))
            nth, run = _spread(np.zeros(stop - start, np.int64), product[start:stop])
            g = groups[start:stop][run]
            i, j = np.divmod(nth, b_size[g])
            key, number = np.unique((of_word[g] * self.n_a + a[a_first[g] + i]) * self.n_b + b[b_first[g] + j],
                                    return_counts=True)
            keys.append(key)
            numbers.append(number)
            start = stop
        return _folded(keys, numbers)

    def _written(self, a, b, a_group, b_group, a_cut, b_cut, a_size, b_size, n_a, n_b) -> list[str]:
        """`a1,a2|b1;a3|b2,b3` by word: each group's A tokens, then its B tokens."""
        place = np.empty(len(a) + len(b), np.int64)
        place[np.arange(len(a)) + (b_size.cumsum() - b_size)[a_group]] = a + a_cut * self.n_a
        place[np.arange(len(b)) + a_size.cumsum()[b_group]] = 2 * self.n_a + b + b_cut * self.n_b
        parts = self.written[place].tolist()
        stops = (n_a + n_b).cumsum().tolist()
        return ["".join(parts[s:e])[:-1] for s, e in zip([0, *stops], stops, strict=False)]

    def block(self, texts: list[str | None]) -> Block:
        """Counts and digests by text, and its distinct links: fast by text * n_a + A, pair with B as well."""
        index: dict[str, int] = {}
        coded = [np.array([index.setdefault(w, len(index)) for w in self.words_of(t)], np.int64) for t in texts]
        n, words = len(texts), self.words(list(index))
        for i, codes in enumerate(coded):
            if not words.whole[codes].all():
                coded[i] = codes[:0]
        of_text, code = np.repeat(np.arange(n), [len(c) for c in coded]), np.concatenate([*coded, np.empty(0, np.int64)])
        count = lambda by_word: np.bincount(of_text, weights=by_word[code], minlength=n).astype(np.int64)
        digests = [hashlib.sha256(";".join([words.groups[c] for c in codes.tolist()]).encode()).hexdigest()
                   if len(codes) else "" for codes in coded]
        held, times = np.unique(of_text * max(len(index), 1) + code, return_counts=True)
        of_held, word = np.divmod(held, max(len(index), 1))
        links = []
        for keys, numbers, width in ((words.fast, words.fast_links, self.n_a),
                                     (words.pair, words.pair_links, self.n_a * self.n_b)):
            bounds = np.searchsorted(keys, np.arange(len(index) + 1) * width)
            place, run = _spread(bounds[word], np.diff(bounds)[word])
            links += _folded([of_held[run] * width + keys[place] % width], [times[run] * numbers[place]])
        return Block(*(count(w) for w in words[1:5]), digests, *links)


def _lists(keys: np.ndarray, numbers: np.ndarray, n: int, width: int) -> tuple[pa.Array, pa.Array]:
    """Keys (text, id) in order as one list of ids, and one of numbers, for each of n texts."""
    offsets = pa.array(np.searchsorted(keys, np.arange(n + 1) * width), pa.int32())
    return (pa.ListArray.from_arrays(offsets, pa.array(keys % width, pa.int32())),
            pa.ListArray.from_arrays(offsets, pa.array(numbers, pa.int64())))


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most BLOCK_BYTES of text, or of one row."""
    sizes = [len(v) if (v := x.as_buffer()) is not None else 0 for x in batch.column(1).cast(pa.binary())]
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > BLOCK_BYTES:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def encoded(docs: DataFrame, doc_id: str, text: str, a_path: str, b_path: str) -> DataFrame:
    """Rows of documents, and rows of counts: by block the pairs with their documents, by task the vector of A-ids."""
    kind = docs.schema[doc_id].dataType
    schema = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("block", T.LongType()),
                           T.StructField("doc_id", kind)]
                          + [T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links")]
                          + [T.StructField("groups_sha256", T.StringType())]
                          + [T.StructField(n, T.ArrayType(t)) for n, t in (
                              ("fast", T.IntegerType()), ("fast_links", T.LongType()),
                              ("pair", T.IntegerType()), ("pair_links", T.LongType()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_path, b_path)
        if aligner.n_a * aligner.n_b >= 1 << 31:
            raise ValueError("pair codes of these vocabularies do not fit into an int")
        vector = np.zeros(aligner.n_a, np.int64)
        block, id_type = TaskContext.get().partitionId() << 32, None
        names = schema.names
        for batch in batches:
            ids = batch.column(0)
            id_type = ids.type
            for start, stop in _blocks(batch):
                n = stop - start
                got = aligner.block(batch.column(1).slice(start, n).to_pylist())
                vector += np.bincount(got.fast % aligner.n_a, minlength=aligner.n_a)
                codes, in_docs = np.unique(got.pair % (aligner.n_a * aligner.n_b), return_counts=True)
                columns = [pa.array([DOCUMENT] * n, pa.int32()), pa.array([block] * n, pa.int64()), ids.slice(start, n),
                           *[pa.array(c, pa.int64()) for c in got[:4]], pa.array(got.groups_sha256, pa.string()),
                           *_lists(got.fast, got.fast_links, n, aligner.n_a),
                           *_lists(got.pair, got.pair_links, n, aligner.n_a * aligner.n_b)]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                yield counts(block, id_type, codes=codes, in_docs=in_docs)
                block += 1
        if id_type is not None:
            used = np.flatnonzero(vector)
            yield counts(block, id_type, fast=used, fast_docs=vector[used])

    def counts(block, id_type, fast=(), fast_docs=(), codes=(), in_docs=()) -> pa.RecordBatch:
        row = lambda values, t: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, t))
        return pa.RecordBatch.from_arrays(
            [pa.array([COUNTS], pa.int32()), pa.array([block], pa.int64()), pa.nulls(1, id_type),
             *[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.string()), row(fast, pa.int32()), row(fast_docs, pa.int64()),
             row(codes, pa.int32()), row(in_docs, pa.int64())], names=schema.names)

    return docs.select(F.col(doc_id), F.col(text).cast("string")).mapInArrow(run, schema)


def align_tokenizers(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", a_path: str | None = None,
                     b_path: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: one row per row.

    A pair's count is the number of rows that hold it linked: a repeated row counts again, with its id or without one.
    Texts that are null, empty, or that either tokenizer does not give back byte for byte, have no tokens: zeros, and an
    empty string for the digest. Of ties for an A-id's highest count all are best. The id keeps its type; an empty table
    gives no rows; other columns are ignored.
    """
    a_path, b_path = a_path or public_path(A_FILE), b_path or public_path(B_FILE)
    table = stored(encoded(docs, doc_id, text, a_path, b_path), "align-encoded")
    a_size, b_size = len(byte_level(a_path)[1]), len(pieces(b_path)[1])
    counted = table.where(F.col("kind") == COUNTS)
    in_blocks = (counted.select("block", F.explode(F.arrays_zip("pair", "pair_links")).alias("p"))
                 .select("block", F.col("p.pair").alias("pair"), F.col("p.pair_links").alias("docs")))
    totals = stored(in_blocks.groupBy("pair").agg(F.sum("docs").alias("docs")), "align-pairs")
    fast = (counted.select(F.explode(F.arrays_zip("fast", "fast_links")).alias("p"))
            .groupBy(F.col("p.fast").alias("a")).agg(F.sum("p.fast_links").alias("own")))
    best = totals.groupBy(F.expr(f"cast(pair div {b_size} as int)").alias("a")).agg(F.max("docs").alias("other"))
    # two vectors as long as the vocabulary of A
    own, highest = np.zeros(a_size, np.int64), np.zeros(a_size, np.int64)
    for r in fast.join(best, "a", "full").collect():
        own[r["a"]] = r["own"] or 0
        highest[r["a"]] = max(r["own"] or 0, r["other"] or 0)
    salted = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    looked_up = (in_blocks.select("block", "pair", F.expr(f"cast(pmod(block + (block >> 32), {SALTS}) as int)").alias("salt"))
                 .join(salted, ["pair", "salt"]).select(F.col("block").alias("in_block"), "pair", "docs"))
    documents = table.where(F.col("kind") == DOCUMENT).drop("kind")
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType)] + [
        T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
        + [T.StructField("groups_sha256", T.StringType())])

    def judged(docs: pa.Table, pairs: pa.Table) -> pa.Table:
        known = pairs.column("pair").to_numpy()
        order = np.argsort(known)
        known, in_docs = known[order], pairs.column("docs").to_numpy()[order]
        n_best, count_sum = np.zeros(docs.num_rows, np.int64), np.zeros(docs.num_rows, np.int64)
        for ids, links, of in (("fast", "fast_links", lambda i: (own[i], i)),
                               ("pair", "pair_links", lambda i: (in_docs[np.searchsorted(known, i)], i // b_size))):
            lists, numbers = docs.column(ids).combine_chunks(), docs.column(links).combine_chunks()
            ends = lists.value_lengths().to_numpy(zero_copy_only=False).cumsum()
            flat, number = lists.flatten().to_numpy(), numbers.flatten().to_numpy()
            count, a = of(flat)
            for total, value in ((count_sum, count * number), (n_best, number * (count == highest[a]))):
                running = np.r_[0, value.cumsum()]
                total += running[ends] - running[np.r_[0, ends[:-1]]]
        return pa.table([docs.column("doc_id"), *[docs.column(c) for c in ("n_a", "n_b", "n_groups", "n_links")],
                         pa.array(n_best), pa.array(count_sum), docs.column("groups_sha256")], names=schema.names)

    return documents.groupBy("block").cogroup(looked_up.groupBy("in_block")).applyInArrow(judged, schema)
