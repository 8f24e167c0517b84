import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from helpers import LOWER, ODD, frame, sentences

from tillhouse.llm import resampling
from tillhouse.llm.resampling import CrcShift, Scanner, dictionary, resample

TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = ["It's 3.14, ÄÖÜ-naïve 日本語。x_y", "a a a a b a a", "w" * 700 + " " + "v" * 70_000 + " end", "\x00\x7f", "ONE", "two Words",
         " ".join(f"word{i}" for i in range(30))]


def features(text):
    words = TOKEN.findall((text or "").translate(LOWER))
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])], len(words)


def bucket(feature, buckets):
    return zlib.crc32(feature.encode()) % buckets


def brute(rows, target, buckets, percent, least_words):
    here, there = np.zeros(buckets, int), np.zeros(buckets, int)
    for counts, texts in ((here, [t for _, t in rows]), (there, target)):
        for t in texts:
            for f in features(t)[0]:
                counts[bucket(f, buckets)] += 1
    s_all, t_all = int(here.sum()), int(there.sum())
    gain = [math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets))))
            for s, t in zip(here.tolist(), there.tolist())]
    out = []
    for doc_id, text in rows:
        fs, words = features(text)
        weight = sum(gain[bucket(f, buckets)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words])
    fit = sorted((r for r in out if r[4] >= least_words), key=lambda r: (-r[3], r[0] is None, r[0]))
    quota = percent * len(fit) // 100
    rank = {id(r): i + 1 for i, r in enumerate(fit[:quota])}
    return [(*r[:4], rank.get(id(r))) for r in out]


KEY = lambda r: tuple((x is None, x or 0) for x in r)


@pytest.mark.parametrize(("buckets", "words"), [(10_000, 65_536), (97, 20), (500, 0)])
def test_equals_brute_force(spark, buckets, words):
    rows = [(100 + i, t) for i, t in enumerate(sentences(80, 45))] + [r for r in ODD if r[0] != 12]
    rows += [(12, "long " * 3000)] + [(300 + i, t) for i, t in enumerate(TEXTS)]
    target = [*sentences(5, 30, seed=0), None, "", "Long words only"]
    docs = frame(spark, rows, 4).selectExpr("*", "1 as rank", "2 as score", "3 as word")
    got = resample(docs, frame(spark, list(enumerate(target)), 2), buckets=buckets, words=words)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=KEY) == sorted(brute(rows, target, buckets, 25, 20), key=KEY)


def test_ties_go_to_the_smaller_id(spark, monkeypatch):
    monkeypatch.setattr(resampling, "noise", lambda doc_id, seed: resampling.F.lit(0))
    rows = [(i, "the same twenty words " * 5) for i in range(40, 0, -1)] + [(None, "the same twenty words " * 5)]
    got = {r.doc_id: r.rank for r in resample(frame(spark, rows), frame(spark, [(1, "same words")]), percent=50).collect()}
    assert got == {i: i if i <= 20 else None for i in range(1, 41)} | {None: None}


def test_composed_crcs():
    shift = CrcShift()
    parts = [(b"abc", b"x"), ("naïve".encode(), b"y" * 255), (b"", b"z" * 256), (b"q" * 9, b"r" * 70_001)]
    got = shift(np.array([zlib.crc32(a) for a, _ in parts], np.uint32), np.array([len(b) for _, b in parts]))
    assert [int(g) ^ zlib.crc32(b) for g, (_, b) in zip(got, parts)] == [zlib.crc32(a + b) for a, b in parts]


@pytest.mark.parametrize("size", [1, 5, 40, 1 << 20])
def test_blocks_of_any_size_give_the_same_features(monkeypatch, size):
    texts = [None, "", *sentences(4, 30), *TEXTS, " lead and trail "]
    monkeypatch.setattr(resampling, "BLOCK_BYTES", size)
    scanner = Scanner([b"a", b"two", b"words", "naïve".encode(), b"never seen"[:5]], 1 << 20)
    got = sorted((int(i), int(b)) for of, found in scanner.features(texts) for i, b in zip(of, found))
    assert got == sorted((i, bucket(f, 1 << 20)) for i, t in enumerate(texts) for f in features(t)[0])


def test_dictionary_holds_the_more_frequent_words(spark):
    docs = frame(spark, [(1, "the The THE of of, rare " + "x" * 65 + " " + "y" * 64), (2, None), (3, "the of end")])
    assert dictionary(docs, "text", 2) == [b"of", b"the"]
    assert dictionary(docs, "text", 10) == [b"end", b"of", b"rare", b"the", b"y" * 64]
    assert dictionary(docs.limit(0), "text") == []


def test_empty_tables(spark):
    docs = frame(spark, [(1, "one two " * 20)])
    assert resample(docs.limit(0), docs).count() == 0
    assert [tuple(r)[:2] for r in resample(docs, docs.limit(0)).collect()] == [(1, 79)]
