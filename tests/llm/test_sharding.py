import random
import zlib
from collections import defaultdict

from helpers import ODD, frame, sentences

from tillhouse.llm import sharding
from tillhouse.llm.sharding import best_fit_decreasing, least_capacity, shard


def test_best_fit_equals_plain_search():
    rng = random.Random(2)
    for _ in range(20):
        sizes = sorted((rng.randint(1, 60) for _ in range(80)), reverse=True)
        bins = []
        for s in sizes:
            fits = [b for b in bins if b >= s]
            if fits:
                bins[bins.index(min(fits))] -= s
            else:
                bins.append(100 - s)
        got = best_fit_decreasing(sizes, 100)
        fill = defaultdict(int)
        for s, b in zip(sizes, got):
            fill[b] += s
        assert sorted(100 - f for f in fill.values()) == sorted(bins)
        assert best_fit_decreasing(sizes, 100, len(bins) - 1) is None


def test_least_capacity():
    assert least_capacity([5, 5, 4, 4, 3, 3], 3)[0] == 8
    assert least_capacity([9, 1], 8)[0] == 9 and least_capacity([], 8)[1] == []


def test_shards(spark):
    rows = [(2000 + i, t) for i, t in enumerate(sentences(300, 30))] + ODD + [(1000 + i, "copied text") for i in range(200)]
    docs = frame(spark, rows).selectExpr("*", "1 as grp", "2 as shard", "3 as size")
    got = shard(docs).collect()
    text = defaultdict(list)
    for doc_id, t in rows:
        text[doc_id].append(t or "")
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in got) == sorted(
        (d or -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    places, slots, size = defaultdict(set), defaultdict(list), defaultdict(int)
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 8
        places[text[r.doc_id][0]].add(r.shard)
        slots[r.shard].append(r.slot)
        size[r.shard] += r.size
    assert all(len(p) == 1 for p in places.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    rest = sorted(size.values())[:-1]  # one long text fills a shard alone
    assert max(rest) - min(rest) < 200


def test_fixed_capacity_and_empty(spark):
    docs = frame(spark, [(i, "x" * n) for i, n in enumerate([5, 4, 3, 2, 9, 20])])
    got = shard(docs, shards=None, capacity=10).collect()
    fill = defaultdict(int)
    for r in got:
        fill[r.shard] += r.size
    assert sorted(fill.values()) == [8, 10, 10, 21] or max(v for v in fill.values() if v != 21) <= 10
    assert shard(docs.limit(0)).count() == 0


def test_capacity_holds_for_many_small_groups_in_bundles(spark, monkeypatch):
    # few bundles and a high share: as on large data, most groups are below the share and bundles above the capacity
    monkeypatch.setattr(sharding, "BUNDLES", 4)
    monkeypatch.setattr(sharding, "LARGE", 1 / 8)
    rng = random.Random(7)
    rows = [(i, f"{i} " + "x" * rng.randint(1, 60)) for i in range(1500)] + [(2000 + i, "copied text") for i in range(9)]
    docs = frame(spark, rows)
    for capacity in (150, 1_000, 20_000):
        fill, places = defaultdict(int), defaultdict(set)
        for r in shard(docs, shards=None, capacity=capacity).collect():
            fill[r.shard] += r.size
            places[r.text_crc32].add(r.shard)
        total = sum(fill.values())
        assert total == sum(len(t) + 1 for _, t in rows) and all(len(p) == 1 for p in places.values())
        assert max(fill.values()) <= capacity and len(fill) <= 1.1 * total / capacity + 1
    # a number of shards is packed as before
    assert {r.shard for r in shard(docs).collect()} <= set(range(8))
