import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from helpers import LOWER, ODD, WORD, frame, sentences

from tillhouse.llm.graph import components
from tillhouse.llm.simhash import bit_sliced_links, fingerprint, link_edges, near_duplicates, one_per_group


def print_of(text, k=3):
    words = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, radius=3):
    parent = list(range(len(prints)))
    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, j in combinations(range(len(prints)), 2):
        if bin(prints[i] ^ prints[j]).count("1") <= radius:
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def near(rng, centre, most):
    for bit in rng.sample(range(64), rng.randint(0, most)):
        centre ^= 1 << bit
    return centre


def test_fingerprint():
    for text in ["", " ", "One", "One two", "a b c d", "Ä b c É", "x\x0by z\x1fw q"]:
        assert fingerprint(text.encode()) == print_of(text)
    long = " ".join(sentences(1, 70_000))
    assert fingerprint(long.encode()) == print_of(long)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 4, 6])
def test_bit_sliced_links(radius):
    rng = random.Random(radius)
    centres = [rng.getrandbits(64) for _ in range(12)]
    run, prints = [], []
    for r, n in enumerate([1, 2, 63, 64, 65, 200, 1, 130]):
        run += [r] * n
        prints += [near(rng, rng.choice(centres), 5) for _ in range(n)]
    got = bit_sliced_links(np.array(prints, np.uint64), np.array(run), np.zeros(len(run), int), range(64), radius)
    want = []
    for r in sorted(set(run)):
        at = run.index(r)
        want += [at + i for i in groups([p for p, q in zip(prints, run) if q == r], radius)]
    assert got.tolist() == want


def test_two_sides_meet_only_across():
    prints = np.array([1, 1 << 20, 3, 1 << 21], np.uint64)
    got = bit_sliced_links(prints, np.zeros(4, int), np.array([0, 0, 1, 1]), range(64), 1)
    assert got.tolist() == [0, 1, 0, 3]


@pytest.mark.parametrize("block_members", [40, 32_768])
def test_links_equal_brute_force(spark, block_members):
    rng = random.Random(1)
    hub = rng.getrandbits(64)
    prints = list({near(rng, hub, 6) for _ in range(600)} | {near(rng, rng.getrandbits(64), 0) for _ in range(200)}
                  | {hub ^ ((1 << k) - 1) << 30 for k in range(0, 30, 3)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    roots = components(link_edges(spark.createDataFrame([(p,) for p in signed], "print long"), 3, block_members))
    got = {r.node: r.root for r in roots.collect()}
    want = {}
    for p, g in zip(signed, groups(prints)):
        want.setdefault(g, set()).add(p)
    assert {p: got.get(p, p) for p in signed} == {p: min(m) for m in want.values() for p in m}


def test_query(spark):
    rows = [(i, t) for i, t in enumerate(sentences(30, 60))]
    rows += [(100 + i, rows[i % 5][1] + " more") for i in range(12)] + ODD
    got = near_duplicates(frame(spark, rows).selectExpr("*", "1 as print", "2 as root")).collect()
    prints = [print_of(r[1]) for r in rows]
    roots = groups(prints)
    least = {g: min((r[0] for r, h in zip(rows, roots) if h == g and r[0] is not None), default=None) for g in roots}
    want = [(r[0], f"{p:016x}", least[g]) for r, p, g in zip(rows, prints, roots)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_one_per_group(spark):
    rows = [(3, "a b c d"), (2, "a b c d"), (2, "a b c d"), (None, None), (5, ""), (6, " ".join(sentences(1, 50)))]
    docs = frame(spark, rows).selectExpr("*", "1 as print", "2 as file", "3 as whole")
    out = one_per_group(docs)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [2, 5, 6]
    assert one_per_group(docs.limit(0)).count() == 0


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 500), (900, 800)], "u long, v long")
    assert {(r.node, r.root) for r in components(edges).collect()} == {(i, 0) for i in range(1, 201)} | {(900, 800)}
