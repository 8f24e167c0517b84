import random
import zlib

import numpy as np
import pytest
from helpers import ODD, frame, sentences

from tillhouse.llm.packing import CapacityTree, best_fit_runs, default_vocabulary, pack


def naive(sizes, capacity):
    bins = []
    for s in sorted(sizes, reverse=True):
        fit = [b for b in bins if capacity - sum(b) >= s]
        if fit:
            min(fit, key=lambda b: capacity - sum(b)).append(s)
        else:
            bins.append([s])
    return bins


@pytest.mark.parametrize("seed", range(12))
def test_runs_equal_packing_one_by_one(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 16, 50, 1024])
    sizes = [min(capacity, max(1, int(rng.expovariate(3 / capacity)))) for _ in range(400)]
    counts = {s: sizes.count(s) for s in set(sizes)}
    runs = best_fit_runs(counts, capacity)
    bins, seen = {}, {s: [] for s in counts}
    for size, rank, items, first, per_bin, offset in runs:
        for i in range(items):
            bins.setdefault(first + i // per_bin, []).append((offset + (i % per_bin) * size, size))
            seen[size].append(rank + i)
    assert all(sorted(v) == list(range(counts[s])) for s, v in seen.items())
    for content in bins.values():
        at = 0
        for offset, size in sorted(content):
            assert offset == at
            at += size
        assert at <= capacity
    # bins with equal room are interchangeable, so the fills are what best fit determines
    assert sorted(sum(x for _, x in b) for b in bins.values()) == sorted(map(sum, naive(sizes, capacity)))


def test_tree_finds_the_tightest():
    tree = CapacityTree(20)
    for r in (3, 9, 9, 20):
        tree.add(r, 1)
    assert [tree.tightest(s) for s in (1, 3, 4, 9, 10, 20)] == [3, 3, 9, 9, 20, 20]
    tree.add(20, -1)
    assert tree.tightest(10) == -1


def test_pieces_and_sequences(spark):
    from tokenizers import Tokenizer
    rows = [(i, t) for i, t in enumerate(sentences(60, 90))] + ODD + [
        (90, "two  blanks \n\n and a tab\t\tend  "), (91, "say <|endoftext|> twice <|endoftext|>"), (92, "it's 12 o'clock!!")]
    got = pack(frame(spark, rows)).toPandas()
    encode = Tokenizer.from_file(default_vocabulary()).encode
    want = []
    for doc_id, text in rows:
        ids = [*encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        want += [(doc_id, p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
                 for p, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    key = lambda r: tuple(-1 if x is None or x != x else int(x) for x in r)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(key, got[columns].values.tolist())) == sorted(map(key, want))
    for _, sequence in got.groupby("sequence_id"):
        s = sequence.sort_values("offset")
        assert (s.offset == s.length.cumsum() - s.length).all() and s.length.sum() <= 1024
    assert got.sequence_id.nunique() == len(naive([r[3] for r in want], 1024))


def test_empty(spark):
    assert pack(frame(spark, [(1, "x")]).limit(0)).count() == 0
