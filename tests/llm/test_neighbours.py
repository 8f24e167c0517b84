import math

import duckdb
import numpy as np
import pytest

from tillhouse.llm import neighbours
from tillhouse.llm.neighbours import Coded, Search, nearest
from tillhouse.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def dot(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += x * y
    return total


def brute(rows, k, every):
    fine = [(n, i, v) for n, (i, v) in enumerate(rows)
            if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for n, i, v in fine:
        if i is None or i % every:
            continue
        near = [(-dot(v, w) / (math.sqrt(dot(v, v)) * math.sqrt(dot(w, w))), j is None, j or 0)
                for m, j, w in fine if m != n and len(w) == len(v)]
        out += [(i, r + 1, None if no else j, -s) for r, (s, no, j) in enumerate(sorted(near)[:k])]
    return out


def vectors(n, dims, seed, ids=0):
    rng = np.random.default_rng(seed)
    return [(ids + i, [float(x) for x in rng.normal(size=dims).astype(np.float32)]) for i in range(n)]


def run(spark, rows, kind="float", **options):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(4)
    got = nearest(df.selectExpr("*", "1 as dims", "2 as rank", "3 as vector"), **options)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return [tuple(r) for r in got.collect()]


KEY = lambda r: (*r[:2], r[2] is None, r[2] or 0, r[3])


@pytest.mark.parametrize("kind", ["float", "double"])
def test_equals_brute_force(spark, kind):
    rng = np.random.default_rng(5)
    rows = vectors(400, 16, 1) + vectors(60, 3, 2, 1000) + vectors(1, 7, 3, 2000)
    copy = rows[50][1]
    rows += [(i, copy) for i in (5000, 4999, 50, 50, 20, 20, None, None, *range(6000, 6040, 2))]  # exact copies, same ids
    rows += [(7000 + i, [2 * x for x in copy]) for i in range(6)]                             # the same direction
    rows += [(8000 + i, [float(np.float32(x + 1e-4 * rng.normal())) for x in copy]) for i in range(200)]  # near copies
    rows += [(9000, None), (9010, []), (9020, [0.0] * 16), (9030, [float("nan")] + [1.0] * 15), (9040, [None] + [1.0] * 15),
             (9050, [float("inf")] + [1.0] * 15), (9060, [-x for x in copy])]
    assert sorted(run(spark, rows, kind, every=10), key=KEY) == sorted(brute(rows, 5, 10), key=KEY)


def test_many_blocks_and_cells(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_BYTES", 16 * 4 * 37)
    monkeypatch.setattr(neighbours, "GRID", 2)
    rows = vectors(500, 16, 8)
    assert sorted(run(spark, rows, every=4, k=3), key=KEY) == sorted(brute(rows, 3, 4), key=KEY)


@pytest.mark.parametrize("tile", [1, 5, 64])
def test_tiles_of_any_size(monkeypatch, tile):
    monkeypatch.setattr(neighbours, "QUERY_TILE", tile)
    monkeypatch.setattr(neighbours, "CANDIDATE_TILE", tile + 1)
    monkeypatch.setattr(neighbours, "PAIRS", tile)
    rows = vectors(90, 1200, 4)
    matrix = np.array([v for _, v in rows])
    search = Search(np.arange(0, 90, 9), matrix[::9], 4)
    search.against(np.arange(90), np.ones(90, bool), np.ones(90, bool), Coded(matrix))
    got = {}
    for _, q, c, s in search.found():
        got.setdefault(q, []).append((-s, c))
    cosine = matrix @ matrix.T / np.outer(np.linalg.norm(matrix, axis=1), np.linalg.norm(matrix, axis=1))
    for q, near in got.items():
        assert [c for _, c in sorted(near)] == [c for c in np.argsort(-cosine[q], kind="stable") if c != q][:4]


def test_bounds_hold():
    matrix = np.array([v for _, v in vectors(300, 64, 6)]) * np.logspace(-200, 150, 300)[:, None]
    coded = Coded(matrix)
    unit = coded.rows / coded.norm[:, None]
    product = neighbours._products(coded.codes, coded.codes) * np.outer(coded.scale, coded.scale)
    error = (np.outer(coded.rest, coded.length) + np.outer(coded.length, coded.rest) + np.outer(coded.rest, coded.rest))
    assert (np.abs(unit @ unit.T - product) <= error + neighbours.SLACK).all() and error.max() < .05


def test_empty_and_lonely(spark):
    assert run(spark, [(0, [1.0, 2.0])]) == [] and run(spark, [(1, [1.0, 2.0]), (3, None)]) == []
    assert run(spark, [(0, [3.0, 4.0]), (1, [4.0, 3.0]), (2, None)]) == [(0, 1, 1, 24 / 25)]


def test_query_equals_its_sql(spark):
    db = duckdb.connect()
    db.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    want = db.execute(ORACLES["op13_nearest_neighbours"]).fetchall()
    got = QUERIES["op13_nearest_neighbours"](spark, SF).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(want) and want
