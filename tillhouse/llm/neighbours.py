"""Nearest neighbours by cosine: a block matrix join of queries and candidates.

Vectors of one length are packed into blocks of a fixed number of bytes, and blocks into a grid; a cell of the grid
multiplies its queries with its candidates tile by tile. Tiles are products of 8-bit codes. What a code leaves of its
vector is known, so each product bounds the cosine from both sides, and only pairs that can still be among the nearest
are computed from the original vectors. A heap per query takes them from tile to tile; what the cells of a query found
is merged at the end. No pair that can matter is left out, so the result is the exact one.

Of rows with equal vectors no query needs more than its number of neighbours and one for itself, those of the smallest
ids; the rest leave before the join.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.llm.common import numbered, stored

NEAREST = 5
EVERY = 50
# Bytes of vectors in a block, and blocks of either side in a cell of the grid.
BLOCK_BYTES = 4 << 20
GRID = 8
# Rows of either side in a product tile, and pairs that are computed from original vectors at once.
QUERY_TILE, CANDIDATE_TILE = 1024, 4096
PAIRS = 1 << 16
CODES = 127
# Products of codes are exact in single precision for so many components.
EXACT = (1 << 24) // CODES ** 2
# Covers the rounding of double precision in bounds.
SLACK = 1e-9


class Coded:
    """Vectors of a block in double precision, their codes, and how far a code is from its vector."""

    def __init__(self, vectors: np.ndarray):
        wide = vectors.astype(np.float64)
        # by powers of two, which changes no digit of a cosine but keeps squares in range
        self.rows = np.ldexp(wide, -np.frexp(np.abs(wide).max(axis=1))[1][:, None])
        self.columns = np.ascontiguousarray(self.rows.T)
        self.norm = np.sqrt(_dots(self.columns, self.columns))
        unit = self.rows / self.norm[:, None]
        self.scale = np.abs(unit).max(axis=1) / CODES
        self.codes = np.rint(unit / self.scale[:, None]).astype(np.int8)
        near = self.codes * self.scale[:, None]
        self.rest = np.sqrt(((unit - near) ** 2).sum(axis=1))
        self.length = np.sqrt((near ** 2).sum(axis=1))


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of columns, component after component, so that equal vectors give equal digits wherever they lie."""
    total = a[0] * b[0]
    for x, y in zip(a[1:], b[1:], strict=True):
        total += x * y
    return total


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of codes, as doubles."""
    total = np.zeros((len(a), len(b)))
    for start in range(0, a.shape[1], EXACT):
        total += a[:, start:start + EXACT].astype(np.float32) @ b[:, start:start + EXACT].astype(np.float32).T
    return total


class Search:
    """The nearest candidates of a block of queries so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.coded, self.k = ids, Coded(vectors), k
        self.heaps: list[list[tuple[float, int, int]]] = [[] for _ in ids]  # score, id is known, -id
        self.least = np.full(len(ids), -np.inf)  # score below which nothing enters a heap

    def against(self, ids: np.ndarray, known: np.ndarray, first: np.ndarray, coded: Coded) -> None:
        """Candidates: ids, where they are known, and which row is the first of its id and vector."""
        for c in range(0, len(ids), CANDIDATE_TILE):
            for q in range(0, len(self.ids), QUERY_TILE):
                self._tile(slice(q, q + QUERY_TILE), slice(c, c + CANDIDATE_TILE), ids, known, first, coded)

    def _tile(self, q: slice, c: slice, ids, known, first, them: Coded) -> None:
        mine = self.coded
        product = _products(mine.codes[q], them.codes[c])
        product *= mine.scale[q][:, None]
        product *= them.scale[c][None, :]
        rest, length = them.rest[c].max(), them.length[c].max()
        error = mine.rest[q] * length + mine.length[q] * rest + mine.rest[q] * rest + SLACK
        least = self.least[q]
        others = product.shape[1] - 1 - self.k  # one of the candidates may be the query's own row
        if others >= 0 and np.isinf(least).any():
            least = np.maximum(least, np.partition(product, others, axis=1)[:, others] - error)
        i, j = np.nonzero(product >= (least - error)[:, None])
        i, j = i + q.start, j + c.start
        for at in range(0, len(i), PAIRS):
            self._take(i[at:at + PAIRS], j[at:at + PAIRS], ids, known, first, them)

    def _take(self, i, j, ids, known, first, them: Coded) -> None:
        mine = self.coded
        own = np.flatnonzero(known[j] & first[j] & (self.ids[i] == ids[j]))
        own = own[(mine.rows[i[own]] == them.rows[j[own]]).all(axis=1)]
        i, j = np.delete(i, own), np.delete(j, own)
        score = _dots(mine.columns[:, i], them.columns[:, j]) / (mine.norm[i] * them.norm[j])
        enters = score >= self.least[i]
        i, j, score = i[enters], j[enters], score[enters]
        order = np.lexsort((ids[j], ~known[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        nth = np.arange(len(i)) - np.searchsorted(i, i)
        for q, c, s in zip(i[nth < self.k].tolist(), j[nth < self.k].tolist(), score[nth < self.k].tolist(), strict=True):
            entry = (s, 1, -int(ids[c])) if known[c] else (s, 0, 0)
            if len(self.heaps[q]) < self.k:
                heapq.heappush(self.heaps[q], entry)
            else:
                heapq.heappushpop(self.heaps[q], entry)
            if len(self.heaps[q]) == self.k:
                self.least[q] = self.heaps[q][0][0]

    def found(self) -> Iterator[tuple[int, int, int | None, float]]:
        """(place in the block, query's id, neighbour's id, score)."""
        for at, heap in enumerate(self.heaps):
            for score, known, negative in heap:
                yield at, int(self.ids[at]), -negative if known else None, score


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, vector, dims) of the rows that take part; components stay single where they are single."""
    element = vectors.schema[vector].dataType.elementType
    kind = "float" if isinstance(element, T.FloatType) else "double"
    v = F.col("vector")
    whole = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast(f"array<{kind}>").alias("vector"))
            .where(v.isNotNull() & (F.size(v) > 0)).where(whole & F.exists(v, lambda x: x != 0))
            .withColumn("dims", F.size(v)))


def without_needless_copies(rows: DataFrame, k: int) -> DataFrame:
    """The k + 1 smallest ids of each vector, and which row is the first of its id and vector."""
    of_vector = Window.partitionBy("vector").orderBy(F.col("vec_id").asc_nulls_last())
    kept = rows.withColumn("nth", F.row_number().over(of_vector)).where(F.col("nth") <= k + 1)
    before = F.lag(F.struct("vec_id")).over(of_vector)
    return kept.withColumn("first", ~before.eqNullSafe(F.struct("vec_id"))).drop("nth")


def packed(rows: DataFrame, label: str) -> DataFrame:
    """One row per block: dims, block, ids, first, vectors (bytes, row after row). Rows have dims, vec_id, first, vector."""
    single = isinstance(rows.schema["vector"].dataType.elementType, T.FloatType)
    width = 4 if single else 8
    per_block = F.greatest(F.lit(1), F.floor(F.lit(BLOCK_BYTES) / (F.col("dims") * width)))
    dealt = numbered(stored(rows, f"{label}-rows"), ["dims"], "no").withColumn("block", F.floor(F.col("no") / per_block))
    schema = "dims int, block long, ids array<long>, first array<boolean>, vectors binary"

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("no")
        flat = table.column("vector").combine_chunks().flatten().to_numpy()
        lists = [pa.array([table.column(n).to_pylist()], pa.list_(t)) for n, t in (("vec_id", pa.int64()), ("first", pa.bool_()))]
        return pa.table([table.column("dims").slice(0, 1), table.column("block").slice(0, 1), *lists,
                         pa.array([flat.tobytes()], pa.binary())], names=["dims", "block", "ids", "first", "vectors"])

    return stored(dealt.groupBy("dims", "block").applyInArrow(pack, schema), label)


def nearest(vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", k: int = NEAREST,
            every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of every row whose id is a multiple of `every`.

    Ids are whole numbers. Vectors that are null, empty, zero, or hold null or non-finite components take no part, as
    queries or candidates. Only vectors of one length are compared. Repeated rows are rows of their own: each is a
    query, and the others are its candidates. A null id is no query; as a candidate it comes last among ties. A query
    without candidates gives no row, nor does an empty table. Other columns are ignored.
    """
    rows = usable(vectors, vec_id, vector)
    single = isinstance(rows.schema["vector"].dataType.elementType, T.FloatType)
    candidates = packed(without_needless_copies(rows, k), "near-candidates")
    queries = packed(rows.where(F.col("vec_id") % every == 0).withColumn("first", F.lit(True)), "near-queries")
    # how many cells the grid of each length has on either side
    sides = [blocks.groupBy("dims").agg(F.floor(F.max("block") / GRID).alias(n))
             for blocks, n in ((queries, "last_q"), (candidates, "last_c"))]
    grid = stored(sides[0].join(sides[1], "dims"), "near-grid")
    other = lambda last: F.explode(F.sequence(F.lit(0).cast("long"), F.col(last)))
    own = F.floor(F.col("block") / GRID)
    left = queries.join(grid, "dims").select("dims", own.alias("q"), other("last_c").alias("c"), "block", "ids", "vectors")
    right = (candidates.join(grid, "dims").withColumn("cell_q", other("last_q"))
             .select(F.col("dims").alias("cell_dims"), "cell_q", own.alias("cell_c"), "block", "ids", "first", "vectors"))
    schema = "dims int, block long, place int, query_id long, vec_id long, score double"

    def read(data, dims: int) -> np.ndarray:
        return np.frombuffer(data.as_py(), np.float32 if single else np.float64).reshape(-1, dims)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            dims = left.column("dims")[0].as_py()
            blocks = left.column("block").to_pylist()
            searches = [Search(np.array(ids.as_py(), np.int64), read(data, dims), k)
                        for ids, data in zip(left.column("ids"), left.column("vectors"), strict=True)]
            for ids, first, data in zip(*(right.column(n) for n in ("ids", "first", "vectors")), strict=True):
                coded = Coded(read(data, dims))
                known = ids.values.is_valid().to_numpy(zero_copy_only=False)
                for s in searches:
                    s.against(ids.values.fill_null(0).to_numpy(), known,
                              first.values.to_numpy(zero_copy_only=False), coded)
            out = [(dims, block, *r) for block, s in zip(blocks, searches, strict=True) for r in s.found()]
        columns = list(zip(*out, strict=True)) or [[]] * 6
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                        names=["dims", "block", "place", "query_id", "vec_id", "score"])

    found = (left.groupBy("dims", "q", "c").cogroup(right.groupBy("cell_dims", "cell_q", "cell_c"))
             .applyInArrow(search, schema))
    of_query = Window.partitionBy("dims", "block", "place").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(of_query)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
