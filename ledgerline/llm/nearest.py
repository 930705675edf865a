"""Nearest neighbours by cosine: an int8 block matrix join with exact results.

Vectors are packed into blocks and written once.  Every group of query rows
meets every group of candidate blocks; both sides are replicated to a grid of
(query group, candidate group) cells, whose sizes are bounded, so a task's
memory does not grow with the table.  In a cell:

1. both sides are normalised and quantised to int8 with one scale per vector;
2. int8 product tiles give every cosine with a bound on its error, from the
   norms of the rounding residuals;
3. pairs whose upper bound reaches the query's k-th lower bound survive and
   are recomputed in double precision on the original vectors;
4. survivors go through one bounded heap per query.

The cells' heaps (k rows each) are merged per query at the end.  Because the
bounds are proven, the result is the exact one.

Defined results: a vector that is NULL, empty, all zero or holds a NULL or
non-finite component, and any row with a NULL id, takes no part; vectors of
different lengths are not compared; equal scores go to the smaller id, then
to the earlier row; repeated rows are candidates of each other; a query with
fewer candidates than k gets them all; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, written

BLOCK = 1_024           # vectors of one block, and queries of one product tile
QUERY_GROUP = 65_536    # query rows of one cell
CANDIDATE_GROUP = 64    # candidate blocks of one cell


def _usable(batch: pa.RecordBatch, kind: np.dtype) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors) of a batch's usable rows, by vector length."""
    known = pc.is_valid(batch.column(0)).to_numpy(zero_copy_only=False)
    lengths = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    for dim in np.unique(lengths[known & (lengths > 0)]):
        at = np.flatnonzero(known & (lengths == dim))
        part = batch.take(pa.array(at))
        # NULL components become NaN.
        vectors = pc.cast(part.column(1).flatten(), pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dim)
        good = np.isfinite(vectors).all(axis=1) & (vectors != 0).any(axis=1)
        yield part.column(0).to_numpy(zero_copy_only=False)[good], vectors[good].astype(kind)


def _pack(kind: np.dtype):
    """Blocks (block, dim, ids, vectors) of one task's usable vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, waiting = TaskContext.get().partitionId(), 0, {}

        def blocks(dim: int, least: int) -> Iterator[pa.RecordBatch]:
            nonlocal made
            ids, vectors = map(np.concatenate, zip(*waiting.pop(dim)))
            while len(ids) >= least:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(part << 24) + made]), pa.array([dim], pa.int32()),
                     pa.array([ids[:BLOCK].astype(np.int64).tobytes()], pa.binary()), pa.array([vectors[:BLOCK].tobytes()], pa.binary())],
                    names=["block", "dim", "ids", "vectors"])
                made += 1
                ids, vectors = ids[BLOCK:], vectors[BLOCK:]
            if len(ids):
                waiting[dim] = [(ids, vectors)]

        for batch in batches:
            for ids, vectors in _usable(batch, kind):
                if len(ids):
                    waiting.setdefault(vectors.shape[1], []).append((ids, vectors))
            for dim in [d for d, w in waiting.items() if sum(len(i) for i, _ in w) >= BLOCK]:
                yield from blocks(dim, BLOCK)
        for dim in list(waiting):
            yield from blocks(dim, 1)

    return run


def _queries(every: int, kind: np.dtype):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, dim, ids, vectors in zip(*(c.to_pylist() for c in batch.columns)):
                ids, vectors = np.frombuffer(ids, np.int64), np.frombuffer(vectors, kind).reshape(-1, dim)
                at = np.flatnonzero(ids % every == 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((block << 16) + at, pa.int64()), pa.array(np.full(len(at), dim, np.int32)), pa.array(ids[at]),
                     pa.array([v.tobytes() for v in vectors[at]], pa.binary())], names=["row", "dim", "query_id", "vector"])
    return run


class Quantised:
    """Unit vectors as int8 with one scale and one residual norm each."""

    def __init__(self, vectors: np.ndarray):
        # Exact powers of two keep squares in range and change no direction.
        self.vectors = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])
        self.norms = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        unit = self.vectors / self.norms[:, None]
        self.scale = np.abs(unit).max(axis=1) / 127
        self.codes = np.rint(unit / self.scale[:, None]).astype(np.int8)
        self.residual = np.sqrt(((unit - self.codes * self.scale[:, None]) ** 2).sum(axis=1))

    def products(self, rows: slice, other: Quantised) -> tuple[np.ndarray, np.ndarray]:
        """Approximate cosines of some rows with all of ``other``, and the most that each can be off."""
        # Products of int8 sum exactly in float32 below 2**24, else in float64.
        kind = np.float32 if self.codes.shape[1] * 127 * 127 < 1 << 24 else np.float64
        dots = self.codes[rows].astype(kind) @ other.codes.astype(kind).T
        near = dots.astype(np.float64) * self.scale[rows, None] * other.scale[None, :]
        residual = self.residual[rows, None]
        return near, residual + (1 + residual) * other.residual[None, :] + 1e-12

    def cosines(self, i: np.ndarray, other: Quantised, j: np.ndarray) -> np.ndarray:
        return (self.vectors[i] * other.vectors[j]).sum(axis=1) / (self.norms[i] * other.norms[j])


def _search_cell(k: int, kind: np.dtype):
    def run(queries: pa.Table, blocks: pa.Table) -> pa.Table:
        heaps: list[list] = [[] for _ in range(queries.num_rows)]
        query_ids = queries.column("query_id").to_pylist()
        own = np.array(queries.column("row").to_pylist(), np.int64)
        if queries.num_rows and blocks.num_rows:
            dim = queries.column("dim")[0].as_py()
            q = Quantised(np.frombuffer(b"".join(queries.column("vector").to_pylist()), kind).reshape(-1, dim).astype(np.float64))
            floor = np.full(len(own), -np.inf)  # the k-th lower bound so far
            for block, ids, vectors in zip(*(blocks.column(c).to_pylist() for c in ("block", "ids", "vectors"))):
                ids = np.frombuffer(ids, np.int64)
                c = Quantised(np.frombuffer(vectors, kind).reshape(-1, dim).astype(np.float64))
                rows = (block << 16) + np.arange(len(ids))
                for start in range(0, len(own), BLOCK):
                    tile = slice(start, start + BLOCK)
                    near, error = q.products(tile, c)
                    mine = np.flatnonzero((own[tile] >> 16) == block)
                    near[mine, own[tile][mine] & 0xFFFF] = -np.inf
                    if len(ids) >= k:
                        floor[tile] = np.maximum(floor[tile], np.partition(near - error, len(ids) - k, axis=1)[:, len(ids) - k])
                    i, j = np.nonzero((near + error >= floor[tile, None]) & np.isfinite(near))
                    for a, b, score in zip((i + start).tolist(), j.tolist(), q.cosines(i + start, c, j).tolist()):
                        heap, entry = heaps[a], (score, -int(ids[b]), -int(rows[b]))
                        if len(heap) < k:
                            heapq.heappush(heap, entry)
                        elif entry > heap[0]:
                            heapq.heapreplace(heap, entry)
                    full = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps[tile]])
                    floor[tile] = np.maximum(floor[tile], full - 1e-12)
        found = [(int(own[a]), query_ids[a], -v, s, -r) for a, h in enumerate(heaps) for s, v, r in h]
        columns = list(zip(*found)) or [()] * 5
        return pa.table([pa.array(x, t) for x, t in zip(columns, [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64()])],
                        names=["row", "query_id", "vec_id", "score", "at"])
    return run


def nearest(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest rows of every row whose id is divisible by ``every``."""
    kind = np.dtype(np.float32 if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else np.float64)
    blocks = written(map_batches(vectors.select(F.col("vec_id").cast("long"), "embedding"), _pack(kind),
                                 "block long, dim int, ids binary, vectors binary"))
    queries = written(map_batches(blocks, _queries(every, kind), "row long, dim int, query_id long, vector binary"))
    n_queries = -(-queries.count() // QUERY_GROUP) or 1
    n_cells = -(-blocks.count() // CANDIDATE_GROUP) or 1
    # Each side is sent to every group of the other: a grid of bounded cells.
    left = queries.withColumn("q", F.pmod(F.xxhash64("row"), F.lit(n_queries))).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(n_cells - 1))))
    right = blocks.withColumn("c", F.pmod(F.xxhash64("block"), F.lit(n_cells)).cast("int")).withColumn(
        "q", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_queries - 1).cast("long"))))
    found = left.groupBy("dim", "q", "c").cogroup(right.groupBy("dim", "q", "c")).applyInArrow(
        _search_cell(k, kind), "row long, query_id long, vec_id long, score double, at long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id", "at")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
