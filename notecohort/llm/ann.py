"""Nearest neighbours by a block matrix join with int8 product tiles (operator 7).

Queries and candidates are dealt into blocks, and every pair of a query block and a
candidate block is one tile, compared in one task.  In a tile both sides are unit vectors
quantised to int8 with a scale per row.  The product of two quantised rows is exact, and
what quantising took away bounds its distance from the true cosine:
``|q.c - q'.c'| <= |q - q'| |c| + |q'| |c - c'|``.  A candidate stays when its upper bound
reaches the k-th largest lower bound of its query in the tile; survivors are scored anew in
double precision on the original vectors.  Each tile hands on a heap of k per query, and
heaps are merged per query.  The result is exact; no index is trained.

Scale: block counts follow from the row counts, so a tile's size is fixed, and blocks are
dealt by row number, so equal ids or vectors do not meet in one block.  A tile moves
``query_block + candidate_block`` rows for their product of comparisons.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components,
and rows with a null vec_id, take no part; vectors are compared with those of their own
length; of repeated rows each is a row, so a query's copy is its candidate; extra columns
are ignored; a query without any candidate gives no row; an empty table gives none.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import matrix, runs, saved, shuffle_partitions, usable

QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 16384
#: Query rows whose products with a candidate block are in memory at once.
STRIP = 128
#: Covers the rounding of the bounds themselves.
SLACK = 1e-9

_FOUND = pa.schema([("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, the norms of the quantised rows, and what was lost."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    back = codes * scale[:, None]
    return codes, scale, np.linalg.norm(back, axis=1), np.linalg.norm(unit - back, axis=1)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of row i of a with row i of b, in double precision."""
    dot, aa, bb = (np.einsum("ij,ij->i", x, y) for x, y in ((a, b), (a, a), (b, b)))
    return dot / (np.sqrt(aa) * np.sqrt(bb))


def tile(q_rows, q_ids, q, c_rows, c_ids, c, k: int) -> tuple[list[int], list[int], list[int], list[float]]:
    """The k best candidates of every query of a tile: query row, query id, candidate id, score."""
    q8, qs, qn, qe = quantise(q / np.linalg.norm(q, axis=1, keepdims=True))
    c8, cs, _, ce = quantise(c / np.linalg.norm(c, axis=1, keepdims=True))
    # float32 holds every integer of these sums exactly up to 2 ** 24
    kind = np.float32 if q.shape[1] * 127 * 127 < 1 << 24 else np.float64
    right, out = c8.T.astype(kind), ([], [], [], [])
    for lo in range(0, len(q), STRIP):
        s = slice(lo, lo + STRIP)
        product = (q8[s].astype(kind) @ right).astype(np.float64)
        product *= qs[s, None] * cs
        bound = qe[s, None] + qn[s, None] * ce + SLACK
        product[q_rows[s, None] == c_rows[None, :]] = -np.inf
        low = product - bound
        n = min(k, low.shape[1])
        least = np.partition(low, low.shape[1] - n, axis=1)[:, low.shape[1] - n]
        i, j = np.nonzero((product + bound >= least[:, None]) & (product > -np.inf))
        score = cosines(q[lo + i], c[j])
        for at, end in _stretches(i):
            best = heapq.nsmallest(k, zip(-score[at:end], c_ids[j[at:end]], strict=True))
            row = lo + int(i[at])
            for minus, vec in best:
                for x, y in zip(out, (int(q_rows[row]), int(q_ids[row]), int(vec), float(-minus)), strict=True):
                    x.append(y)
    return out


def _stretches(i: np.ndarray) -> list[tuple[int, int]]:
    if not len(i):
        return []
    cuts = np.r_[0, np.nonzero(i[1:] != i[:-1])[0] + 1, len(i)].tolist()
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, vector_col: str = "embedding",
            query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows nearest to every row with ``is_query``."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(v)).select(
        F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), is_query.alias("is_query"))
    rows = saved(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    n, queries = rows.agg(F.count(F.lit(1)), F.count_if("is_query")).first()
    q_blocks, c_blocks = -(-queries // query_block) or 1, -(-n // candidate_block) or 1
    # the low bits of a row number count up within a file, the high ones name it
    place = F.col("row").bitwiseAND((1 << 33) - 1) + F.shiftright("row", 33)
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    one = rows.withColumn("dim", F.size("v")).withColumn("place", place)
    left = one.where("is_query").select(
        "dim", F.pmod(F.floor(F.col("place") / 50), F.lit(q_blocks)).cast("int").alias("qb"), every(c_blocks).alias("cb"),
        F.lit(0).alias("side"), "row", "vec_id", "v")
    right = one.select("dim", every(q_blocks).alias("qb"), F.pmod("place", F.lit(c_blocks)).cast("int").alias("cb"),
                       F.lit(1).alias("side"), "row", "vec_id", "v")

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, t in runs(batches, 3):
            side = t.column("side").to_numpy()
            cut = int(np.searchsorted(side, 1))
            if not 0 < cut < len(side):
                continue
            v = matrix(t.column("v"))
            row, ids = t.column("row").to_numpy(), t.column("vec_id").to_numpy()
            found = tile(row[:cut], ids[:cut], v[:cut], row[cut:], ids[cut:], v[cut:], k)
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(found, _FOUND, strict=True)], schema=_FOUND)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, t in runs(batches, 1):
            best = heapq.nsmallest(k, zip((-x for x in t.column("score").to_pylist()), t.column("vec_id").to_pylist(), strict=True))
            name = t.column("query_id")[0].as_py()
            yield pa.RecordBatch.from_pylist([{"query_id": name, "rank": i + 1, "vec_id": vec, "score": -s}
                                              for i, (s, vec) in enumerate(best)], _RANKED)

    parts = shuffle_partitions(vectors)
    tiled = left.unionByName(right).repartition(max(parts, q_blocks * c_blocks), "dim", "qb", "cb")
    found = tiled.sortWithinPartitions("dim", "qb", "cb", "side").mapInArrow(
        tiles, "query long, query_id long, vec_id long, score double")
    return found.repartition(parts, "query").sortWithinPartitions("query").mapInArrow(
        merge, "query_id long, rank int, vec_id long, score double")


_RANKED = pa.schema([("query_id", pa.int64()), ("rank", pa.int32()), ("vec_id", pa.int64()), ("score", pa.float64())])
