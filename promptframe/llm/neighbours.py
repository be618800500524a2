"""Nearest neighbours of stated queries by a block matrix join.

Queries and candidates are dealt into blocks by a hash of their id, and each
pair of blocks is one tile. In a tile the unit vectors are rounded to int8 with
one scale a vector; the integer products give every cosine up to the sum of the
two rounding errors, which are known exactly. A pair survives if its upper
bound reaches the k-th largest lower bound of its query. Survivors are computed
again in double precision from the original vectors and kept in a heap a query;
the heaps of a query's tiles are merged. No pair is left out that could be
among the k nearest, so recall is 1.

Of equal vectors only the ``k + 1`` smallest ids can be among the nearest of
any query, so only these become candidates, however many copies there are.

Vectors that are null, empty, zero, or hold null or non-finite components, and
rows with a null id, take no part. Vectors are compared with vectors of their
own length. Rows that repeat an id stand for one vector, the smallest. Equal
cosines go to the smaller id. With fewer than k candidates all are returned; an
empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from promptframe.scratch import Scratch

# Rows of a block; a tile holds one block of each kind.
QUERY_ROWS, CANDIDATE_ROWS = 4096, 16_384
# Candidates of a tile that are multiplied at once.
STRIP = 2048
OUT = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``id, v`` of the vectors that take part."""
    v = F.col(vector).cast("array<double>")
    clean = vectors.select(F.col(vec_id).cast("long").alias("id"), v.alias("v")).filter("id IS NOT NULL AND size(v) > 0")
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall("v", lambda x: x == 0.0)
    return clean.filter(~odd).filter(~zero).groupBy("id").agg(F.min("v").alias("v"))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The cosine of each row of ``a`` with that row of ``b``, summed from the first component on."""
    if len(a) and not 1e-70 < min(np.abs(a).max(axis=1).min(), np.abs(b).max(axis=1).min()) <= max(np.abs(a).max(), np.abs(b).max()) < 1e70:
        # Squares would leave the range of doubles; a power of two changes no digit.
        a, b = (np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1]) for x in (a, b))
    dot, aa, bb = np.zeros(len(a)), np.zeros(len(a)), np.zeros(len(a))
    for k in range(a.shape[1]):
        dot += a[:, k] * b[:, k]
        aa += a[:, k] * a[:, k]
        bb += b[:, k] * b[:, k]
    return np.clip(dot / np.sqrt(aa * bb), -1.0, 1.0)


def rounded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Int8 values, scale, and an upper bound of the rounding error, of each unit vector."""
    unit = x / np.abs(x).max(axis=1, keepdims=True)
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    scale = np.abs(unit).max(axis=1) / 127
    whole = np.rint(unit / scale[:, None]).astype(np.int8)
    error = unit - whole * scale[:, None]
    return whole, scale, np.sqrt((error * error).sum(axis=1)) + 1e-12


def tile(query_ids, queries, ids, candidates, k: int) -> list[tuple[int, int, float]]:
    """The k best candidates of each query in the tile."""
    # Sums of fewer than 1,024 products of int8 are exact in single precision.
    kind = np.float32 if queries.shape[1] < 1024 else np.float64
    q8, q_scale, q_error = rounded(queries)
    c8, c_scale, c_error = rounded(candidates)
    q8 = q8.astype(kind)
    floor = np.full((len(query_ids), k), -np.inf)  # the k largest lower bounds so far
    heaps: list[list[tuple[float, int]]] = [[] for _ in query_ids]
    for at in range(0, len(ids), STRIP):
        part = slice(at, at + STRIP)
        near = (q8 @ c8[part].astype(kind).T) * (q_scale[:, None] * c_scale[part])
        slack = c_error[part] + q_error[:, None] * (1 + c_error[part]) + 1e-9
        own = query_ids[:, None] == ids[part]
        lower = np.where(own, -np.inf, near - slack)
        both = np.concatenate([floor, lower], axis=1)
        floor = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
        rows, columns = np.nonzero((near + slack >= floor.min(axis=1)[:, None]) & ~own)
        exact = cosines(queries[rows], candidates[part][columns])
        for row, one, score in zip(rows.tolist(), ids[part][columns].tolist(), exact.tolist()):
            entry, heap = (score, -one), heaps[row]
            if len(heap) < k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
    return [(q, -one, score) for q, heap in zip(query_ids.tolist(), heaps) for score, one in heap]


def nearest(
    scratch: Scratch,
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``; ``is_query`` is a condition on the column ``id``."""
    clean = scratch.store(usable(vectors, vec_id, vector).withColumn("dim", F.size("v")), "vectors")
    same = Window.partitionBy("v").orderBy("id")
    some = clean.withColumn("copy", F.row_number().over(same)).filter(F.col("copy") <= k + 1).drop("copy")
    asked = clean.filter(is_query)
    strips = max(1, -(-clean.count() // CANDIDATE_ROWS))
    blocks = max(1, -(-asked.count() // QUERY_ROWS))

    def dealt(df: DataFrame, own: str, own_blocks: int, other: str, other_blocks: int) -> DataFrame:
        """Each row in its block, once for every block of the other kind."""
        every = F.explode(F.sequence(F.lit(0), F.lit(other_blocks - 1)))
        # Named anew: both kinds come from one table, whose columns the cogroup would take for one side's.
        named = [F.col(c).alias(f"{own}_{c}") for c in ("id", "v", "dim")]
        return df.select(*named, F.pmod(F.xxhash64("id"), F.lit(own_blocks)).cast("int").alias(own), every.alias(other))

    def arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids = table.column(0).to_numpy()
        flat = table.column(1).combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return ids, flat.reshape(len(ids), -1)

    names = [("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]

    def multiply(left: pa.Table, right: pa.Table) -> pa.Table:
        found = tile(*arrays(left), *arrays(right), k) if len(left) and len(right) else []
        return pa.Table.from_pylist([dict(zip(("query_id", "vec_id", "score"), x)) for x in found], schema=pa.schema(names))

    found = (
        dealt(asked, "block", blocks, "strip", strips)
        .groupBy("block_dim", "block", "strip")
        .cogroup(dealt(some, "strip", strips, "block", blocks).groupBy("strip_dim", "block", "strip"))
        .applyInArrow(multiply, OUT)
    )

    def merge(table: pa.Table) -> pa.Table:
        rows = zip(*[table.column(c).to_pylist() for c in ("query_id", "vec_id", "score")])
        best = heapq.nsmallest(k, ((-score, one, query) for query, one, score in rows))
        out = [{"query_id": q, "rank": r, "vec_id": one, "score": -s} for r, (s, one, q) in enumerate(best, 1)]
        return pa.Table.from_pylist(out, schema=pa.schema([names[0], ("rank", pa.int32()), *names[1:]]))

    return found.groupBy("query_id").applyInArrow(merge, "query_id long, rank int, vec_id long, score double")
