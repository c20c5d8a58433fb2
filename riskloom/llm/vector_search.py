"""Nearest neighbours by a block matrix join with int8 product tiles.

Vectors are packed into blocks; each block of queries meets each block of candidates once, in an equi-join on the number of the
candidates' group.  A tile multiplies int8 roundings of both sides (exact in float32 up to 1,040 dimensions, else
in float64).  With x = s q + e, |<x, y> - s_x s_y <q_x, q_y>| <= |x| |e_y| + |e_x| |s_y q_y| bounds the error, so a pair
whose upper bound is below the k-th largest lower bound cannot be among the k nearest.  The surviving pairs are
recomputed in double precision and kept in a heap per query, which a task carries from tile to tile; the heaps of all
tasks are merged at the end.  The result is exact.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and rows with a null id, take no
part; a query meets vectors of its own dimension only; rows of its own id are no candidates; repeated ids are candidates each, and queries that share an id one list;
ties go to the smaller id; fewer candidates than k give all; empty tables give no rows; other columns don't matter.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import read

K = 20
#: Rows of a block of queries and of candidates, candidate blocks in a group, and query rows handled at a time.
QUERY_BLOCK, BLOCK, GROUP, STRIP = 1024, 4096, 4, 128
#: Query blocks whose heaps a task holds before it hands them on.
HELD = 32


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(~bad & F.exists("v", lambda x: x != 0))


def blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """``(dim, block, n, ids, data)``: up to ``size`` vectors of one dimension in each row, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        open_: dict[int, list] = {}

        def pack(dim: int) -> pa.RecordBatch:
            nonlocal number
            ids, data = zip(*open_.pop(dim), strict=True)
            cols = [[dim], [number], [len(ids)], [np.array(ids, dtype="<i8").tobytes()], [np.array(data, dtype="<f8").tobytes()]]
            number += 1
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["dim", "block", "n", "ids", "data"])

        for b in batches:
            for i, v in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                x = v.values.to_numpy(zero_copy_only=False)
                open_.setdefault(len(x), []).append((i, x))
                if len(open_[len(x)]) >= size:
                    yield pack(len(x))
        for dim in sorted(open_):
            yield pack(dim)

    return rows.mapInArrow(run, "dim int, block long, n int, ids binary, data binary").select(*[F.col(c).alias(f"{name}_{c}") for c in ("dim", "block", "n", "ids", "data")])


class Rounded:
    """Int8 roundings of a block's rows with what the error bound needs."""

    def __init__(self, data: np.ndarray):
        self.data = data
        self.scale = np.abs(data).max(axis=1) / 127
        self.scale[self.scale == 0] = 1  # a row so small that the scale vanishes: its rounding is 0, its error is itself
        q = np.clip(np.rint(data / self.scale[:, None]), -127, 127)
        self.q = q.astype(np.float32 if 127 * 127 * data.shape[1] < 1 << 24 else np.float64)
        rest = q * self.scale[:, None]
        # Norms in units of the scale: squares of very small components would vanish.
        units = ((x / self.scale[:, None]) ** 2 for x in (data, rest, data - rest))
        self.size, self.rounded, self.error = (np.sqrt(u.sum(axis=1)) * self.scale for u in units)


def products(rows: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each summed in the order of the components whatever the block."""
    return np.cumsum(rows * one, axis=1)[:, -1]


def tile(q_ids: np.ndarray, q: Rounded, c_ids: np.ndarray, c: Rounded, heaps: list[list], k: int) -> None:
    """Bring the heaps of a block of queries up to date with a block of candidates."""
    for s in range(0, len(q_ids), STRIP):
        part = slice(s, s + STRIP)
        near = (q.q[part] @ c.q.T).astype(np.float64) * q.scale[part][:, None] * c.scale
        slack = q.size[part][:, None] * c.error + q.error[part][:, None] * c.rounded + 1e-9 * q.size[part][:, None] * c.size
        own = q_ids[part][:, None] == c_ids
        low = np.where(own, -np.inf, near - slack)
        floor = np.partition(low, -k, axis=1)[:, -k] if len(c_ids) >= k else np.full(len(low), -np.inf)
        held = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps[part]])
        alive = (near + slack >= np.maximum(floor, held)[:, None]) & ~own
        for i in np.nonzero(alive.any(axis=1))[0]:
            at = np.nonzero(alive[i])[0]
            scores, ids = products(c.data[at], q.data[s + i]), c_ids[at]
            best = np.lexsort((ids, -scores))[:k]
            heap = heaps[s + i]
            for score, one in zip(scores[best].tolist(), ids[best].tolist(), strict=True):
                if len(heap) < k:
                    heapq.heappush(heap, (score, -one))
                elif (score, -one) > heap[0]:
                    heapq.heapreplace(heap, (score, -one))
                else:
                    break


def nearest(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)`` of the k largest inner products of each query."""
    total = vectors.count()
    groups = max(1, -(-total // (BLOCK * GROUP)))
    rows = usable(vectors, id_col, vec_col)
    asked = blocks(usable(vectors.where(is_query), id_col, vec_col), QUERY_BLOCK, "q")
    known = blocks(rows, BLOCK, "c").withColumn("g", F.pmod(F.xxhash64("c_block"), F.lit(groups)))
    asked = asked.withColumn("g", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    tiles = known.join(asked, (known["g"] == asked["g"]) & (known["c_dim"] == asked["q_dim"])).select("q_block", "q_dim", "q_ids", "q_data", "c_block", "c_ids", "c_data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}
        last: tuple = (None, None, None)

        def out(ids: np.ndarray, heaps: list[list]) -> pa.RecordBatch:
            found = [(int(i), -n, s) for i, h in zip(ids, heaps, strict=True) for s, n in h]
            cols = zip(*found, strict=True) if found else ([], [], [])
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["query_id", "vec_id", "score"])

        for b in batches:
            for r in (one for i in range(b.num_rows) for one in b.slice(i, 1).to_pylist()):
                dim = r["q_dim"]
                if last[0] != r["c_block"]:
                    last = (r["c_block"], np.frombuffer(r["c_ids"], dtype="<i8"), Rounded(np.frombuffer(r["c_data"], dtype="<f8").reshape(-1, dim)))
                if r["q_block"] not in held:
                    if len(held) >= HELD:
                        ids, _, heaps = held.pop(next(iter(held)))
                        yield out(ids, heaps)
                    ids = np.frombuffer(r["q_ids"], dtype="<i8")
                    held[r["q_block"]] = (ids, Rounded(np.frombuffer(r["q_data"], dtype="<f8").reshape(-1, dim)), [[] for _ in ids])
                ids, q, heaps = held[r["q_block"]]
                tile(ids, q, last[1], last[2], heaps, k)
        for ids, _, heaps in held.values():
            yield out(ids, heaps)

    found = tiles.mapInArrow(run, "query_id long, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


SQL = """
with v as (
  select vec_id, embedding::double[] as e from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0
),
s as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e) as score from v q join v c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id and len(q.e) = len(c.e)),
r as (select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score from s)
select query_id, rank, vec_id, score from r where rank <= 20
"""

QUERIES = {"op4_vector_search": query}
ORACLE = {"op4_vector_search": SQL}
