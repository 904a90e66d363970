"""Approximate nearest neighbours by block matrix join (operator 4).

Vectors are packed into blocks of int8 with a scale, a norm and the norm of
the quantisation error each. Every block of queries meets every block of rows
in one tile: the int8 product gives each pair's inner product up to a bound
that the error norms prove. Only pairs whose upper bound reaches the query's
k-th largest lower bound in the tile, and the worst of its heap, survive; they
are computed from the original vectors, in double precision, and enter the
query's heap of k. Heaps are carried from tile to tile of a task and merged
over the tasks at last. The bounds hold, so nothing near is lost.

Equal vectors can tie without limit: of each distinct vector the k+1 smallest
ids are enough for any query's k nearest, so only they enter the tiles.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeshore.llm.common import saved, ship
from lakeshore.llm.vectors import usable

BLOCK_ROWS, BLOCK_QUERIES = 4096, 1024
TILES_PER_TASK = 4
# Queries of a tile worked on together, pairs recomputed together, and query
# blocks whose heaps a task holds before it hands them on.
TILE_QUERIES, PAIRS, HELD_BLOCKS = 128, 1 << 14, 16

BLOCK_SCHEMA = ("block long, dim int, ids binary, hashes binary, codes binary, scales binary, norms binary, "
                "errors binary, vectors binary")


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of up to ``size`` vectors of one dimension, quantised to int8."""
    names = [c.split()[0] for c in BLOCK_SCHEMA.split(", ")]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        block = TaskContext.get().partitionId() << 32
        held: dict[int, list[tuple[int, int, np.ndarray]]] = {}

        def full(dim: int) -> pa.RecordBatch:
            nonlocal block
            ids, hashes, vectors = zip(*held.pop(dim), strict=True)
            x = np.stack(vectors).astype(np.float64)
            scale = np.abs(x).max(axis=1) / 127
            codes = np.rint(x / scale[:, None])
            near = codes * scale[:, None]
            block += 1
            values = [block - 1, dim, np.array(ids, "<i8"), np.array(hashes, "<i8"), codes.astype(np.int8), scale,
                      np.linalg.norm(x, axis=1), np.linalg.norm(x - near, axis=1), x]
            return pa.RecordBatch.from_arrays(
                [pa.array([values[0]], pa.int64()), pa.array([dim], pa.int32()),
                 *(pa.array([v.tobytes()], pa.binary()) for v in values[2:])], names)

        for b in batches:
            vectors = b.column("embedding")
            for i, (vec_id, h) in enumerate(zip(b.column("vec_id").to_pylist(), b.column("vec_hash").to_pylist(),
                                                strict=True)):
                x = vectors[i].values.to_numpy()
                own = held.setdefault(len(x), [])
                own.append((vec_id, h, x))
                if len(own) == size:
                    yield full(len(x))
        for dim in list(held):
            yield full(dim)

    return rows.select("vec_id", "vec_hash", "embedding").mapInArrow(pack, BLOCK_SCHEMA)


def _tile_heaps(tiles: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query over the tiles of a task."""
    def arrays(b: pa.RecordBatch, i: int, side: str):
        get = lambda name, kind: np.frombuffer(b.column(side + name)[i].as_buffer(), kind)
        dim = b.column("dim")[i].as_py()
        return (get("ids", "<i8"), get("codes", np.int8).reshape(-1, dim), get("scales", np.float64),
                get("norms", np.float64), get("errors", np.float64), get("vectors", np.float64).reshape(-1, dim))

    def exact(x: np.ndarray, y: np.ndarray, q: np.ndarray, r: np.ndarray) -> np.ndarray:
        # Row sums: equal vectors get equal scores wherever they stand.
        parts = [(x[q[i:i + PAIRS]] * y[r[i:i + PAIRS]]).sum(axis=1) for i in range(0, len(q), PAIRS)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray, list[list[tuple[float, int]]]]] = {}

        def hand_on() -> pa.RecordBatch:
            rows = [(q, h, -v, s) for ids, hashes, heaps in held.values()
                    for q, h, heap in zip(ids.tolist(), hashes.tolist(), heaps, strict=True) for s, v in heap]
            held.clear()
            columns = list(zip(*rows, strict=True)) or [()] * 4
            types = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                              ["query_id", "query_hash", "vec_id", "score"])

        for b in batches:
            for i in range(b.num_rows):
                block = b.column("q_block")[i].as_py()
                q_ids, q_codes, q_scale, q_norm, q_error, q_vectors = arrays(b, i, "q_")
                ids, codes, scale, norm, error, vectors = arrays(b, i, "r_")
                if block not in held:
                    if len(held) == HELD_BLOCKS:
                        yield hand_on()
                    hashes = np.frombuffer(b.column("q_hashes")[i].as_buffer(), "<i8")
                    held[block] = (q_ids, hashes, [[] for _ in q_ids])
                heaps = held[block][2]
                # Sums of int8 products are whole numbers that this type holds exactly.
                kind = np.float32 if codes.shape[1] * 127 * 127 < 1 << 24 else np.float64
                rows = codes.astype(kind).T
                for lo in range(0, len(q_ids), TILE_QUERIES):
                    at = slice(lo, lo + TILE_QUERIES)
                    near = (q_codes[at].astype(kind) @ rows).astype(np.float64) * q_scale[at, None] * scale
                    slack = (q_norm[at] + q_error[at])[:, None] * error + q_error[at, None] * norm
                    slack += 1e-9 * q_norm[at, None] * norm
                    own = q_ids[at, None] == ids
                    worst = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps[at]])
                    if len(ids) > k:
                        lower = np.where(own, -np.inf, near - slack)
                        worst = np.maximum(worst, np.partition(lower, -k, axis=1)[:, -k])
                    q, r = np.nonzero(~own & (near + slack >= worst[:, None]))
                    scores = exact(q_vectors[at], vectors, q, r)
                    for j, v, s in zip((q + lo).tolist(), ids[r].tolist(), scores.tolist(), strict=True):
                        if len(heaps[j]) < k:
                            heapq.heappush(heaps[j], (s, -v))
                        elif (s, -v) > heaps[j][0]:
                            heapq.heapreplace(heaps[j], (s, -v))
        if held:
            yield hand_on()

    return tiles.mapInArrow(run, "query_id long, query_hash long, vec_id long, score double")


def nearest(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """Each query's ``k`` nearest rows by largest inner product, itself not
    counted: query_id, rank (from 1), vec_id, score (double, on the original
    vectors), ties to the smaller vec_id. ``is_query``: a condition on vec_id.

    Columns vec_id and embedding are read. Vectors that are null, zero, empty
    or hold null or non-finite components and rows without vec_id take no part,
    as query or candidate. Only vectors of one length meet. A row that is
    repeated (same id and vector) counts once; another vector under the query's
    own id is not a candidate. Fewer than k candidates: all of them. An empty
    table or no query gives no rows.
    """
    ship(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    rows = saved(rows.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).distinct()
                 .withColumn("vec_hash", F.xxhash64("embedding")), "vectors")
    copies = Window.partitionBy("embedding").orderBy("vec_id")
    pool = rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).drop("copy")
    row_blocks = saved(_blocks(pool, BLOCK_ROWS), "row-blocks")
    query_blocks = saved(_blocks(rows.where(is_query), BLOCK_QUERIES), "query-blocks")
    groups = max(1, query_blocks.count())
    salts = max(1, -(-rows.count() // (BLOCK_ROWS * TILES_PER_TASK)))

    fields = [c.split()[0] for c in BLOCK_SCHEMA.split(", ")][2:]
    left = (query_blocks.select(F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int").alias("group"), "dim",
                                F.col("block").alias("q_block"), *(F.col(f).alias("q_" + f) for f in fields))
            .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
    # Each row block goes once to every group of query blocks, under its own salt.
    right = (row_blocks.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int"))
             .select("salt", "dim", *(F.col(f).alias("r_" + f) for f in fields),
                     F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")))
    best = _tile_heaps(left.join(right, ["group", "salt", "dim"]).drop("group", "salt"), k)
    order = Window.partitionBy("query_id", "query_hash").orderBy(F.col("score").desc(), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
