"""Vector code compression (operator 11): product quantisation in exact
integers, with LAESA pivots.

Every vector is scaled to integers and cut into parts; each part position has
a codebook of a few entries. A part's distances to a few fixed pivots are
computed once and stored beside it. In each round the pivots' distances to the
entries give lower bounds by the triangle inequality: |d(part, pivot) -
d(pivot, entry)| is never more than d(part, entry). Entries are tried in the
order of their bounds, and those whose bound lies beyond the best distance so
far are never evaluated; evaluations themselves are exact integers.

Spark holds the vectors; a round sends the codebooks (a few KB) out and brings
one exact sum per component of each entry back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshore.llm.common import drop_saved, saved, ship
from lakeshore.plans.joins import sized_broadcast

PARTS, ENTRIES, ROUNDS, PIVOTS = 8, 16, 6, 4
SCALE = 4096
# Scaled components below this keep sums of squares of a part, and errors of a
# vector of up to 2^11 components, within 64 bits.
MOST = 1 << 25


class Codebooks(NamedTuple):
    """Entries and pivots of each part position, and where the parts begin."""
    bounds: list[int]
    entries: list[np.ndarray]
    pivots: list[np.ndarray]

    def sha256(self) -> str:
        values = (str(v) for part in self.entries for v in part.ravel().tolist())
        return hashlib.sha256(",".join(values).encode()).hexdigest()


def takes_part(embedding: Column) -> Column:
    """Not null, not empty, no null or non-finite component (never null)."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(embedding) > 0) & finite, F.lit(False))


def farthest_first(entries: np.ndarray, n: int) -> np.ndarray:
    """``n`` entries that lie far from one another, beginning with the first."""
    chosen, gap = [0], None
    while len(chosen) < min(n, len(entries)):
        own = ((entries - entries[chosen[-1]]) ** 2).sum(axis=1)
        gap = own if gap is None else np.minimum(gap, own)
        chosen.append(int(gap.argmax()))
    return entries[chosen]


def pivot_distances(parts: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(((parts[:, None, :] - pivots[None]) ** 2).sum(axis=2).astype(float))


def assign(parts: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray,
           pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest entry, squared distance, evaluations) of each part, ties to
    the lower index; ``to_pivots`` as pivot_distances gives it."""
    between = pivot_distances(pivots, entries)
    low = np.zeros((len(parts), len(entries)))
    for own, far in zip(to_pivots.T, between, strict=True):
        np.maximum(low, np.abs(own[:, None] - far[None]), out=low)
    # Square roots and their difference are rounded; this is far more than that.
    low -= 1e-12 * (to_pivots.max(initial=0) + between.max(initial=0))
    np.maximum(low, 0, out=low)
    order = np.argsort(low, axis=1, kind="stable")
    nearest = np.zeros(len(parts), np.int64)
    best = np.full(len(parts), np.iinfo(np.int64).max)
    rows, evaluated = np.arange(len(parts)), 0
    for rank in range(len(entries)):
        entry = order[rows, rank]
        within = low[rows, entry] ** 2 <= best[rows]
        rows, entry = rows[within], entry[within]  # bounds rise: who is out stays out
        if not len(rows):
            break
        distance = ((parts[rows] - entries[entry]) ** 2).sum(axis=1)
        evaluated += len(rows)
        better = (distance < best[rows]) | ((distance == best[rows]) & (entry < nearest[rows]))
        best[rows[better]], nearest[rows[better]] = distance[better], entry[better]
    return nearest, best, evaluated


def scaled(vectors: np.ndarray) -> np.ndarray:
    out = np.floor(vectors * float(SCALE))
    if np.abs(out).max(initial=0) >= MOST:
        raise ValueError(f"a component of {MOST // SCALE} or more: distances would not be exact in 64 bits")
    return out.astype(np.int64)


def _rows_of(column: pa.Array, width: int, kind) -> np.ndarray:
    """A binary column of rows of equal length as a matrix."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, kind).reshape(-1, width)


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _first_codebooks(base: DataFrame, width: int, parts: int, entries: int, pivots: int) -> Codebooks:
    """Codebooks from the smallest vec_ids; of rows of one id the smallest
    vector stands for it, null counts as the largest id."""

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for b in batches:
            for vec_id, x in zip(b.column("vec_id").to_pylist(), b.column("x").to_pylist(), strict=True):
                key = (vec_id is None, vec_id or 0)
                if key in held or len(held) < entries or key < max(held):
                    held[key] = min(held.get(key, x), x)
                    if len(held) > entries:
                        del held[max(held)]
        yield pa.RecordBatch.from_pydict({
            "no_id": pa.array([k[0] for k in held], pa.bool_()), "vec_id": pa.array([k[1] for k in held], pa.int64()),
            "x": pa.array(list(held.values()), pa.list_(pa.float64()))})

    # At most ``entries`` rows of each task, then ``entries`` in all.
    first = (base.select("vec_id", "x").mapInArrow(smallest, "no_id boolean, vec_id long, x array<double>")
             .groupBy("no_id", "vec_id").agg(F.min("x").alias("x")).orderBy("no_id", "vec_id").limit(entries).collect())
    x = scaled(np.array([r["x"] for r in first], float).reshape(-1, width))
    bounds = [0, *np.cumsum([len(p) for p in np.array_split(np.arange(width), parts)]).tolist()]
    cut = [x[:, a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return Codebooks(bounds, cut, [farthest_first(c, pivots) for c in cut])


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             pivots: int = PIVOTS) -> DataFrame:
    """One row per vector that takes part: vec_id, code (two hex digits a
    part), error (squared distances to the assigned entries, summed), label_error
    (errors of all rows with that label, null being one), codebooks_sha256.

    Null, empty or partly null or non-finite vectors take no part; nor do those
    whose length differs from that of the smallest vec_id's vector. A length
    that ``parts`` doesn't divide gives longer parts first. Repeated rows count
    each; null vec_ids are coded too and come last in the first codebook. Fewer
    than ``entries`` vec_ids give as many entries. A component of 8192 or more
    raises. Empty table: no rows.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an index has two hex digits")
    spark = vectors.sparkSession
    ship(spark)
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("label"),
                          F.col("embedding").cast("array<double>").alias("x")).where(takes_part(F.col("x")))
    first = base.agg(F.min(F.struct(F.col("vec_id").isNull().alias("no_id"), "vec_id", F.size("x").alias("n")))).first()[0]
    label = T.StructField("label", base.schema["label"].dataType)
    if first is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    width = first["n"]
    base = base.where(F.size("x") == width)
    books = _first_codebooks(base, width, parts, entries, pivots)
    n_pivots = len(books.pivots[0])
    spans = list(zip(books.bounds[:-1], books.bounds[1:], strict=True))

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = scaled(_vectors(b.column("x"), width))
            far = np.concatenate([pivot_distances(x[:, i:j], p) for (i, j), p in zip(spans, books.pivots, strict=True)],
                                 axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), pa.array([r.tobytes() for r in x.astype("<i4")], pa.binary()),
                 pa.array([r.tobytes() for r in far.astype("<f8")], pa.binary())],
                ["vec_id", "label", "ints", "to_pivots"])

    schema = T.StructType([T.StructField("vec_id", T.LongType()), label, T.StructField("ints", T.BinaryType()),
                           T.StructField("to_pivots", T.BinaryType())])
    ready = saved(base.mapInArrow(prepare, schema), "vector-parts")

    def assigned(b: pa.RecordBatch, codebooks: list[np.ndarray]):
        """(part, integers, nearest, distance) of a batch, part after part."""
        x = _rows_of(b.column("ints"), width, "<i4").astype(np.int64)
        far = _rows_of(b.column("to_pivots"), parts * n_pivots, "<f8")
        for k, (i, j) in enumerate(spans):
            nearest, distance, _ = assign(x[:, i:j], far[:, k * n_pivots:(k + 1) * n_pivots], codebooks[k], books.pivots[k])
            yield k, x[:, i:j], nearest, distance

    def sums_of(codebooks: list[np.ndarray]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, counts = [np.zeros_like(c) for c in codebooks], [np.zeros(len(c), np.int64) for c in codebooks]
            for b in batches:
                for k, x, nearest, _ in assigned(b, codebooks):
                    np.add.at(sums[k], nearest, x)
                    counts[k] += np.bincount(nearest, minlength=len(counts[k]))
            rows = [(k, e, int(counts[k][e]), sums[k][e].tolist()) for k in range(parts)
                    for e in range(len(counts[k])) if counts[k][e]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [[]] * 4,
                                                [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())], strict=True)],
                ["part", "entry", "n", "sums"])
        return run

    for _ in range(rounds):
        found = (ready.mapInArrow(sums_of(books.entries), "part int, entry int, n long, sums array<long>")
                 .select("part", "entry", "n", F.posexplode("sums").alias("at", "value"))
                 .groupBy("part", "entry", "at").agg(F.sum("n").alias("n"),
                                                     F.sum(F.col("value").cast("decimal(20,0)")).alias("value")))
        updated = [c.copy() for c in books.entries]
        for r in found.collect():  # one row a component of the codebooks
            updated[r["part"]][r["entry"], r["at"]] = int(r["value"]) // r["n"]
        books = books._replace(entries=updated)
    final = books.entries

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes, error = np.zeros((b.num_rows, parts), np.uint8), np.zeros(b.num_rows, np.int64)
            for k, _, nearest, distance in assigned(b, final):
                codes[:, k] = nearest
                error += distance
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), pa.array([c.tobytes().hex() for c in codes], pa.string()),
                 pa.array(error)], ["vec_id", "label", "code", "error"])

    schema = T.StructType([T.StructField("vec_id", T.LongType()), label, T.StructField("code", T.StringType()),
                           T.StructField("error", T.LongType())])
    coded = saved(ready.mapInArrow(encode, schema), "vector-codes")
    drop_saved(ready)
    # Added up in every task first, so that a label of a third of all rows is
    # one row a task; stored, so that the join splits such a label's rows.
    by_label = saved(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors") \
        .withColumnRenamed("label", "own_label")
    return (coded.join(sized_broadcast(by_label), F.col("label").eqNullSafe(F.col("own_label")), "left")
            .select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")))
