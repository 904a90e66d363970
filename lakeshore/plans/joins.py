"""Joins whose broadcast side is size-checked at run time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A broadcast side must fit comfortably in the driver (which builds it) and
# in every executor: both its row count and its size in bytes are checked.
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024

_FIXED_WIDTH = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                T.DoubleType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType,
                T.NullType, T.DayTimeIntervalType, T.YearMonthIntervalType)


def _row_bytes(schema: T.StructType) -> Column:
    """Upper estimate of one row's in-memory size: an 8-byte slot per field
    plus the null bits, and the bytes of every variable-length value (long
    decimals and nested values measured through their text form)."""
    size = F.lit(8 * len(schema.fields) + 8 * (len(schema.fields) // 64 + 1)).cast("long")
    for f in schema.fields:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(t, T.DecimalType) and t.precision > 18:
            size = size + 16
        elif not isinstance(t, _FIXED_WIDTH):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    return size


_KEPT: list[DataFrame] = []


def sized_broadcast(small: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                    max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``small`` only after measuring it; above either bound return
    it unchanged so the planner falls back to a shuffle join (AQE then
    handles skew and may still convert it at run time).

    Rows and bytes are measured in one aggregation over the persisted side.
    The measured side stays cached for the join that follows; long-running
    processes call :func:`release_checked` once the results are written."""
    side, fits = measured_side(small, max_rows, max_bytes)
    return F.broadcast(side) if fits else side


def measured_side(small: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                  max_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """(side, fits): the persisted side and True under both bounds, else the
    unpersisted side and False (for callers that shape a shuffle join)."""
    kept = small.persist(StorageLevel.MEMORY_AND_DISK)
    n, size = kept.agg(F.count(F.lit(1)), F.sum(_row_bytes(kept.schema))).first()
    if n <= max_rows and (size or 0) <= max_bytes:
        _KEPT.append(kept)
        return kept, True
    # Too large to broadcast - and too large to keep cached: drop the cache
    # and let the join shuffle (AQE splits skewed partitions).
    kept.unpersist()
    return small, False


def lookup_join(big: DataFrame, small: DataFrame, on: Sequence[str] | str, how: str = "left",
                max_rows: int = DEFAULT_BROADCAST_ROWS,
                max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Join a large fact to a dimension-sized frame with a checked broadcast.

    A few keys (cities, dates) may carry most of the fact rows; a shuffle join
    on such keys would put each in one task, a broadcast hash join never
    shuffles the fact at all.
    """
    return big.join(sized_broadcast(small, max_rows, max_bytes), on, how)


def heavy_join(big: DataFrame, small: DataFrame, on: Sequence[str] | str, how: str = "left",
               share: float = 0.002) -> DataFrame:
    """The shuffle join of a fact with a dimension too large to broadcast, for
    keys that may each carry much of the fact.

    A frequent-items sketch of the fact's keys (each task keeps 1 / ``share``
    counters, so none that holds more than ``share`` of the rows is missed)
    names the heavy ones. Their rows, and those without a key, meet a broadcast
    of their few dimension rows where they are; only the others are shuffled.
    ``small`` has unique keys; ``how`` is ``left`` or ``inner``."""
    if how not in ("left", "inner"):
        raise ValueError("how is left or inner")
    keys = [on] if isinstance(on, str) else list(on)
    sketch = big.select(F.struct(*keys).alias("_key")).stat.freqItems(["_key"], share).first()[0]
    heavy = [tuple(r[k] for k in keys) for r in sketch or []]
    # At most 1 / share rows.
    listed = big.sparkSession.createDataFrame(heavy, T.StructType([big.schema[k] for k in keys])).distinct()
    is_heavy = F.lit(False)
    for k in keys:
        is_heavy = is_heavy | F.col(k).isNull()
    marked = big.join(F.broadcast(listed.withColumn("_heavy", F.lit(True))), keys, "left").withColumn(
        "_heavy", F.coalesce("_heavy", is_heavy)).select(*big.columns, "_heavy")
    heavy_rows = small.join(F.broadcast(listed), keys, "left_semi")
    stays = marked.where("_heavy").drop("_heavy").join(F.broadcast(heavy_rows), keys, how)
    moves = marked.where("NOT _heavy").drop("_heavy").join(small.hint("shuffle_hash"), keys, how)
    return stays.unionByName(moves)


def release_checked(since: int = 0) -> int:
    """Drop the caches kept by :func:`sized_broadcast` (after the results that
    use them are written); with ``since`` (from :func:`kept_so_far`) only the
    later ones. Returns how many were released."""
    late = _KEPT[since:]
    del _KEPT[since:]
    for side in late:
        side.unpersist()
    return len(late)


def kept_so_far() -> int:
    """A mark for :func:`release_checked`."""
    return len(_KEPT)


__all__ = ["sized_broadcast", "measured_side", "lookup_join", "heavy_join", "release_checked", "kept_so_far", "DEFAULT_BROADCAST_ROWS",
           "DEFAULT_BROADCAST_BYTES"]
