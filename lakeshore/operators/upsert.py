"""Upsert without MERGE (K3a-d), insert-if-absent (K4), location resolution
(K3b + A14)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshore.operators.keys import assign_keys, latest_per_key


class DuplicateKeyError(ValueError):
    pass


class NullKeyError(ValueError):
    pass


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def dedup_source(source: DataFrame, keys: Sequence[str], on_duplicate: str = "error",
                 order_by: Sequence | None = None) -> DataFrame:
    """Duplicate keys inside one batch: ``error`` (one INSERT ... SELECT),
    ``last`` (row-by-row statements: the last under ``order_by`` wins) or
    ``trust`` (caller guarantees unique keys).

    ``error`` also rejects NULL keys (primary keys are NOT NULL): a NULL key
    never matches, so it would be inserted again on every replay. Both
    checks run as one aggregation over the keys."""
    if on_duplicate == "trust":
        return source
    if on_duplicate == "last":
        if not order_by:
            raise ValueError("on_duplicate='last' needs order_by")
        return latest_per_key(source, keys, order_by)
    if on_duplicate == "error":
        check_keys(source, keys)
        return source
    raise ValueError(on_duplicate)


def check_keys(source: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> list:
    """Raise on NULL or repeated keys; one aggregation over the keys (partial
    per task, so a hot key costs one row per task). Returns one row per
    ``by`` group (e.g. the touched days of a batch) with ``_rows`` and
    ``_max_per_key``."""
    keys, by = list(keys), [c for c in by if c not in keys]
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    per_key = source.groupBy(*keys, *by).agg(F.count(F.lit(1)).alias("_n"), F.max(null_key).alias("_null"))
    rows = per_key.groupBy(*by).agg(F.sum("_n").alias("_rows"), F.max("_n").alias("_max_per_key"),
                                    F.max("_null").alias("_null")).collect()
    if any(r["_null"] for r in rows):
        raise NullKeyError(f"source has a NULL key in {keys}")
    if any(r["_max_per_key"] is not None and r["_max_per_key"] > 1 for r in rows):
        raise DuplicateKeyError(f"source has duplicate keys in {keys}")
    return rows


def _tagged_join(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    t = target.select(*[F.col(c).alias(f"_t_{c}") for c in target.columns], F.lit(True).alias("_t"))
    s = source.select(*[F.col(c).alias(f"_s_{c}") for c in source.columns], F.lit(True).alias("_s"))
    cond = None
    for k in keys:
        e = F.col(f"_t_{k}") == F.col(f"_s_{k}")
        cond = e if cond is None else cond & e
    return t.join(s, cond, "full_outer")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str] | None = None, insert_defaults: dict | None = None,
           touch: dict | None = None, on_duplicate: str = "error",
           order_by: Sequence | None = None, with_action: bool = False) -> DataFrame:
    """INSERT ... ON CONFLICT (keys) DO UPDATE SET update_cols, as one
    full-outer join on the keys.

    matched     -> ``update_cols`` from the source (a NULL overwrites),
                   ``touch`` columns set to their value, all else kept;
    source only -> source columns, ``insert_defaults`` for the rest;
    target only -> unchanged.
    The side is chosen by a tag, never by coalescing measures. Keys are
    unique on each side, so the join has no hot key; NULL keys never match.
    """
    keys = list(keys)
    insert_defaults = dict(insert_defaults or {})
    touch = dict(touch or {})
    cols = target.columns
    if update_cols is None:
        update_cols = [c for c in source.columns if c not in keys and c in cols]
    source = dedup_source(source, keys, on_duplicate, order_by)
    src_cols = set(source.columns)
    j = _tagged_join(target, source, keys)
    t_on, s_on = F.col("_t").isNotNull(), F.col("_s").isNotNull()

    def inserted(c):
        if c in src_cols:
            return F.col(f"_s_{c}")
        if c in insert_defaults:
            return _lit(insert_defaults[c])
        return F.lit(None)

    out = []
    for c in cols:
        tc = F.col(f"_t_{c}")
        if c in keys:
            e = F.when(s_on, F.col(f"_s_{c}")).otherwise(tc)
        elif c in update_cols:
            e = F.when(s_on, F.col(f"_s_{c}")).otherwise(tc)
        elif c in touch:
            e = F.when(s_on & t_on, _lit(touch[c])).when(s_on, inserted(c)).otherwise(tc)
        else:
            e = F.when(t_on, tc).otherwise(inserted(c))
        out.append(e.cast(target.schema[c].dataType).alias(c))
    if with_action:
        out.append(F.when(s_on & t_on, "updated").when(s_on, "inserted").otherwise("kept")
                   .alias("_action"))
    return j.select(*out)


def upsert_counts(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(inserted, updated, rows_touched, final_rows) of an upsert, one pass
    over the key columns only. rows_touched = inserted + updated, like the
    row count of the reference's statements."""
    j = _tagged_join(target.select(*keys), source.select(*keys), keys)
    t_on, s_on = F.col("_t").isNotNull(), F.col("_s").isNotNull()
    return j.agg(
        F.count_if(s_on & ~t_on).alias("inserted"),
        F.count_if(s_on & t_on).alias("updated"),
        F.count_if(s_on).alias("rows_touched"),
        F.count(F.lit(1)).alias("final_rows"),
    )


def insert_missing(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """INSERT ... ON CONFLICT (keys) DO NOTHING: target plus source rows with
    new keys (one row per new key)."""
    keys = list(keys)
    new = source.select(*target.columns).dropDuplicates(keys) \
        .join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new)


def resolve_locations(dim: DataFrame, incoming: DataFrame, id_col: str = "location_id",
                      natural_key: Sequence[str] = ("latitude", "longitude"),
                      name_col: str = "location_name", order_by: str | None = None) -> DataFrame:
    """ON CONFLICT (latitude, longitude) DO UPDATE SET location_name ...
    RETURNING location_id, for a whole batch of locations. Of several names
    for one coordinate the last under ``order_by`` (a column of ``incoming``,
    e.g. the fetch time) stays, as with one statement after the other.

    Existing coordinates keep their id and take the new name; new coordinates
    get dense ids after max(id) in coordinate order. Returns the new dim."""
    natural_key = list(natural_key)
    incoming = _one_name_per_key(incoming, natural_key, name_col, order_by)
    new = incoming.join(dim.select(*natural_key), natural_key, "left_anti")
    new_ids = assign_keys(new, dim, id_col, natural_key)
    inserted_dim = dim.unionByName(new_ids.select(*dim.columns))
    return upsert(inserted_dim, incoming, natural_key, update_cols=[name_col], on_duplicate="trust")


def _one_name_per_key(incoming: DataFrame, natural_key, name_col, order_by) -> DataFrame:
    """The last name of each coordinate in a batch (without an order, or on a
    tie, the largest name); rows without a coordinate are left out."""
    cond = F.lit(True)
    for c in natural_key:
        cond = cond & F.col(c).isNotNull()
    order = F.struct(order_by, name_col) if order_by else F.col(name_col)
    return incoming.where(cond).groupBy(*natural_key).agg(F.max_by(name_col, order).alias(name_col))


__all__ = ["DuplicateKeyError", "NullKeyError", "dedup_source", "check_keys", "upsert", "upsert_counts", "insert_missing",
           "resolve_locations"]
