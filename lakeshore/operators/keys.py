"""Key operators: latest-per-key (W1), top-N per group (W2), duplicate keys
(A4), high-water marks (A9) and dense surrogate keys (A14)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



class Order:
    """One ORDER BY term. ``nulls_first`` defaults to the reference
    database's behaviour: NULLs sort as the largest value (first when
    descending)."""

    def __init__(self, column: str, descending: bool = False, nulls_first: bool | None = None):
        self.column = column
        self.descending = descending
        self.nulls_first = descending if nulls_first is None else nulls_first

    def sort_col(self) -> Column:
        c = F.col(self.column)
        if self.descending:
            return c.desc_nulls_first() if self.nulls_first else c.desc_nulls_last()
        return c.asc_nulls_first() if self.nulls_first else c.asc_nulls_last()


def desc(column: str, nulls_first: bool | None = None) -> Order:
    return Order(column, True, nulls_first)


def asc(column: str, nulls_first: bool | None = None) -> Order:
    return Order(column, False, nulls_first)


def _as_orders(order_by) -> list[Order]:
    out = []
    for o in order_by:
        out.append(o if isinstance(o, Order) else Order(o))
    return out


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence,
                   drop_null_keys: bool = False) -> DataFrame:
    """Keep the first row per key under ``order_by`` (ROW_NUMBER() = 1).

    Planned as an aggregation, not a window: ``max`` over a struct whose
    leading fields encode the ordering is combined map-side, so a key holding
    a third of all rows is reduced in every task before the shuffle instead of
    being sorted in one task. Ties on the ordering fall to the remaining
    columns, which makes the choice deterministic.
    """
    orders = _as_orders(order_by)
    keys = list(keys)
    if drop_null_keys:
        df = df.where(_all_not_null(keys))
    payload = [c for c in df.columns if c not in keys]
    directions = {o.descending for o in orders}
    use_max = orders[0].descending
    if len(directions) != 1:
        # Mixed ASC/DESC: numeric and date terms against the majority
        # direction are negated; anything else needs the window form.
        types = dict(df.dtypes)
        if not all(o.descending == use_max or _negatable(types[o.column]) for o in orders):
            return _latest_by_window(df, keys, orders)
    rank_fields = []
    for i, o in enumerate(orders):
        c = F.col(o.column)
        if o.descending != use_max:
            c = _negate(c, dict(df.dtypes)[o.column])
        # For max(): the null flag must be larger for the row that wins.
        # For min(): the null flag must be smaller for the row that wins.
        null_wins = o.nulls_first
        flag = c.isNull() if (null_wins == use_max) else c.isNotNull()
        rank_fields += [flag.alias(f"_n{i}"), c.alias(f"_v{i}")]
    packed = F.struct(*rank_fields, F.struct(*payload).alias("_row"))
    agg = F.max(packed) if use_max else F.min(packed)
    return df.groupBy(*keys).agg(agg.alias("_best")).select(*keys, "_best._row.*") \
        .select(*df.columns)


_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def _negatable(dtype: str) -> bool:
    return dtype.startswith(_NUMERIC) or dtype == "date"


def _negate(c: Column, dtype: str) -> Column:
    """An order-reversing image of a numeric or date column."""
    if dtype == "date":
        return -F.datediff(c, F.lit("1970-01-01").cast("date"))
    if dtype.startswith("decimal"):
        return F.lit(0) - c
    return -c


def _all_not_null(cols) -> Column:
    out = None
    for c in cols:
        t = F.col(c).isNotNull()
        out = t if out is None else out & t
    return out


def _latest_by_window(df: DataFrame, keys, orders) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*[o.sort_col() for o in orders])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def top_n_per_group(df: DataFrame, by: Sequence[str], order_by: Sequence, n: int,
                    rank_col: str = "rn") -> DataFrame:
    """ROW_NUMBER() OVER (PARTITION BY by ORDER BY ...) <= n.

    Catalyst plans a partial WindowGroupLimit before the shuffle, so at most
    n rows per group leave each task even when there are few, huge groups.
    """
    w = Window.partitionBy(*by).orderBy(*[o.sort_col() for o in _as_orders(order_by)])
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n) \
        .withColumn(rank_col, F.col(rank_col).cast("bigint"))


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "cnt",
                   skip_null_keys: bool = False) -> DataFrame:
    """GROUP BY keys HAVING COUNT(*) > 1."""
    if skip_null_keys:
        df = df.where(_all_not_null(keys))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)) \
        .where(F.col(count_col) > 1)


def watermarks(df: DataFrame, key: str = "location_id", ts: str = "ts",
               out: str = "max_ts") -> DataFrame:
    """High-water mark per key: MAX(ts) GROUP BY key (partial aggregation)."""
    return df.groupBy(key).agg(F.max(ts).alias(out))


def assign_keys(new: DataFrame, existing: DataFrame | None, id_col: str,
                order_by: Sequence[str], start: int = 1) -> DataFrame:
    """Dense surrogate keys for ``new`` rows, continuing after max(existing).

    Identity-like: ids follow ``order_by``. No single-partition window: rows
    are range-sorted and checkpointed (so both passes see the same
    partitions), counted per partition - one small row per partition, the
    same bookkeeping ``zipWithIndex`` does - and each row's id is its
    partition's offset plus its position inside the partition.
    """
    spark = new.sparkSession
    base = start - 1
    if existing is not None:
        found = existing.agg(F.max(id_col)).first()[0]
        base = max(base, int(found)) if found is not None else base
    ordered = new.orderBy(*order_by).withColumn("_mid", F.monotonically_increasing_id())
    ordered = ordered.checkpoint(eager=True)
    part = F.shiftright(F.col("_mid"), 33)
    pos = F.col("_mid") - F.shiftleft(part, 33)
    counts = sorted(ordered.groupBy(part.alias("_pid")).agg(F.count(F.lit(1)).alias("_n")).collect())
    rows, running = [], base
    for pid, n in counts:
        rows.append((int(pid), running))
        running += int(n)
    offsets = spark.createDataFrame(rows or [(0, base)], "_pid long, _off long")
    # Bounded by the number of partitions, not by the data.
    offsets = F.broadcast(offsets)
    out = ordered.withColumn("_pid", part).withColumn("_pos", pos) \
        .join(offsets, "_pid") \
        .withColumn(id_col, (F.col("_off") + F.col("_pos") + 1).cast("bigint")) \
        .drop("_pid", "_pos", "_off", "_mid")
    return out.select(id_col, *[c for c in new.columns if c != id_col])


def running_sums(df: DataFrame, value: str, order_by: Sequence[str], out: str) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` (a long) over all rows before
    this one in ``order_by`` order. As in :func:`assign_keys` no task sees all
    rows: sums inside the ranges of a range sort, and one row per range to add
    them up."""
    spark = df.sparkSession
    ordered = df.orderBy(*order_by).withColumn("_mid", F.monotonically_increasing_id()).checkpoint(eager=True)
    part = F.shiftright(F.col("_mid"), 33)
    sums = sorted(ordered.groupBy(part.alias("_pid")).agg(F.sum(value).alias("_sum")).collect())
    rows, running = [], 0
    for pid, total in sums:
        rows.append((int(pid), running))
        running += int(total or 0)
    offsets = F.broadcast(spark.createDataFrame(rows or [(0, 0)], "_pid long, _off long"))
    before = Window.partitionBy("_pid").orderBy("_mid").rowsBetween(Window.unboundedPreceding, -1)
    return (ordered.withColumn("_pid", part).withColumn("_in", F.coalesce(F.sum(value).over(before), F.lit(0)))
            .join(offsets, "_pid").withColumn(out, F.col("_off") + F.col("_in")).drop("_mid", "_pid", "_in", "_off"))


__all__ = ["Order", "asc", "desc", "latest_per_key", "top_n_per_group", "duplicate_keys",
           "watermarks", "assign_keys", "running_sums"]
