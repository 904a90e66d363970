"""Data quality: quarantine split, constraint checks, reconciliation, load
guards, post-load run QC and the publish gate (Q1-Q13)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeshore import fixed as fx
from lakeshore.functions.scalar import any_null, hour_floor, ntz, plus_hours, ts_date
from lakeshore.operators.keys import desc, latest_per_key
from lakeshore.plans.joins import sized_broadcast


class QualityError(RuntimeError):
    """Raised by :func:`gate` when a check failed; later steps must not run."""


# --------------------------------------------------------------------------
# Q1/Q2: quarantine
# --------------------------------------------------------------------------

def tag_rejects(df: DataFrame, rules: Sequence[tuple[str, Column]],
                reason_col: str = "reject_reason") -> DataFrame:
    """Add the first matching reject reason (NULL for good rows).

    A rule whose predicate evaluates to NULL does not match, so every row
    gets exactly one verdict (good or one reason)."""
    expr = None
    for reason, pred in rules:
        cond = F.coalesce(pred, F.lit(False))
        expr = F.when(cond, F.lit(reason)) if expr is None else expr.when(cond, F.lit(reason))
    return df.withColumn(reason_col, expr if expr is not None else F.lit(None).cast("string"))


def quarantine(df: DataFrame, rules: Sequence[tuple[str, Column]],
               reason_col: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """Split into (good, bad): bad rows carry ``reason_col``."""
    tagged = tag_rejects(df, rules, reason_col)
    good = tagged.where(F.col(reason_col).isNull()).drop(reason_col)
    bad = tagged.where(F.col(reason_col).isNotNull())
    return good, bad


def event_rules() -> list[tuple[str, Column]]:
    """Event reject rules, first match wins."""
    amount, etype = F.col("amount"), F.col("event_type")
    return [
        (fx.REJECT_MISSING_EMAIL, F.col("email").isNull()),
        (fx.REJECT_PURCHASE_MISSING_AMOUNT, (etype == fx.PURCHASE) & amount.isNull()),
        (fx.REJECT_NEGATIVE_AMOUNT, amount < 0),
    ]


def reject_summary(bad: DataFrame, reason_col: str = "reject_reason") -> DataFrame:
    return bad.groupBy(reason_col).agg(F.count(F.lit(1)).alias("rejected_count"))


# --------------------------------------------------------------------------
# Q3/Q4/Q5: constraint checks in one pass
# --------------------------------------------------------------------------

def event_checks() -> dict[str, Column]:
    """CHECK constraints of fact_events; a row violates one when the
    expression is FALSE (NULL passes, as in SQL)."""
    amount, etype = F.col("amount"), F.col("event_type")
    return {
        fx.CHK_EVENT_TYPE_NOT_BLANK: F.trim(etype) != "",
        fx.CHK_PURCHASE_AMOUNT: (etype != fx.PURCHASE) | amount.isNotNull(),
        fx.CHK_AMOUNT_NON_NEGATIVE: amount.isNull() | (amount >= 0),
    }


def check_report(df: DataFrame, checks: dict[str, Column] | None = None,
                 not_null: Sequence[str] = ()) -> DataFrame:
    """All checks over one scan: (check_name, failed_rows, passed)."""
    checks = dict(checks or {})
    aggs = [F.count_if(~F.coalesce(expr, F.lit(True))).alias(name) for name, expr in checks.items()]
    names = list(checks)
    for c in not_null:
        name = f"not_null_{c}"
        aggs.append(F.count_if(F.col(c).isNull()).alias(name))
        names.append(name)
    wide = df.agg(*aggs)
    stacked = wide.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("check_name"), F.col(n).cast("bigint").alias("failed_rows"))
        for n in names])).alias("r")).select("r.*")
    return stacked.withColumn("passed", F.col("failed_rows") == 0)


def unique_report(df: DataFrame, keys: Sequence[str], table_name: str) -> DataFrame:
    """Key uniqueness: (table_name, key_cols, duplicate_keys, surplus_rows, passed).
    Two partial-aggregated stages; no key is collected anywhere."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return per_key.agg(
        F.count(F.lit(1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("surplus_rows"),
    ).select(F.lit(table_name).alias("table_name"), F.lit(",".join(keys)).alias("key_cols"),
             "duplicate_keys", "surplus_rows", (F.col("duplicate_keys") == 0).alias("passed"))


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows whose key has no dimension row (LEFT JOIN ... IS NULL),
    written as an anti join."""
    dim_key = dim_key or fact_key
    keys = dim.select(F.col(dim_key).alias("_k")).distinct()
    return fact.join(keys, fact[fact_key] == keys["_k"], "left_anti")


def orphan_count(fact: DataFrame, dim: DataFrame, fact_key: str, name: str, dim_key: str | None = None) -> DataFrame:
    """How many rows :func:`orphans` has, as column ``name``. Facts are counted
    per key first, so that no hot key is shuffled."""
    per_key = fact.groupBy(fact_key).agg(F.count(F.lit(1)).alias("_n"))
    return orphans(per_key, dim, fact_key, dim_key).agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias(name))


def counts_row(frames: dict[str, DataFrame]) -> DataFrame:
    """Side-by-side counts of several frames as one row (scalar subqueries)."""
    items = list(frames.items())
    unioned = None
    for name, df in items:
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        unioned = one if unioned is None else unioned.unionByName(one)
    return unioned.agg(*[F.max(F.when(F.col("name") == n, F.col("n"))).alias(n) for n, _ in items])


def reconcile(frames: dict[str, DataFrame]) -> DataFrame:
    """Layer reconciliation: counts side by side plus ``reconciled``."""
    names = list(frames)
    row = counts_row(frames)
    same = None
    for n in names[1:]:
        t = F.col(n) == F.col(names[0])
        same = t if same is None else same & t
    return row.withColumn("reconciled", same if same is not None else F.lit(True))


def reconcile_tagged(tagged: DataFrame, reason: str = "reject_reason") -> DataFrame:
    """Split reconciliation in one pass over the tagged rows."""
    row = tagged.agg(F.count(F.lit(1)).alias("raw_count"), F.count_if(F.col(reason).isNull()).alias("good_count"),
                     F.count_if(F.col(reason).isNotNull()).alias("bad_count"))
    return row.withColumn("reconciled", F.col("raw_count") == F.col("good_count") + F.col("bad_count"))


def reconcile_split(raw: DataFrame, good: DataFrame, bad: DataFrame) -> DataFrame:
    row = counts_row({"raw_count": raw, "good_count": good, "bad_count": bad})
    return row.withColumn("reconciled", F.col("raw_count") == F.col("good_count") + F.col("bad_count"))


def _sums(df: DataFrame, by: list[str], columns: list[str], side: str) -> DataFrame:
    """Rows and order-independent checksums of each group."""
    first, second = F.xxhash64(F.lit(1), *columns), F.pmod(F.xxhash64(F.lit(2), *columns), F.lit(1 << 31))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(f"{side}_rows"), F.bit_xor(first).alias(f"{side}_xor"),
                               F.sum(second).alias(f"{side}_sum"))


def _null_safe(columns: Sequence[str], a: str, b: str) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(a + c).eqNullSafe(F.col(b + c))
    return out


def reconcile_content(left: DataFrame, right: DataFrame, levels: Sequence[Sequence[str]],
                      columns: Sequence[str] | None = None) -> DataFrame:
    """Where two layers differ: one row per key with left_rows, right_rows and
    ``kind``: lost (not in ``right``), added (not in ``left``), doubled (more
    often in ``right``), thinned (less often there), or changed.

    Checksums make a tree: of all rows, of the groups of each of ``levels``
    (e.g. day, then day and location), and of its last one, the key. Every
    level is computed only inside the groups that differ on the level above, so
    equal layers cost one pass and a few changed rows little more. Of two rows
    that differ no checksums agree but by a chance of 2^-95 a group. Null keys
    are keys."""
    columns = list(columns or left.columns)
    differ, above = None, []
    for level in [["_all"], *map(list, levels)]:
        sides = []
        for df, side in ((left, "left"), (right, "right")):
            df = df.withColumn("_all", F.lit(1))
            if differ is not None:
                at = differ.select(*[F.col(c).alias(f"_at_{c}") for c in above])
                df = df.join(sized_broadcast(at), _null_safe(above, "", "_at_"), "left_semi")
            sides.append(_sums(df, level, columns, side))
        a, b = sides[0], sides[1].withColumnsRenamed({c: f"_r_{c}" for c in level})
        both = a.join(b, _null_safe(level, "", "_r_"), "full_outer")
        same = _null_safe(["rows", "xor", "sum"], "left_", "right_")
        there = F.col("left_rows").isNotNull()
        differ = both.where(~same).select(*[F.when(there, F.col(c)).otherwise(F.col(f"_r_{c}")).alias(c) for c in level],
                                          "left_rows", "right_rows").checkpoint(eager=True)
        above = level
        if differ.isEmpty():
            break
    rows_l, rows_r = (F.coalesce(f"{side}_rows", F.lit(0)) for side in ("left", "right"))
    kind = F.when(rows_r == 0, "lost").when(rows_l == 0, "added").when(rows_r > rows_l, "doubled") \
        .when(rows_r < rows_l, "thinned").otherwise("changed")
    keys = list(levels[-1])
    if differ.isEmpty():
        empty = left.select(*keys).limit(0)
        return empty.select(*keys, F.lit(0).cast("long").alias("left_rows"), F.lit(0).cast("long").alias("right_rows"),
                            F.lit("").alias("kind"))
    return differ.select(*keys, rows_l.alias("left_rows"), rows_r.alias("right_rows"), kind.alias("kind"))


def hour_gaps(rows: DataFrame, groups: DataFrame, by: str, start, end) -> DataFrame:
    """Hours that are missing from the grid ``start`` .. ``end`` (both hours
    included): (``by``, first_missing, last_missing, hours), one row per run of
    missing hours, for every one of ``groups``; one without rows misses all.

    No grid is made: the distinct hours of a group (combined in every task
    before they are shuffled; no more than the grid has) and the two edges of
    the window are put in order, and a gap is a step of more than an hour."""
    start, end = ntz(start), ntz(end)
    there = rows.where(F.col("ts").isNotNull()).select(by, hour_floor("ts").alias("_at")).where(
        F.col("_at").between(start, end)).distinct()
    edges = groups.select(by).distinct().select(by, F.explode(F.array(plus_hours(start, -1), plus_hours(end, 1))).alias("_at"))
    before = F.lag("_at").over(Window.partitionBy(by).orderBy("_at"))
    steps = there.join(sized_broadcast(groups.select(by).distinct()), by, "left_semi").unionByName(edges).withColumn(
        "_before", before)
    hours = F.datediff(ts_date("_at"), ts_date("_before")) * 24 + F.hour("_at") - F.hour("_before") - 1
    return steps.select(by, plus_hours("_before", 1).alias("first_missing"), plus_hours("_at", -1).alias("last_missing"),
                        hours.cast("bigint").alias("hours")).where("hours > 0")


# --------------------------------------------------------------------------
# Q7/Q8: load guards
# --------------------------------------------------------------------------

def load_guard(df: DataFrame, by: Sequence[str], expected_rows: int | None = None,
               min_rows: int | None = None, not_null: Sequence[str] = ("temperature_2m",)) -> DataFrame:
    """Per group: rows, NULLs among ``not_null`` columns, verdict and reason.

    ``expected_rows`` is the full-window guard (e.g. 168 hours), ``min_rows``
    the incremental one (some rows touched)."""
    nulls = any_null(*not_null) if not_null else F.lit(False)
    agg = df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"),
                              F.count_if(nulls).alias("null_values"))
    rc = F.col("row_count")
    bad_rows = F.lit(False)
    if expected_rows is not None:
        bad_rows = rc != expected_rows
    if min_rows is not None:
        bad_rows = bad_rows | (rc < min_rows)
    reason = F.when(bad_rows, F.lit("row_count")).when(F.col("null_values") > 0, F.lit("null_values"))
    return agg.withColumn("passed", reason.isNull()).withColumn("failure", reason)


# --------------------------------------------------------------------------
# Q9: post-load run QC
# --------------------------------------------------------------------------

QC_CHECKS = ["run_exists", "status_ok", "finished_at_set", "row_count_positive",
             "no_null_values", "no_duplicate_keys"]


def qc_runs(runs: DataFrame, raw: DataFrame, window_start, window_hours: int = fx.QC_WINDOW_HOURS,
            pipeline_name: str | None = None, latest_only: bool = False,
            measures: Sequence[str] = tuple(fx.HOURLY_VARS)) -> DataFrame:
    """Check every run started in [t, t + window] (closed both ends).

    Output: (run_id, status, check_name, passed, observed). SKIPPED runs skip
    the data checks; SUCCESS runs need finished_at, row_count > 0, no NULLs in
    ts and the measures and no duplicate (location_id, ts). With no run in
    the window a single failing ``run_exists`` row is returned."""
    start = ntz(window_start)
    end = plus_hours(start, window_hours)
    r = runs.where(F.col("started_at").between(start, end))
    if pipeline_name is not None:
        r = r.where(F.col("pipeline_name") == pipeline_name)
    if latest_only:
        r = latest_per_key(r.withColumn("_one", F.lit(1)), ["_one"], [desc("run_id")]).drop("_one")
    nulls = any_null("ts", *measures)
    # Only rows of the runs in the window are aggregated.
    checked = r.select("run_id").distinct()
    per_key = raw.join(sized_broadcast(checked), "run_id", "left_semi").groupBy("run_id", "location_id", "ts").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(nulls).alias("_nulls"))
    stats = per_key.groupBy("run_id").agg(
        F.sum("_nulls").cast("bigint").alias("null_rows"),
        F.sum(F.col("_n") - 1).cast("bigint").alias("dup_rows"))
    j = r.join(stats, "run_id", "left")
    ok = F.col("status").isin("SUCCESS", "SKIPPED")
    success = F.col("status") == "SUCCESS"
    null_rows = F.coalesce("null_rows", F.lit(0)).cast("bigint")
    dup_rows = F.coalesce("dup_rows", F.lit(0)).cast("bigint")
    none = F.lit(None).cast("bigint")
    checks = [
        ("run_exists", F.lit(True), none),
        ("status_ok", ok, none),
        ("finished_at_set", ~success | F.col("finished_at").isNotNull(), none),
        ("row_count_positive", ~success | F.coalesce(F.col("row_count") > 0, F.lit(False)),
         F.col("row_count").cast("bigint")),
        ("no_null_values", ~success | (null_rows == 0), null_rows),
        ("no_duplicate_keys", ~success | (dup_rows == 0), dup_rows),
    ]
    report = j.select("run_id", "status", F.explode(F.array(*[
        F.struct(F.lit(n).alias("check_name"), p.alias("passed"), o.alias("observed"))
        for n, p, o in checks])).alias("c")).select("run_id", "status", "c.*")
    # "no run in window" is one failing row; it appears only when r is empty.
    marker = r.agg(F.count(F.lit(1)).alias("_runs")).where("_runs = 0").select(
        F.lit(None).cast("bigint").alias("run_id"), F.lit(None).cast("string").alias("status"),
        F.lit("run_exists").alias("check_name"), F.lit(False).alias("passed"),
        F.lit(0).cast("bigint").alias("observed"))
    return report.unionByName(marker)


def gate(report: DataFrame, passed_col: str = "passed", what: str = "quality checks",
         show: int = 20) -> None:
    """Stop the run when any row of a (small) report failed."""
    failed = report.where(~F.coalesce(F.col(passed_col), F.lit(False)))
    sample = failed.limit(show + 1).collect()
    if sample:
        more = failed.count() - show if len(sample) > show else 0
        raise QualityError(f"{what} failed: " + "; ".join(str(r.asDict()) for r in sample[:show])
                           + (f"; and {more} more" if more else ""))


__all__ = ["QualityError", "tag_rejects", "quarantine", "event_rules", "reject_summary",
           "event_checks", "check_report", "unique_report", "orphans", "orphan_count", "counts_row", "reconcile",
           "reconcile_split", "reconcile_tagged", "reconcile_content", "hour_gaps", "load_guard", "qc_runs", "QC_CHECKS", "gate"]
