"""Day-over-day history: customer versions, first-seen keys, ended links, change feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.vault import CUSTOMER, OPEN_END


def newest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the one with the greatest ``order`` values, whole row as the last tie-break.

    A grouped maximum, not a window: rows of one key are reduced map-side, so
    a key that holds most rows never lands in one task unreduced.
    """
    names = [key] if isinstance(key, str) else list(key)
    ranks = [(F.col(o) if isinstance(o, str) else o).alias(f"rank{i}") for i, o in enumerate(order)]
    rest = [c for c in df.columns if c not in names]
    best = F.max(F.struct(*ranks, *rest)).alias("best")
    return df.groupBy(*names).agg(best).select(*[c if c in names else F.col("best")[c].alias(c) for c in df.columns])


def next_customer_versions(previous: DataFrame, today: DataFrame, dt: str, close_missing: bool = True) -> DataFrame:
    """Version rows of day ``dt``: carried, closed and opened.

    A version goes on while its tracked attributes are the same; all others are
    those of today, as is the source, and only the load date is the old one.

    ``previous`` is the satellite of the day before (its closed rows are
    ignored), ``today`` the freshly built satellite. Both sides have one row per
    customer before the join, so the full join cannot fan out or skew. Nothing
    is read from the day being written, so a rerun gives the same rows.
    """
    names = previous.columns
    key = CUSTOMER.key
    # the joined sides carry each row whole, as one struct
    before = _one_row(previous.where("is_current"), names, "old")
    now = _one_row(today, names, "new")
    pairs = before.join(now, key, "full")

    same = F.col("old.hash_diff") == F.col("new.hash_diff")
    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    day = F.lit(dt).cast("date")
    closed = F.col("old").withField("load_end_date", day).withField("is_current", F.lit(False))
    opened = (
        F.col("new").withField("load_date", day)
        .withField("load_end_date", F.lit(OPEN_END).cast("date")).withField("is_current", F.lit(True))
    )
    carried = opened.withField("load_date", F.col("old.load_date"))
    gone = closed if close_missing else F.col("old")
    rows = (
        F.when(has_old & has_new & same, F.array(carried))
        .when(has_old & has_new, F.array(closed, opened))
        .when(has_old, F.array(gone))
        .otherwise(F.array(opened))
    )
    return pairs.select(key, F.explode(rows).alias("row")).select(
        *[F.col(key) if c == key else F.col("row")[c].alias(c) for c in names]
    )


def _one_row(df: DataFrame, names: Sequence[str], alias: str) -> DataFrame:
    """One row per customer: the last loaded one, then the one with the greatest values, whole row by row."""
    rest = [c for c in names if c != CUSTOMER.key]
    ranked = F.struct(F.col("load_date").alias("first"), *rest)
    return (
        df.groupBy(CUSTOMER.key).agg(F.max(ranked).alias("best"))
        .select(CUSTOMER.key, F.struct(*[F.col("best")[c].alias(c) for c in rest]).alias(alias))
    )


def customer_history(versions: DataFrame, dt: str) -> DataFrame:
    """All versions known on day ``dt``: closed ones of every day up to it, current ones of that day.

    ``versions`` are the version rows of several days, with their ``dt``.
    """
    known = versions.where(F.col("dt") <= dt)
    return known.where((~F.col("is_current")) | (F.col("dt") == dt)).drop("dt")


def version_rules(history: DataFrame, table: str = "sat_customer") -> DataFrame:
    """Customers whose version rows contradict each other, by rule."""
    per_customer = history.groupBy(CUSTOMER.key).agg(
        F.count_if("is_current").alias("current"),
        F.count_if(F.col("load_end_date") < F.col("load_date")).alias("backward"),
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("load_date").alias("starts"),
    )
    row = per_customer.agg(
        F.count_if(F.col("current") > 1).alias("several_current"),
        F.count_if(F.col("backward") > 0).alias("ends_before_start"),
        F.count_if(F.col("rows") != F.col("starts")).alias("repeated_start"),
        F.count(F.lit(1)).alias("total"),
    )
    rules = ["several_current", "ends_before_start", "repeated_start"]
    return row.unpivot(["total"], rules, "rule", "failed").select(
        "rule", F.lit(table).alias("table_name"), "failed", "total"
    )


def new_hub_rows(today: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Hub rows of today whose key was never seen; their load date is the first-seen date."""
    return today.join(known.select(key), key, "left_anti")


def first_seen(hub_days: DataFrame, key: str, business_id: str) -> DataFrame:
    """First load date and its source per key over several days of a hub."""
    first = F.min(F.struct("load_date", "record_source", business_id)).alias("first")
    return hub_days.groupBy(key).agg(first).select(key, "first.*")


def next_links(previous: DataFrame, today: DataFrame, dt: str, key: str = "cust_acct_hash_key") -> DataFrame:
    """Link rows of day ``dt``: still active ones as first loaded, new ones, and ones that ended today."""
    names = previous.columns
    rest = [c for c in names if c != key]

    def side(df: DataFrame, alias: str) -> DataFrame:
        return df.groupBy(key).agg(F.max(F.struct(*rest)).alias(alias))

    pairs = side(previous.where("is_active"), "old").join(side(today.select(*names), "new"), key, "full")
    ended = (
        F.col("old").withField("rel_end_date", F.lit(dt).cast("date")).withField("is_active", F.lit(False))
    )
    row = (
        F.when(F.col("old").isNull(), F.col("new"))
        .when(F.col("new").isNull(), ended)
        .otherwise(F.col("old"))
    )
    return pairs.select(key, row.alias("row")).select(
        *[F.col(key) if c == key else F.col("row")[c].alias(c) for c in names]
    )


def latest_changes(changes: DataFrame, key: str = "trans_id") -> DataFrame:
    """Current rows after a change feed: the newest change per key, keys whose newest change is a delete left out.

    ``changes`` are exploded change rows with ``op``, ``es`` (commit time),
    ``batch`` (message number) and ``pos`` (place within the message).
    """
    newest = newest_per_key(changes, key, ["es", "batch", "pos"])
    return newest.where(F.col("op") != "DELETE")


def apply_changes(base: DataFrame, changes: DataFrame, key: str = "trans_id") -> DataFrame:
    """A base table with the newest change of each key applied; base rows that share a key are all replaced."""
    newest = newest_per_key(changes, key, ["es", "batch", "pos"])
    # grouped by a second column too, so that the join has its own exchange and a hot key of the base can be split
    changed = changes.groupBy(key, F.xxhash64(key)).agg(F.count(F.lit(1)).alias("changes")).select(key)
    untouched = base.join(changed, key, "left_anti")
    return untouched.select(*base.columns).unionByName(newest.where(F.col("op") != "DELETE").select(*base.columns))
