"""Load counts and data-quality rules as (rule, table, failed, total) rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.casts import parse
from ledgerlake.schemas import SOURCES
from ledgerlake.sources.delimited import lost_cells


def reconcile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each table."""
    return _union(
        df.agg(F.count(F.lit(1)).alias("row_cnt")).select(F.lit(name).alias("table_name"), "row_cnt")
        for name, df in tables.items()
    )


def _union(frames) -> DataFrame:
    result = None
    for frame in frames:
        result = frame if result is None else result.unionByName(frame)
    return result


def _rules(row: DataFrame, table: str, rules: list[str]) -> DataFrame:
    """One row with a column per rule and ``total`` to one row per rule."""
    return row.unpivot(["total"], rules, "rule", "failed").select(
        "rule", F.lit(table).alias("table_name"), F.coalesce("failed", F.lit(0)).alias("failed"), "total"
    )


def _per_key(df: DataFrame, key: str) -> DataFrame:
    """Rows per trimmed key, empty as null; one very common key costs one row per task.

    All rules on one table and key start from this same plan, so Spark runs its
    shuffle once and reuses it.
    """
    return df.groupBy(F.nullif(F.trim(key), F.lit("")).alias("id")).agg(F.count(F.lit(1)).alias("n"))


def key_rules(df: DataFrame, table: str, key: str) -> DataFrame:
    """Rows with no key, and rows beyond the first of their key."""
    known = F.col("id").isNotNull()
    row = _per_key(df, key).agg(
        F.sum(F.when(~known, F.col("n")).otherwise(0)).alias("null_key"),
        F.sum(F.when(known, F.col("n") - 1).otherwise(0)).alias("duplicate_key"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
    )
    return _rules(row, table, ["null_key", "duplicate_key"])


def orphan_rule(df: DataFrame, parents: DataFrame, table: str, key: str, rule: str) -> DataFrame:
    """Rows whose key has no parent row; padded keys are the same key, rows without one are orphans."""
    known = _per_key(parents, key).select("id", F.lit(True).alias("known"))
    row = _per_key(df, key).join(known, "id", "left").agg(
        F.sum(F.when(F.col("known").isNull(), F.col("n")).otherwise(0)).alias(rule),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
    )
    return _rules(row, table, [rule])


def balance_rule(balances: DataFrame, table: str = "balance") -> DataFrame:
    """Rows where available and frozen amounts do not add up to the balance."""
    differs = F.col("balance") != F.col("avail_balance") + F.col("frozen_amt")
    row = balances.agg(
        F.count_if(differs).alias("balance_identity"), F.count(F.lit(1)).alias("total")
    )
    return _rules(row, table, ["balance_identity"])


def rejected_rule(raw: DataFrame, name: str) -> DataFrame:
    """Rows of an extract that lose a filled cell in the cast."""
    row = raw.agg(
        F.count_if(F.size(lost_cells(name)) > 0).alias("rejected_cells"), F.count(F.lit(1)).alias("total")
    )
    return _rules(row, name, ["rejected_cells"])


def drift_rule(today: DataFrame, before: DataFrame, table: str, tolerance: float = 0.5) -> DataFrame:
    """Fails (1 of 1) when the row count moved by more than the tolerated share of the earlier count."""
    counted, none = F.count(F.lit(1)), F.lit(0).cast("bigint")
    row = (
        today.agg(counted.alias("now"), none.alias("then"))
        .unionByName(before.agg(none.alias("now"), counted.alias("then")))
        .agg(F.sum("now").alias("now"), F.sum("then").alias("then"))
        .select(
            (F.abs(F.col("now") - F.col("then")) > F.col("then") * tolerance).cast("bigint").alias("row_count_drift"),
            F.lit(1).cast("bigint").alias("total"),
        )
    )
    return _rules(row, table, ["row_count_drift"])


def observed(raw: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """raw rows of an extract, and what is counted of them while they are written: no scan of their own.

    total, null_key, rejected_cells, and for balances balance_identity, as ``observed_rules`` shows them.
    """
    source = SOURCES[name]
    kinds = {f.name: f.dataType for f in source.schema}
    counted = {
        "total": F.count(F.lit(1)),
        "null_key": F.count_if(F.nullif(F.trim(source.key), F.lit("")).isNull()),
        "rejected_cells": F.count_if(F.size(lost_cells(name)) > 0),
    }
    if name == "balance":
        whole, available, frozen = (parse(F.col(c), kinds[c]) for c in ("balance", "avail_balance", "frozen_amt"))
        counted["balance_identity"] = F.count_if(whole != available + frozen)
    seen = Observation(f"load-{name}")
    return raw.observe(seen, *[c.alias(k) for k, c in counted.items()]), seen


def observed_rules(spark: SparkSession, found: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """(rule, table, failed, total) rows of what loads have counted, by table."""
    rows = [
        (rule, name, int(failed), int(counts["total"]))
        for name, counts in found.items() for rule, failed in counts.items() if rule != "total"
    ]
    return spark.createDataFrame(rows, "rule string, table_name string, failed long, total long")


def drift_of_counts(today: DataFrame, before: DataFrame, tolerance: float = 0.5) -> DataFrame:
    """``drift_rule`` of every table, from the totals of two days' ``observed_rules``; no table is read."""
    total = lambda df, name: df.groupBy("table_name").agg(F.max("total").alias(name))
    moved = F.abs(F.col("now") - F.col("then")) > F.col("then") * tolerance
    return total(today, "now").join(total(before, "then"), "table_name").select(
        F.lit("row_count_drift").alias("rule"), "table_name", moved.cast("bigint").alias("failed"), F.lit(1).cast("bigint").alias("total")
    )


def quality_report(
    sources: Mapping[str, DataFrame],
    before: Mapping[str, DataFrame] | None = None,
    tolerance: float = 0.5,
    counted: DataFrame | None = None,
    counted_before: DataFrame | None = None,
) -> DataFrame:
    """All rules over the day's sources; count drift needs the earlier day's as well.

    ``counted`` is what the day's load has observed, ``counted_before`` what the earlier day's has: rules
    that they answer read no table.
    """
    frames = [key_rules(df, name, SOURCES[name].key) for name, df in sources.items()]
    if "account" in sources:
        accounts = sources["account"]
        for name in ("balance", "transaction"):
            if name in sources:
                frames.append(orphan_rule(sources[name], accounts, name, "account_no", "orphan_account"))
        if "customer" in sources:
            frames.append(orphan_rule(accounts, sources["customer"], "account", "customer_id", "orphan_customer"))
    if counted is not None:
        frames.append(counted.where("rule in ('balance_identity', 'rejected_cells')"))
    elif "balance" in sources:
        frames.append(balance_rule(sources["balance"]))
    if counted is not None and counted_before is not None:
        frames.append(drift_of_counts(counted, counted_before, tolerance))
    else:
        for name, df in (before or {}).items():
            frames.append(drift_rule(sources[name], df, name, tolerance))
    return _union(frames)
