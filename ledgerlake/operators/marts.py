"""Vault tables to the customer summary and the management KPI table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.vault import ACCOUNT, CUSTOMER

MONEY = "decimal(18,2)"


@dataclass(frozen=True)
class SummaryInputs:
    """Typed source rows that fill the summary's optional columns."""

    loans: DataFrame
    transactions: DataFrame
    accounts: DataFrame


def customer_accounts(link: DataFrame) -> DataFrame:
    """Distinct customer-account pairs with the number of link rows behind each."""
    return link.groupBy(CUSTOMER.key, ACCOUNT.key).agg(F.count(F.lit(1)).alias("link_rows"))


def customer_summary(
    link: DataFrame, balances: DataFrame, extended: SummaryInputs | None = None, amount_type: str = MONEY
) -> DataFrame:
    """One row per customer that holds an account with a balance.

    Both sides are reduced before the join: balances to one row per account,
    links to one row per pair. No account can then multiply rows, the account
    count needs no distinct, and a customer holding very many accounts is summed
    map-side. A reduced balance times the link rows equals the row-by-row sum.
    An account shared by very many customers is split over tasks in the join by
    adaptive execution. Nothing runs while the plan is built.
    """
    # with a second grouping column the aggregate's partitioning does not serve the join, which then gets an exchange
    # of its own, and adaptive execution can split an account that very many customers share
    per_account = (
        balances.groupBy(ACCOUNT.key, F.xxhash64(ACCOUNT.key)).agg(F.sum("balance").alias("balance"))
        .select(ACCOUNT.key, "balance")
    )
    total = F.coalesce(F.sum(F.col("balance") * F.col("link_rows")), F.lit(0)).cast(amount_type)
    base = (
        customer_accounts(link).join(per_account, ACCOUNT.key)
        .groupBy(CUSTOMER.key)
        .agg(total.alias("total_asset_amt"), F.count(F.lit(1)).cast("int").alias("account_cnt"))
    )
    if extended is None:
        loan, txn_cnt, txn_amt, products = (F.lit(0), F.lit(0), F.lit(0), F.lit(1))
    else:
        base = (
            base.join(customer_loans(extended.loans), CUSTOMER.key, "left")
            .join(customer_transactions(extended.transactions, link), CUSTOMER.key, "left")
            .join(customer_products(extended.accounts), CUSTOMER.key, "left")
        )
        loan, txn_cnt, txn_amt, products = (
            F.coalesce(F.col(c), F.lit(0)) for c in ("loans", "txns", "txn_sum", "products")
        )
    return base.select(
        CUSTOMER.key,
        "total_asset_amt",
        F.col("total_asset_amt").alias("deposit_amt"),
        loan.cast(amount_type).alias("loan_amt"),
        txn_cnt.cast("bigint").alias("daily_txn_cnt"),
        txn_amt.cast(amount_type).alias("daily_txn_amt"),
        "account_cnt",
        products.cast("int").alias("product_holding_cnt"),
        F.current_timestamp().alias("etl_time"),
    )


def customer_loans(loans: DataFrame, status: str = "ACTIVE") -> DataFrame:
    """Amount of running loan contracts per customer."""
    return (
        loans.where(F.col("status") == status)
        .groupBy(CUSTOMER.key_of().alias(CUSTOMER.key))
        .agg(F.sum("loan_amt").alias("loans"))
    )


def customer_transactions(transactions: DataFrame, link: DataFrame) -> DataFrame:
    """Transaction count and amount per customer; summed per account number before anything is joined."""
    per_account = (
        transactions.groupBy("account_no")
        .agg(F.count(F.lit(1)).alias("txns"), F.sum("trans_amt").alias("txn_sum"))
        .select(ACCOUNT.key_of().alias(ACCOUNT.key), "txns", "txn_sum")
    )
    return (
        customer_accounts(link)
        .join(per_account, ACCOUNT.key)
        .groupBy(CUSTOMER.key)
        .agg(F.sum("txns").alias("txns"), F.sum("txn_sum").alias("txn_sum"))
    )


def customer_products(accounts: DataFrame) -> DataFrame:
    """Number of distinct products a customer's accounts belong to."""
    held = accounts.where(F.col("product_id").isNotNull()).select(
        CUSTOMER.key_of().alias(CUSTOMER.key), "product_id"
    ).distinct()
    return held.groupBy(CUSTOMER.key).agg(F.count(F.lit(1)).alias("products"))


# --- KPI table ------------------------------------------------------------------

# code: name, category, unit (fixed values)
KPI_LABELS = {
    "TOTAL_CUSTOMER": ("总客户数", "CUSTOMER", "COUNT"),
    "TOTAL_DEPOSIT": ("存款余额", "DEPOSIT", "YUAN"),
    "TOTAL_ACCOUNT": ("账户总数", "DEPOSIT", "COUNT"),
    "DAILY_TXN_CNT": ("当日交易笔数", "PAYMENT", "COUNT"),
    "DAILY_TXN_AMT": ("当日交易金额", "PAYMENT", "YUAN"),
    "TOTAL_LOAN": ("贷款合同数", "LOAN", "COUNT"),
    "TOTAL_CC": ("信用卡发卡量", "CREDIT_CARD", "COUNT"),
}


def _label(position: int) -> Column:
    pairs = [F.lit(x) for code, labels in KPI_LABELS.items() for x in (code, labels[position])]
    return F.create_map(*pairs)[F.col("kpi_code")]


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


def as_kpi_rows(values: DataFrame, *carried: str) -> DataFrame:
    """Tall (kpi_code, kpi_value) rows to the KPI table's columns, after any carried ones; changes start at zero."""
    no_change = F.lit(0).cast("decimal(5,2)")
    return values.select(
        *carried,
        "kpi_code",
        _label(0).alias("kpi_name"),
        _label(1).alias("kpi_category"),
        "kpi_value",
        _label(2).alias("kpi_unit"),
        no_change.alias("yoy_change"),
        no_change.alias("mom_change"),
        F.current_timestamp().alias("etl_time"),
    )


def management_kpis(vault: dict[str, DataFrame], value_type: str = "decimal(18,4)") -> DataFrame:
    """The seven KPIs of one day, tall.

    Each table is scanned once: the transaction count and amount share one
    aggregate. A total beyond ``value_type`` fails the job rather than turning
    null; pass a wider type for larger books.
    """
    aggregates = {
        "hub_customer": {"TOTAL_CUSTOMER": F.countDistinct("customer_hash_key")},
        "sat_balance": {"TOTAL_DEPOSIT": _total("balance")},
        "hub_account": {"TOTAL_ACCOUNT": F.countDistinct("account_hash_key")},
        "sat_transaction": {
            "DAILY_TXN_CNT": F.countDistinct("transaction_hash_key"),
            "DAILY_TXN_AMT": _total("trans_amt"),
        },
        "hub_loan": {"TOTAL_LOAN": F.countDistinct("contract_hash_key")},
        "hub_card": {"TOTAL_CC": F.countDistinct("card_hash_key")},
    }
    values = None
    for table, kpis in aggregates.items():
        row = vault[table].agg(*[agg.cast(value_type).alias(code) for code, agg in kpis.items()])
        tall = row.unpivot([], list(kpis), "kpi_code", "kpi_value")
        values = tall if values is None else values.unionByName(tall)
    return as_kpi_rows(values)


def with_kpi_changes(kpis: DataFrame, history: DataFrame, change_type: str = "decimal(5,2)") -> DataFrame:
    """Fill the year and month change, in percent, from the KPI rows of earlier days.

    Both frames carry ``dt``. A missing or zero earlier value gives null. A change
    beyond ``change_type`` fails the job rather than turning null; pass a wider
    type where values may grow more than tenfold.
    """

    def earlier(name: str) -> DataFrame:
        return history.select(
            "kpi_code", F.col("dt").alias(f"{name}_dt"), F.col("kpi_value").alias(f"{name}_value")
        )

    def change(name: str) -> Column:
        before = F.nullif(F.col(f"{name}_value"), F.lit(0))
        percent = (F.col("kpi_value") - before).cast("double") / before.cast("double") * 100
        return percent.cast(change_type).alias(f"{name}_change")

    rows = kpis.drop("yoy_change", "mom_change")
    for name, months in (("yoy", 12), ("mom", 1)):
        rows = rows.withColumn(f"{name}_dt", F.add_months(F.to_date("dt"), -months).cast("string"))
        rows = rows.join(earlier(name), ["kpi_code", f"{name}_dt"], "left")
    return rows.select(
        "dt", "kpi_code", "kpi_name", "kpi_category", "kpi_value", "kpi_unit", change("yoy"), change("mom"), "etl_time"
    )


def with_kpi_changes_asof(
    kpis: DataFrame, history: DataFrame, most_days: int = 10, change_type: str = "decimal(5,2)"
) -> DataFrame:
    """``with_kpi_changes`` where days may be missing: each value is held against the newest one at or before the shifted day.

    A value more than ``most_days`` older than that day counts as missing. yoy_dt and
    mom_dt tell the days compared with. Each row asks for the few days that may answer it, so the join is one of
    equal keys, and the newest answer is a grouped maximum.
    """

    def change(name: str) -> Column:
        before = F.nullif(F.col(f"{name}.value"), F.lit(0))
        percent = (F.col("kpi_value") - before).cast("double") / before.cast("double") * 100
        return percent.cast(change_type).alias(f"{name}_change")

    rows = kpis.drop("yoy_change", "mom_change")
    known = history.where(F.col("kpi_value").isNotNull()).select("kpi_code", F.col("dt").alias("day"), F.col("kpi_value").alias("value"))
    for name, months in (("yoy", 12), ("mom", 1)):
        shifted = F.add_months(F.to_date("dt"), -months)
        days = F.sequence(shifted - most_days, shifted).cast("array<string>")
        asked = rows.select("kpi_code", "dt", F.explode(days).alias("day")).distinct()
        answers = asked.join(known, ["kpi_code", "day"]).groupBy("kpi_code", "dt").agg(F.max(F.struct("day", "value")).alias(name))
        rows = rows.join(answers, ["kpi_code", "dt"], "left")
    return rows.select(
        "dt", "kpi_code", "kpi_name", "kpi_category", "kpi_value", "kpi_unit", change("yoy"), change("mom"),
        F.col("yoy.day").alias("yoy_dt"), F.col("mom.day").alias("mom_dt"), "etl_time",
    )
