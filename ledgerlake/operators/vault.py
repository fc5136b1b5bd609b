"""Source rows to hubs, satellites and links."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import keys
from ledgerlake.functions.predicates import CROSS_BANK_CHANNELS

OPEN_END = "9999-12-31"


@dataclass(frozen=True)
class Hub:
    """How one hub is keyed: source column, tag, hub name, and the two output columns."""

    table: str
    source: str
    tag: str
    hub: str
    source_id: str
    key: str
    business_id: str
    skip_null: bool = False

    def key_of(self, column: str | Column | None = None) -> Column:
        return keys.hub_key(self.tag, column if column is not None else self.source_id, self.hub)


# Tags, hub names and columns are part of the key contract.
HUBS: dict[str, Hub] = {
    h.table: h
    for h in (
        Hub("hub_customer", "customer", "CORE", keys.HUB_CUSTOMER, "customer_id", "customer_hash_key", "customer_id"),
        Hub("hub_account", "account", "CORE", keys.HUB_ACCOUNT, "account_no", "account_hash_key", "account_no"),
        Hub("hub_transaction", "transaction", "CORE", keys.HUB_TRANSACTION, "trans_id", "transaction_hash_key", "trans_id"),
        Hub("hub_loan", "loan", "LOAN", keys.HUB_LOAN_CONTRACT, "contract_no", "contract_hash_key", "contract_no"),
        Hub("hub_card", "card", "CC", keys.HUB_CC_CARD, "card_no", "card_hash_key", "card_no"),
        Hub("hub_product", "account", "CORE", keys.HUB_PRODUCT, "product_id", "product_hash_key", "product_id", True),
        Hub("hub_org", "account", "CORE", keys.HUB_ORG, "branch_id", "org_hash_key", "org_id", True),
    )
}

CUSTOMER = HUBS["hub_customer"]
ACCOUNT = HUBS["hub_account"]
TRANSACTION = HUBS["hub_transaction"]
LOAN = HUBS["hub_loan"]


def _load_date(dt: str) -> Column:
    return F.lit(dt).cast("date").alias("load_date")


def _stamp(tag: str) -> list[Column]:
    return [F.lit(tag).alias("record_source"), F.current_timestamp().alias("etl_time")]


def build_hub(rows: DataFrame, hub: Hub, dt: str) -> DataFrame:
    """Distinct business ids with their keys.

    The key follows from the id, so ids are made distinct first: only the id is
    shuffled, repeats are dropped before the shuffle, and each id is hashed once.
    """
    if hub.skip_null:
        rows = rows.where(F.col(hub.source_id).isNotNull())
    ids = rows.select(F.col(hub.source_id).alias(hub.business_id)).distinct()
    return ids.select(
        hub.key_of(hub.business_id).alias(hub.key), hub.business_id, _load_date(dt), *_stamp(hub.tag)
    )


def build_sat_customer(
    customers: DataFrame, dt: str, tracked: Iterable[str] = keys.TRACKED_ATTRIBUTES
) -> DataFrame:
    """Customer attributes as current versions."""
    return customers.select(
        CUSTOMER.key_of().alias(CUSTOMER.key),
        _load_date(dt),
        F.lit(OPEN_END).cast("date").alias("load_end_date"),
        F.lit(True).alias("is_current"),
        "cust_name", "id_type", "id_no", "mobile", "phone", "email", "address", "cust_type", "cust_level",
        "gender", "birth_date", "nationality", "occupation", "annual_income", "education", "open_date", "status",
        F.lit(CUSTOMER.tag).alias("record_source"),
        keys.hash_diff(tracked).alias("hash_diff"),
        F.current_timestamp().alias("etl_time"),
    )


def build_sat_balance(balances: DataFrame, accounts: DataFrame, dt: str) -> DataFrame:
    """Balances of known accounts, with the account's currency.

    Repeated account numbers multiply rows, as the contract has it; the
    duplicate rule in ``checks`` reports them.
    """
    currencies = accounts.select("account_no", "currency")
    return balances.join(currencies, "account_no").select(
        ACCOUNT.key_of().alias(ACCOUNT.key),
        _load_date(dt),
        "balance", "avail_balance", "frozen_amt", "currency",
        F.col("last_update").alias("last_txn_time"),
        *_stamp(ACCOUNT.tag),
    )


def build_sat_transaction(transactions: DataFrame, dt: str) -> DataFrame:
    """Transaction facts, one row per source row."""
    no_account = F.lit(None).cast("string")
    return transactions.select(
        TRANSACTION.key_of().alias(TRANSACTION.key),
        _load_date(dt),
        F.to_date("trans_time").alias("trans_date"),
        "trans_time", "trans_type", "trans_amt",
        F.lit("CNY").alias("currency"),
        "dr_cr_flag",
        no_account.alias("from_account_no"),
        no_account.alias("to_account_no"),
        "channel", "teller_id",
        F.col("opp_account").alias("opp_account_no"),
        "memo",
        F.lit("SUCCESS").alias("trans_status"),
        F.coalesce(F.col("channel").isin(*CROSS_BANK_CHANNELS), F.lit(False)).alias("is_cross_bank"),
        *_stamp(TRANSACTION.tag),
    )


def build_link_cust_acct(accounts: DataFrame, dt: str) -> DataFrame:
    """Customer to account relations, one row per account row."""
    hashed = accounts.select(
        CUSTOMER.key_of().alias(CUSTOMER.key), ACCOUNT.key_of().alias(ACCOUNT.key), "open_date"
    )
    return hashed.select(
        keys.link_key(F.col(CUSTOMER.key), F.col(ACCOUNT.key), "PRIMARY", "LINK_CUST_ACCT").alias("cust_acct_hash_key"),
        CUSTOMER.key, ACCOUNT.key,
        F.lit("PRIMARY").alias("rel_type"),
        F.col("open_date").cast("date").alias("rel_start_date"),
        F.lit(None).cast("date").alias("rel_end_date"),
        F.lit(True).alias("is_active"),
        _load_date(dt),
        *_stamp(ACCOUNT.tag),
    )


def build_link_cust_loan(loans: DataFrame, dt: str) -> DataFrame:
    """Customer to loan contract relations, one row per contract row."""
    hashed = loans.select(CUSTOMER.key_of().alias(CUSTOMER.key), LOAN.key_of().alias(LOAN.key), "start_date", "end_date")
    return hashed.select(
        keys.link_key(F.col(CUSTOMER.key), F.col(LOAN.key), "BORROWER", "LINK_CUST_LOAN").alias("cust_loan_hash_key"),
        CUSTOMER.key, LOAN.key,
        F.lit("BORROWER").alias("rel_type"),
        F.col("start_date").alias("rel_start_date"),
        F.col("end_date").alias("rel_end_date"),
        F.lit(True).alias("is_active"),
        _load_date(dt),
        *_stamp(LOAN.tag),
    )


def build_link_txn_acct(transactions: DataFrame, dt: str) -> DataFrame:
    """Transaction to account relations, one row per distinct pair; ids that differ in padding only are one."""
    pairs = transactions.select(
        *[F.coalesce(F.trim(c), F.lit("")).alias(c) for c in ("trans_id", "account_no")]
    ).distinct()
    hashed = pairs.select(TRANSACTION.key_of().alias(TRANSACTION.key), ACCOUNT.key_of().alias(ACCOUNT.key))
    return hashed.select(
        keys.link_key(F.col(TRANSACTION.key), F.col(ACCOUNT.key), "BOOKED", "LINK_TXN_ACCT").alias("txn_acct_hash_key"),
        TRANSACTION.key, ACCOUNT.key,
        F.lit("BOOKED").alias("rel_type"),
        _load_date(dt),
        *_stamp(TRANSACTION.tag),
    )


def build_vault(
    sources: dict[str, DataFrame], dt: str, tracked: Iterable[str] = keys.TRACKED_ATTRIBUTES
) -> dict[str, DataFrame]:
    """All hubs, satellites and the customer-account link of one day, by table name."""
    tables = {name: build_hub(sources[hub.source], hub, dt) for name, hub in HUBS.items()}
    tables["sat_customer"] = build_sat_customer(sources["customer"], dt, tracked)
    tables["sat_balance"] = build_sat_balance(sources["balance"], sources["account"], dt)
    tables["sat_transaction"] = build_sat_transaction(sources["transaction"], dt)
    tables["link_cust_acct"] = build_link_cust_acct(sources["account"], dt)
    return tables
