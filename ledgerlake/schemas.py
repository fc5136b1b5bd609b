"""Columns, types and layout of every staged source, table and stream row.

The names, types, key columns, bucket counts and codecs below are a data
contract shared with existing files and SQL users: fixed values, kept as text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import types as T

_SIMPLE = {
    t.simpleString(): t
    for t in (T.StringType(), T.DateType(), T.TimestampType(), T.IntegerType(), T.LongType(), T.BooleanType())
}


def struct(columns: str) -> T.StructType:
    """Struct of 'name type, …'; unlike ``StructType.fromDDL`` it needs no running session."""
    fields = []
    for name, kind, precision, scale in re.findall(r"(\w+) (\w+)(?:\((\d+),(\d+)\))?", columns):
        data_type = T.DecimalType(int(precision), int(scale)) if precision else _SIMPLE[kind]
        fields.append(T.StructField(name, data_type))
    return T.StructType(fields)


# --- staged sources (fixed values) -----------------------------------------

AUDIT = "ingest_time timestamp, source_system string, batch_id string"


@dataclass(frozen=True)
class Source:
    """One tab-separated extract: where it is staged, its tag and its typed columns."""

    name: str
    tag: str
    system: str
    stage: str
    key: str
    columns: str

    @property
    def schema(self) -> T.StructType:
        return struct(self.columns)

    def stage_path(self, stage_root: str, dt: str) -> str:
        return f"{stage_root}/{self.system}/{self.stage}/dt={dt}"


SOURCES: dict[str, Source] = {
    s.name: s
    for s in (
        Source(
            "customer", "CORE", "core", "t_customer", "customer_id",
            "customer_id string, cust_name string, id_type string, id_no string, mobile string, phone string, "
            "email string, address string, cust_type string, cust_level string, gender string, birth_date date, "
            "nationality string, occupation string, annual_income decimal(18,2), education string, open_date date, "
            "close_date date, status string, create_date date, update_time timestamp",
        ),
        Source(
            "account", "CORE", "core", "t_account", "account_no",
            "account_no string, customer_id string, acct_type string, currency string, open_date date, "
            "status string, branch_id string, product_id string",
        ),
        Source(
            "balance", "CORE", "core", "t_account_balance", "account_no",
            "account_no string, balance decimal(18,2), avail_balance decimal(18,2), frozen_amt decimal(18,2), "
            "last_update timestamp",
        ),
        Source(
            "transaction", "CORE", "core", "t_transaction", "trans_id",
            "trans_id string, account_no string, trans_type string, trans_amt decimal(18,2), dr_cr_flag string, "
            "trans_time timestamp, channel string, teller_id string, opp_account string, memo string",
        ),
        Source(
            "payment", "PAY", "pay", "t_payment_flow", "pay_id",
            "pay_id string, order_no string, payer_acct string, payee_acct string, amount decimal(18,2), "
            "pay_channel string, pay_status string, create_time timestamp, complete_time timestamp",
        ),
        Source(
            "loan", "LOAN", "loan", "t_loan_contract", "contract_no",
            "contract_no string, customer_id string, loan_type string, loan_amt decimal(18,2), rate decimal(9,6), "
            "rate_type string, term int, repay_method string, sign_date date, start_date date, end_date date, "
            "guarantee_type string, loan_purpose string, status string",
        ),
        Source(
            "card", "CC", "cc", "t_cc_card", "card_no",
            "card_no string, customer_id string, card_type string, card_level string, credit_limit decimal(18,2), "
            "open_date date, expire_date date, status string",
        ),
        Source(
            "ebank", "EBANK", "ebank", "t_ebank_transaction", "trans_id",
            "trans_id string, customer_id string, trans_type string, amount decimal(18,2), from_acct string, "
            "to_acct string, channel string, trans_time timestamp",
        ),
    )
}

# --- tables (fixed values) --------------------------------------------------


@dataclass(frozen=True)
class Table:
    """A day-partitioned table; ``buckets`` applies only to catalog tables."""

    name: str
    database: str
    physical: str
    columns: str
    compression: str = "zlib"
    bucket_by: str | None = None
    buckets: int = 0

    @property
    def schema(self) -> T.StructType:
        return struct(self.columns)

    @property
    def qualified(self) -> str:
        return f"{self.database}.{self.physical}"

    def with_buckets(self, buckets: int, bucket_by: str | None = None) -> Table:
        """The same table with another layout: bucket counts must grow with the data."""
        return replace(self, buckets=buckets, bucket_by=bucket_by or self.bucket_by)


def _ods(source: Source) -> Table:
    physical = f"ods_{source.system}_{source.stage}"
    return Table(f"ods_{source.name}", "bank_ods", physical, f"{source.columns}, {AUDIT}", "snappy")


def _dwd(name: str, physical: str, columns: str, bucket_by: str) -> Table:
    return Table(name, "bank_dwd", physical, columns, "zlib", bucket_by, 32)


def _hub(name: str, physical: str, key: str, business_id: str) -> Table:
    columns = f"{key} string, {business_id} string, load_date date, record_source string, etl_time timestamp"
    return _dwd(name, physical, columns, key)


TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        *(_ods(s) for s in SOURCES.values()),
        _hub("hub_customer", "dwd_hub_customer", "customer_hash_key", "customer_id"),
        _hub("hub_account", "dwd_hub_account", "account_hash_key", "account_no"),
        _hub("hub_transaction", "dwd_hub_transaction", "transaction_hash_key", "trans_id"),
        _hub("hub_loan", "dwd_hub_loan_contract", "contract_hash_key", "contract_no"),
        _hub("hub_card", "dwd_hub_cc_card", "card_hash_key", "card_no"),
        _hub("hub_product", "dwd_hub_product", "product_hash_key", "product_id"),
        _hub("hub_org", "dwd_hub_org", "org_hash_key", "org_id"),
        _dwd(
            "sat_customer", "dwd_sat_customer_info",
            "customer_hash_key string, load_date date, load_end_date date, is_current boolean, cust_name string, "
            "id_type string, id_no string, mobile string, phone string, email string, address string, "
            "cust_type string, cust_level string, gender string, birth_date date, nationality string, "
            "occupation string, annual_income decimal(18,2), education string, open_date date, status string, "
            "record_source string, hash_diff string, etl_time timestamp",
            "customer_hash_key",
        ),
        _dwd(
            "sat_balance", "dwd_sat_account_bal",
            "account_hash_key string, load_date date, balance decimal(18,2), avail_balance decimal(18,2), "
            "frozen_amt decimal(18,2), currency string, last_txn_time timestamp, record_source string, "
            "etl_time timestamp",
            "account_hash_key",
        ),
        _dwd(
            "sat_transaction", "dwd_sat_transaction",
            "transaction_hash_key string, load_date date, trans_date date, trans_time timestamp, "
            "trans_type string, trans_amt decimal(18,2), currency string, dr_cr_flag string, "
            "from_account_no string, to_account_no string, channel string, teller_id string, "
            "opp_account_no string, memo string, trans_status string, is_cross_bank boolean, "
            "record_source string, etl_time timestamp",
            "transaction_hash_key",
        ),
        _dwd(
            "link_cust_acct", "dwd_link_cust_acct",
            "cust_acct_hash_key string, customer_hash_key string, account_hash_key string, rel_type string, "
            "rel_start_date date, rel_end_date date, is_active boolean, load_date date, record_source string, "
            "etl_time timestamp",
            "cust_acct_hash_key",
        ),
        Table(
            "cust_daily_summary", "bank_dws", "dws_cust_daily_summary",
            "customer_hash_key string, total_asset_amt decimal(18,2), deposit_amt decimal(18,2), "
            "loan_amt decimal(18,2), daily_txn_cnt bigint, daily_txn_amt decimal(18,2), account_cnt int, "
            "product_holding_cnt int, etl_time timestamp",
            bucket_by="customer_hash_key", buckets=16,
        ),
        Table(
            "mgmt_kpi", "bank_ads", "ads_mgmt_kpi",
            "kpi_code string, kpi_name string, kpi_category string, kpi_value decimal(18,4), kpi_unit string, "
            "yoy_change decimal(5,2), mom_change decimal(5,2), etl_time timestamp",
        ),
    )
}

# --- stream row and change envelope (fixed values) --------------------------

STREAM_TOPIC = "bank.ods.core.t_transaction"

STREAM_ROW = struct(
    "trans_id string, account_no string, trans_type string, trans_amt decimal(18,2), dr_cr_flag string, "
    "trans_time string, channel string, opp_account string, memo string, producer_time string"
)

# Flat change message: one envelope per statement, every cell as text.
CHANGE_ROW = struct(
    "trans_id string, account_no string, trans_type string, trans_amt string, dr_cr_flag string, "
    "trans_time string, channel string, opp_account string, memo string"
)
CHANGE_ENVELOPE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("database", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("es", T.LongType()),
        T.StructField("ts", T.LongType()),
        T.StructField("isDdl", T.BooleanType()),
        T.StructField("data", T.ArrayType(CHANGE_ROW)),
        T.StructField("old", T.ArrayType(CHANGE_ROW)),
    ]
)
