"""The benchmark star schema seen as the eight bank sources.

customer → orders → lineitem stands for customer → account → transaction;
``events`` gives time of day and the live feed. Plain timestamps without a zone
become session-zone timestamps, which watermarks need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.schemas import SOURCES, STREAM_ROW

DAY = "2024-01-31"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shaped(df: DataFrame, name: str, **columns: Column) -> DataFrame:
    """The source's typed columns from the given expressions; the others null."""
    return df.select(
        *[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in SOURCES[name].schema]
    )


def _padded(prefix: str, column: str, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(F.col(column).cast("string"), width, "0"))


def customer_id(column: str) -> Column:
    return _padded("CUST", column, 8)


def account_no(column: str) -> Column:
    return _padded("6222", column, 14)


def _day(start: str, column: str, cycle: int) -> Column:
    """A day up to `cycle` days after `start`, from a key."""
    return F.date_add(F.lit(start).cast("date"), (F.col(column) % cycle).cast("int"))


def event_channel() -> Column:
    kind = F.col("user_id") % 4
    return (
        F.when(kind == 0, "ALIPAY").when(kind == 1, "WECHAT_PAY").when(kind == 2, "ATM").otherwise("COUNTER_HIGH")
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return shaped(
        joined, "customer",
        customer_id=customer_id("c_custkey"),
        cust_name=F.col("c_name"),
        cust_type=F.when(F.col("c_custkey") % 2 == 0, "PERSONAL").otherwise("CORPORATE"),
        cust_level=F.col("c_mktsegment"),
        nationality=F.col("n_name"),
        annual_income=F.col("c_acctbal"),
        gender=F.when(F.col("c_custkey") % 3 == 0, "F").when(F.col("c_custkey") % 3 == 1, "M"),
        birth_date=_day("1950-01-01", "c_custkey", 18000),
        open_date=_day("2010-01-01", "c_custkey", 4000),
        create_date=_day("2010-01-02", "c_custkey", 4000),
        update_time=F.timestamp_seconds(F.lit(1600000000) + F.col("c_custkey")),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")
    )
    status = F.col("o_orderstatus")
    return shaped(
        joined, "account",
        account_no=account_no("o_orderkey"),
        customer_id=customer_id("o_custkey"),
        acct_type=F.col("o_orderpriority"),
        currency=F.when(F.col("o_orderkey") % 20 == 0, "USD").otherwise("CNY"),
        open_date=F.col("o_orderdate"),
        status=F.when(status == "O", "NORMAL").when(status == "F", "FROZEN").otherwise("DORMANT"),
        branch_id=F.concat(F.lit("ORG"), F.col("c_nationkey").cast("string")),
        product_id=F.concat(F.lit("PROD_"), F.col("o_orderpriority")),
    )


def balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice")).otherwise(0).cast("decimal(18,2)")
    priority = F.col("o_orderpriority")
    return shaped(
        table(spark, sf_dir, "orders"), "balance",
        account_no=account_no("o_orderkey"),
        balance=amount,
        avail_balance=F.when(priority.isin("1-URGENT", "2-HIGH"), 0).otherwise(amount),
        frozen_amt=F.when(priority == "1-URGENT", amount).otherwise(0),
        last_update=F.col("o_orderdate"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items: volume, accounts to join, and repeated ids."""
    flag = F.col("l_returnflag")
    return shaped(
        table(spark, sf_dir, "lineitem"), "transaction",
        trans_id=F.concat(F.lit("TXN"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")),
        account_no=account_no("l_orderkey"),
        trans_type=flag,
        trans_amt=F.col("l_extendedprice"),
        dr_cr_flag=F.when(F.col("l_linestatus") == "O", "C").otherwise("D"),
        trans_time=F.col("l_shipdate"),
        channel=F.when(flag == "A", "ALIPAY").when(flag == "R", "UNIONPAY").otherwise("ATM"),
    )


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events: time of day, channels, few accounts."""
    return shaped(
        table(spark, sf_dir, "events"), "transaction",
        trans_id=_padded("EVT", "event_id", 10),
        account_no=account_no("user_id"),
        trans_type=F.col("event_type"),
        trans_amt=F.col("value"),
        dr_cr_flag=F.when(F.col("event_type").isin("signup", "click"), "C").otherwise("D"),
        trans_time=F.col("ts"),
        channel=event_channel(),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return shaped(
        table(spark, sf_dir, "events"), "payment",
        pay_id=_padded("PAY", "event_id", 10),
        amount=F.col("value"),
        pay_status=F.when(kind == "error", "FAILED").when(kind == "signup", "PENDING").otherwise("SUCCESS"),
        create_time=F.col("ts"),
    )


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaped(
        table(spark, sf_dir, "supplier"), "loan",
        contract_no=_padded("LOAN", "s_suppkey", 8),
        customer_id=customer_id("s_suppkey"),
        loan_amt=F.col("s_acctbal"),
        rate=(F.col("s_suppkey") % 9 + 1).cast("decimal(9,6)") / 100,
        term=F.col("s_suppkey") % 36 + 6,
        sign_date=_day("2022-01-01", "s_suppkey", 700),
        start_date=_day("2022-01-08", "s_suppkey", 700),
        end_date=_day("2025-01-08", "s_suppkey", 700),
        status=F.when(F.col("s_suppkey") % 4 == 0, "SETTLED").otherwise("ACTIVE"),
    )


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaped(
        table(spark, sf_dir, "customer"), "card",
        card_no=_padded("6228", "c_custkey", 14),
        customer_id=customer_id("c_custkey"),
        card_level=F.col("c_mktsegment"),
        credit_limit=F.abs("c_acctbal"),
        open_date=_day("2018-01-01", "c_custkey", 2000),
        expire_date=_day("2028-01-01", "c_custkey", 2000),
        status=F.lit("ACTIVE"),
    )


def ebank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaped(
        table(spark, sf_dir, "events"), "ebank",
        trans_id=_padded("EBK", "event_id", 10),
        customer_id=customer_id("user_id"),
        trans_type=F.col("event_type"),
        amount=F.col("value"),
        trans_time=F.col("ts"),
    )


BUILDERS = {
    "customer": customers,
    "account": accounts,
    "balance": balances,
    "transaction": transactions,
    "payment": payments,
    "loan": loans,
    "card": cards,
    "ebank": ebank,
}


def sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf_dir) for name, build in BUILDERS.items()}


# --- daily snapshots for history ---------------------------------------------------


# Accounts live on the first of two days are those opened before the second of these, on the second those opened after
# the first: some end, some begin, and both days together hold every order.
OPENED = ("1997-01-01", "1999-07-01")


def _live_orders(spark: SparkSession, sf_dir: str, first_day: bool) -> DataFrame:
    """Orders that the bank would see as live accounts on the first or second of two days."""
    opened = F.to_date("o_orderdate")
    live = opened < F.lit(OPENED[1]).cast("date") if first_day else opened >= F.lit(OPENED[0]).cast("date")
    return table(spark, sf_dir, "orders").where(live)


def customer_snapshot(spark: SparkSession, sf_dir: str, first_day: bool) -> DataFrame:
    """Customers with a live order; level and status are those of their newest order."""
    newest = F.max(F.struct("o_orderdate", "o_orderkey", "o_orderpriority", "o_orderstatus")).alias("newest")
    live = _live_orders(spark, sf_dir, first_day).groupBy("o_custkey").agg(newest)
    named = live.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return shaped(
        named, "customer",
        customer_id=customer_id("c_custkey"),
        cust_name=F.col("c_name"),
        cust_level=F.col("newest.o_orderpriority"),
        status=F.col("newest.o_orderstatus"),
    )


def account_snapshot(spark: SparkSession, sf_dir: str, first_day: bool) -> DataFrame:
    return shaped(
        _live_orders(spark, sf_dir, first_day), "account",
        account_no=account_no("o_orderkey"),
        customer_id=customer_id("o_custkey"),
        open_date=F.col("o_orderdate"),
    )


# --- the live feed -------------------------------------------------------------------


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON rows of the transaction topic."""
    rows = event_transactions(spark, sf_dir)
    text = F.date_format("trans_time", "yyyy-MM-dd HH:mm:ss")
    columns = {"trans_time": text, "producer_time": text}
    return rows.select(
        F.to_json(
            F.struct(*[
                columns.get(f.name, F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in STREAM_ROW
            ])
        ).alias("value")
    )


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as change envelopes, one per event, keyed by user: sign-ups insert, errors delete, the rest update."""
    kind = F.col("event_type")
    row = F.struct(
        F.concat(F.lit("ACCT"), F.col("user_id").cast("string")).alias("trans_id"),
        account_no("user_id").alias("account_no"),
        kind.alias("trans_type"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("trans_amt"),
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss").alias("trans_time"),
        event_channel().alias("channel"),
    )
    envelope = F.struct(
        F.col("event_id").alias("id"),
        F.lit("bank_source").alias("database"),
        F.lit("t_transaction").alias("table"),
        F.when(kind == "signup", "INSERT").when(kind == "error", "DELETE").otherwise("UPDATE").alias("type"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("es"),
        F.lit(False).alias("isDdl"),
        F.array(row).alias("data"),
    )
    return table(spark, sf_dir, "events").select(F.to_json(envelope).alias("value"))
