from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlake.operators import vault
from ledgerlake.schemas import TABLES

DT = "2026-06-14"
ACCOUNT = "account_no string, customer_id string, acct_type string, currency string, open_date date, status string, branch_id string, product_id string"


def accounts(spark, *rows):
    filled = [(a, c, "DEMAND", cur, date(2020, 1, 1), "NORMAL", b, p) for a, c, cur, b, p in rows]
    return spark.createDataFrame(filled, ACCOUNT)


def balances(spark, *rows):
    return spark.createDataFrame(
        [(a, Decimal(b), Decimal(b), Decimal(0), datetime(2026, 6, 14)) for a, b in rows],
        "account_no string, balance decimal(18,2), avail_balance decimal(18,2), frozen_amt decimal(18,2), last_update timestamp",
    )


def test_hub_rows_are_distinct_by_id_not_by_key(spark):
    rows = accounts(spark, ("A", "C", "CNY", "B", "P"), ("A", "C", "CNY", "B", "P"), (" A", "C", "CNY", "B", "P"))
    hub = vault.build_hub(rows, vault.HUBS["hub_account"], DT).collect()
    assert sorted(r.account_no for r in hub) == [" A", "A"]
    assert len({r.account_hash_key for r in hub}) == 1
    assert {r.load_date for r in hub} == {date(2026, 6, 14)}


def test_only_product_and_org_skip_nulls(spark):
    rows = accounts(spark, (None, None, "CNY", None, None), ("A", "C", "CNY", "B", "P"))
    assert vault.build_hub(rows, vault.HUBS["hub_account"], DT).count() == 2
    assert vault.build_hub(rows, vault.HUBS["hub_product"], DT).count() == 1
    org = vault.build_hub(rows, vault.HUBS["hub_org"], DT)
    assert [r.org_id for r in org.collect()] == ["B"]


def test_balance_satellite_keeps_known_accounts_and_fans_out_repeats(spark):
    acct = accounts(spark, ("A", "C", "CNY", "B", "P"), ("A", "D", "USD", "B", "P"), ("X", "C", "CNY", "B", "P"))
    sat = vault.build_sat_balance(balances(spark, ("A", "5"), ("Z", "9")), acct, DT).collect()
    assert sorted((r.currency, r.balance) for r in sat) == [("CNY", Decimal("5.00")), ("USD", Decimal("5.00"))]


def test_transaction_satellite(spark):
    rows = spark.createDataFrame(
        [("T1", "A", "X", Decimal(1), "C", datetime(2026, 6, 14, 23, 59), c, None, "O", "m") for c in ("ALIPAY", "ATM", None)],
        "trans_id string, account_no string, trans_type string, trans_amt decimal(18,2), dr_cr_flag string, "
        "trans_time timestamp, channel string, teller_id string, opp_account string, memo string",
    )
    sat = vault.build_sat_transaction(rows, DT)
    assert [(r.channel, r.is_cross_bank) for r in sat.collect()] == [("ALIPAY", True), ("ATM", False), (None, False)]
    first = sat.first()
    assert (first.trans_date, first.currency, first.trans_status) == (date(2026, 6, 14), "CNY", "SUCCESS")
    assert dict(sat.dtypes)["from_account_no"] == "string"


def test_schemas_of_all_vault_tables(spark, sf_dir):
    from ledgerlake.plans import fixtures

    for name, df in vault.build_vault(fixtures.sources(spark, sf_dir), DT).items():
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in TABLES[name].schema], name


def test_hub_shuffles_only_the_id(spark, sf_dir):
    from ledgerlake.plans import fixtures

    plan = vault.build_hub(fixtures.transactions(spark, sf_dir), vault.TRANSACTION, DT)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "keys=[trans_id" in plan
    assert "md5(" not in plan.split("Exchange")[1]  # hashed after the shuffle, once per id


def test_a_hot_account_is_split_in_the_balance_join(spark):
    """A third of all balances on one account: the join splits its partition and gives every row."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    ids = spark.range(0, 60_000, 1, 6)
    number = F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("A"), F.col("id").cast("string")))
    balance = ids.select(
        number.alias("account_no"), F.col("id").cast("decimal(18,2)").alias("balance"),
        F.lit(0).cast("decimal(18,2)").alias("avail_balance"), F.lit(0).cast("decimal(18,2)").alias("frozen_amt"),
        F.lit(None).cast("timestamp").alias("last_update"))
    acct = ids.where((F.col("id") % 3 != 0) | (F.col("id") == 0)).select(
        number.alias("account_no"), F.lit("CNY").alias("currency"))
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        sat = vault.build_sat_balance(balance, acct, DT)
        rows = sat.select("balance").collect()
        plan = sat.select("balance")
        plan.collect()
        assert "Join(skew=true)" in plan._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert len(rows) == 60_000 and sum(r.balance for r in rows) == sum(range(60_000))
