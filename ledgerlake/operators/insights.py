"""Dashboard and risk queries over the tables of one day.

Groups are low in number (hours, channels, bands), so every aggregate is
combined map-side; every top-k ends in a key so that ties have one order.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.display import auto_text, card_text, in_wan, masked_name
from ledgerlake.functions.predicates import HIGH_AMOUNT, LARGE_AMOUNT, is_large, is_night, risk_level
from ledgerlake.operators.vault import CUSTOMER, TRANSACTION
from ledgerlake.session import scratch_dir

MONEY = "decimal(18,2)"

# Lower bound and label of each asset band, highest first (fixed values).
AUM_BANDS = (
    (10_000_000, "1000万+"),
    (5_000_000, "500-1000万"),
    (1_000_000, "100-500万"),
    (500_000, "50-100万"),
    (100_000, "10-50万"),
    (10_000, "1-10万"),
)
LOWEST_BAND = "1万以下"


def _count() -> Column:
    return F.count(F.lit(1)).alias("cnt")


def _sum(column: str, amount_type: str) -> Column:
    return F.sum(column).cast(amount_type)


def kpi_list(kpis: DataFrame, value_type: str = MONEY) -> DataFrame:
    """KPIs in code order."""
    return kpis.select(
        "kpi_code", "kpi_name", F.col("kpi_value").cast(value_type).alias("kpi_value"), "kpi_unit"
    ).orderBy("kpi_code")


def kpi_text(kpis: DataFrame) -> DataFrame:
    """KPIs in code order, values as text."""
    return kpis.select(
        "kpi_code", "kpi_name", F.col("kpi_value").cast("string").alias("kpi_value"), "kpi_unit"
    ).orderBy("kpi_code")


def kpi_cards(kpis: DataFrame) -> DataFrame:
    """KPI values as card texts: plain, in 亿, in 万, and in the unit that fits."""
    value = F.col("kpi_value")
    return kpis.select(
        "kpi_code",
        card_text(value).alias("number_text"),
        card_text(value, "yi").alias("yi_text"),
        card_text(value, "wan").alias("wan_text"),
        auto_text(value).alias("auto_text"),
    ).orderBy("kpi_code")


def aum_band(amount: Column, bands=AUM_BANDS, lowest: str = LOWEST_BAND) -> Column:
    (bound, label), *rest = bands
    band = F.when(amount >= bound, label)
    for bound, label in rest:
        band = band.when(amount >= bound, label)
    return band.otherwise(lowest)


def aum_distribution(summary: DataFrame, bands=AUM_BANDS) -> DataFrame:
    """Customers per asset band, lowest band first."""
    amount = F.col("total_asset_amt")
    return (
        summary.groupBy(aum_band(amount, bands).alias("bucket"))
        .agg(_count(), F.min(amount).alias("lowest"))
        .orderBy("lowest")
        .select("bucket", "cnt")
    )


def hourly_trend(transactions: DataFrame, amount_type: str = MONEY) -> DataFrame:
    """Count and amount per hour of day."""
    return (
        transactions.groupBy(F.hour("trans_time").alias("hour"))
        .agg(_count(), _sum("trans_amt", amount_type).alias("amt"))
        .orderBy("hour")
    )


def hourly_counts(transactions: DataFrame) -> DataFrame:
    """Count per hour of day."""
    return transactions.groupBy(F.hour("trans_time").alias("hour")).agg(_count()).orderBy("hour")


def channel_distribution(transactions: DataFrame, amount_type: str = MONEY) -> DataFrame:
    """Count and amount per channel, busiest first."""
    return (
        transactions.groupBy("channel")
        .agg(_count(), _sum("trans_amt", amount_type).alias("amt"))
        .orderBy(F.desc("cnt"), "channel")
    )


def channel_counts(transactions: DataFrame, top: int | None = None) -> DataFrame:
    """Count per channel, busiest first; ``top`` is 8 on the static page, 6 on the web page."""
    counts = transactions.groupBy("channel").agg(_count()).orderBy(F.desc("cnt"), "channel")
    return counts if top is None else counts.limit(top)


def account_types(accounts: DataFrame) -> DataFrame:
    """Accounts per type, commonest first."""
    return (
        accounts.groupBy(F.col("acct_type").alias("type")).agg(_count()).orderBy(F.desc("cnt"), "type")
    )


def _customers_by_assets(summary: DataFrame, customers: DataFrame, top: int) -> DataFrame:
    named = customers.where("is_current").select(CUSTOMER.key, "cust_name")
    return (
        summary.select(CUSTOMER.key, "total_asset_amt")
        .join(named, CUSTOMER.key)
        .orderBy(F.desc("total_asset_amt"), CUSTOMER.key, "cust_name")
        .limit(top)
    )


def top_customers(summary: DataFrame, customers: DataFrame, top: int = 15) -> DataFrame:
    """Customers with the largest assets. ``customers`` is the satellite of the same day."""
    return _customers_by_assets(summary, customers, top).select(
        "cust_name", F.col("total_asset_amt").cast(MONEY).alias("amt")
    )


def masked_top_customers(summary: DataFrame, customers: DataFrame, top: int = 20) -> DataFrame:
    """Customers with the largest assets, names masked, with the chart value in ten-thousands."""
    return _customers_by_assets(summary, customers, top).select(
        masked_name(F.col("cust_name")).alias("name"),
        F.col("total_asset_amt").cast("double").alias("amt"),
        in_wan(F.col("total_asset_amt")).alias("amt_wan"),
    )


def transaction_summary(transactions: DataFrame, amount_type: str = MONEY) -> DataFrame:
    """Count, amount, average and successes, one row."""
    return transactions.agg(
        F.count(F.lit(1)).alias("total_cnt"),
        _sum("trans_amt", amount_type).alias("total_amt"),
        F.avg("trans_amt").cast(amount_type).alias("avg_amt"),
        F.sum(F.when(F.col("trans_status") == "SUCCESS", 1).otherwise(0)).alias("success_cnt"),
    )


def recent_transactions(transactions: DataFrame, top: int = 20) -> DataFrame:
    """Latest transactions; equal times go by key, then amount."""
    return (
        transactions.orderBy(F.desc("trans_time"), TRANSACTION.key, F.desc("trans_amt"), "trans_type", "channel")
        .limit(top)
        .select(
            TRANSACTION.key,
            F.col("trans_date").cast("string").alias("trans_date"),
            F.col("trans_time").cast("string").alias("trans_time"),
            "trans_type",
            F.col("trans_amt").cast(MONEY).alias("trans_amt"),
            "channel",
            "trans_status",
        )
    )


# Published pass and abnormal rate (fixed values).
PASS_RATE = 99.85
ABNORMAL_RATE = 0.15


def risk_overview(
    transactions: DataFrame,
    large: Decimal = LARGE_AMOUNT,
    computed_rates: bool = False,
    amount_type: str = MONEY,
) -> DataFrame:
    """Totals, large and night transactions, one row.

    The rates are the published constants unless ``computed_rates``: then the
    abnormal rate is the share of large transactions, in percent.
    """
    amount = F.col("trans_amt")
    large_cnt = F.sum(F.when(is_large(amount, large), 1).otherwise(0))
    if computed_rates:
        abnormal = F.round(F.try_divide(large_cnt * 100.0, F.count(F.lit(1))), 4)
        pass_rate = F.round(100.0 - abnormal, 4)
    else:
        abnormal, pass_rate = F.lit(ABNORMAL_RATE), F.lit(PASS_RATE)
    return transactions.agg(
        F.count(F.lit(1)).alias("total_txn"),
        large_cnt.alias("large_txn_cnt"),
        F.sum(F.when(is_large(amount, large), amount).otherwise(0)).cast(amount_type).alias("large_txn_amt"),
        F.sum(F.when(is_night(F.col("trans_time")), 1).otherwise(0)).alias("night_txn_cnt"),
        pass_rate.cast("double").alias("pass_rate"),
        abnormal.cast("double").alias("abnormal_rate"),
    )


def transaction_cube(
    transactions: DataFrame, large: Decimal = LARGE_AMOUNT, path: str | None = None
) -> DataFrame:
    """What the hourly, channel, total and risk views need, from one pass over a day's transactions.

    Rows by hour, by channel and in all, told apart by ``part``; a few dozen, so they
    are written to ``path`` (a scratch folder by default) and the views read those.
    """
    amount, spark = F.col("trans_amt"), transactions.sparkSession
    is_large_one = is_large(amount, large)
    rows = transactions.withColumn("hour", F.hour("trans_time"))
    cube = rows.groupingSets([["hour"], ["channel"], []], "hour", "channel").agg(
        F.grouping_id().alias("part"),
        F.count(F.lit(1)).alias("cnt"),
        F.sum(amount).alias("amt"),
        F.avg(amount).alias("avg_amt"),
        F.count_if(F.col("trans_status") == "SUCCESS").alias("success_cnt"),
        F.count_if(is_large_one).alias("large_cnt"),
        F.sum(F.when(is_large_one, amount)).alias("large_amt"),
        F.count_if(is_night(F.col("trans_time"))).alias("night_cnt"),
    )
    path = path or scratch_dir(spark, "cube")
    cube.coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.schema(cube.schema).parquet(path)


#: grouping_id of the parts: the bit of a column is set where it is summed over.
_BY_HOUR, _BY_CHANNEL, _ALL = 1, 2, 3


def cube_views(cube: DataFrame, computed_rates: bool = False, amount_type: str = MONEY) -> dict[str, DataFrame]:
    """hourly_trend, channel_distribution, transaction_summary and risk_overview from ``transaction_cube``."""
    amt = F.col("amt").cast(amount_type).alias("amt")
    # one row, also of an empty day
    total = F.coalesce(F.max("cnt"), F.lit(0))
    large_amt = F.when(total > 0, F.coalesce(F.max("large_amt"), F.lit(0)))
    abnormal = F.round(F.try_divide(F.max("large_cnt") * 100.0, total), 4) if computed_rates else F.lit(ABNORMAL_RATE)
    pass_rate = F.round(100.0 - abnormal, 4) if computed_rates else F.lit(PASS_RATE)
    whole = cube.where(F.col("part") == _ALL)
    return {
        "hourly_trend": cube.where(F.col("part") == _BY_HOUR).select("hour", "cnt", amt).orderBy("hour"),
        "channel_distribution": cube.where(F.col("part") == _BY_CHANNEL).select("channel", "cnt", amt).orderBy(F.desc("cnt"), "channel"),
        "transaction_summary": whole.agg(
            total.alias("total_cnt"), F.max("amt").cast(amount_type).alias("total_amt"),
            F.max("avg_amt").cast(amount_type).alias("avg_amt"), F.max("success_cnt").alias("success_cnt"),
        ),
        "risk_overview": whole.agg(
            total.alias("total_txn"), F.max("large_cnt").alias("large_txn_cnt"), large_amt.cast(amount_type).alias("large_txn_amt"),
            F.max("night_cnt").alias("night_txn_cnt"), pass_rate.cast("double").alias("pass_rate"), abnormal.cast("double").alias("abnormal_rate"),
        ),
    }


def risk_alerts(
    transactions: DataFrame, large: Decimal = LARGE_AMOUNT, high: Decimal = HIGH_AMOUNT, top: int = 10
) -> DataFrame:
    """Large or night transactions, largest first."""
    amount, time = F.col("trans_amt"), F.col("trans_time")
    return (
        transactions.where(is_large(amount, large) | is_night(time))
        .orderBy(F.desc("trans_amt"), TRANSACTION.key, F.desc("trans_time"), "trans_type", "channel")
        .limit(top)
        .select(
            TRANSACTION.key,
            time.cast("string").alias("trans_time"),
            "trans_type",
            amount.cast(MONEY).alias("trans_amt"),
            "channel",
            risk_level(amount, large, high).alias("risk_level"),
        )
    )


def preview(rows: DataFrame, n: int = 5) -> DataFrame:
    """Some rows, in no order."""
    return rows.limit(n)
