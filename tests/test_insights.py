import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions.display import auto_text, card_text, in_wan, masked_name
from ledgerlake.operators import insights

TXN = ("transaction_hash_key string, trans_date date, trans_time timestamp, trans_type string, "
       "trans_amt decimal(18,2), channel string, trans_status string")


def txns(spark, *rows):
    """(key, time, amount, channel) rows."""
    return spark.createDataFrame(
        [(k, t and t.date(), t, "X", None if a is None else Decimal(a), c, "SUCCESS") for k, t, a, c in rows], TXN)


def at(hour, minute=0, second=0):
    return datetime(2026, 6, 14, hour, minute, second)


def summary(spark, *amounts):
    return spark.createDataFrame([(f"c{i:03d}", Decimal(a)) for i, a in enumerate(amounts)],
                                 "customer_hash_key string, total_asset_amt decimal(18,2)")


def test_bands_are_half_open(spark):
    edges = ["9999.99", "10000", "99999.99", "100000", "500000", "1000000", "5000000", "9999999.99", "10000000", "-1"]
    rows = [tuple(r) for r in insights.aum_distribution(summary(spark, *edges)).collect()]
    assert rows == [("1万以下", 2), ("1-10万", 2), ("10-50万", 1), ("50-100万", 1), ("100-500万", 1), ("500-1000万", 2), ("1000万+", 1)]


def test_night_wraps_midnight_and_thresholds_are_strict(spark):
    rows = txns(spark, ("a", at(21, 59, 59), "500000", "ATM"), ("b", at(22), "500000.01", "ATM"), ("c", at(0), "1000000", "ATM"),
                ("d", at(5, 59, 59), "1000000.01", "ATM"), ("e", at(6), "1", "ATM"), ("f", at(23), None, "ATM"), ("g", None, "2", "ATM"))
    over = insights.risk_overview(rows).first()
    assert (over.total_txn, over.large_txn_cnt, over.large_txn_amt, over.night_txn_cnt) == (7, 3, Decimal("2500000.02"), 4)
    assert (over.pass_rate, over.abnormal_rate) == (99.85, 0.15)
    alerts = [(r.transaction_hash_key, r.risk_level) for r in insights.risk_alerts(rows).collect()]
    assert alerts == [("d", "HIGH"), ("c", "MEDIUM"), ("b", "MEDIUM"), ("f", "LOW")]
    rates = insights.risk_overview(rows, computed_rates=True).first()
    assert (rates.abnormal_rate, rates.pass_rate) == (42.8571, 57.1429)


def test_empty_day(spark):
    none = txns(spark).limit(0)
    over = insights.risk_overview(none, computed_rates=True).first()
    assert (over.total_txn, over.large_txn_cnt, over.pass_rate) == (0, None, None)
    assert insights.transaction_summary(none).first().total_cnt == 0
    assert insights.hourly_trend(none).count() == 0


def test_ties_at_the_cut_have_one_order(spark):
    rows = txns(spark, *[(f"k{i:02d}", at(12), "5", "ATM") for i in range(40)])
    want = [f"k{i:02d}" for i in range(20)]
    for parts in (1, 7):
        assert [r.transaction_hash_key for r in insights.recent_transactions(rows.repartition(parts)).collect()] == want


def test_top_customers_keep_current_named_rows(spark):
    base = summary(spark, "5", "9", "7")
    named = spark.createDataFrame(
        [("c000", "张三丰丰", True), ("c001", "old", False), ("c001", None, True), ("c002", "", True)],
        "customer_hash_key string, cust_name string, is_current boolean")
    assert [tuple(r) for r in insights.top_customers(base, named, 2).collect()] == [(None, Decimal("9.00")), ("", Decimal("7.00"))]
    assert [r.name for r in insights.masked_top_customers(base, named).collect()] == ["***", "***", "张三丰**"]


def test_distributions_agree_with_the_totals(spark):
    rows = txns(spark, *[(f"k{i}", at(i % 24, i % 60), str(i), "ATM" if i % 3 else "ALIPAY") for i in range(500)])
    total = insights.transaction_summary(rows).first()
    hours, channels = insights.hourly_trend(rows).collect(), insights.channel_distribution(rows).collect()
    assert sum(r.cnt for r in hours) == sum(r.cnt for r in channels) == total.total_cnt == 500
    assert sum(r.amt for r in hours) == sum(r.amt for r in channels) == total.total_amt
    assert sum(r.cnt for r in hours if r.hour >= 22 or r.hour < 6) == insights.risk_overview(rows).first().night_txn_cnt
    assert [r.channel for r in channels] == ["ATM", "ALIPAY"]
    assert total.avg_amt == Decimal("249.50")
    assert [tuple(r) for r in insights.channel_counts(rows, 1).collect()] == [("ATM", 333)]
    assert [r.cnt for r in insights.hourly_counts(rows).collect()] == [r.cnt for r in hours]


DISPLAY = [
    ("3921908918.22", "3,921,908,918", "39.22亿", "392,190.89万", "39.22 亿"),
    ("49859", "49,859", "0.00亿", "4.99万", "5 万"),
    ("25000", "25,000", "0.00亿", "2.50万", "3 万"),
    ("999.5", "1,000", "0.00亿", "0.10万", "1,000"),
    ("1012500000", "1,012,500,000", "10.12亿", "101,250.00万", "10.13 亿"),
    ("0", "0", "0.00亿", "0.00万", "0"),
]


@pytest.mark.parametrize("value,number,yi,wan,auto", DISPLAY)
def test_display(spark, value, number, yi, wan, auto):
    v = F.lit(Decimal(value))
    got = spark.range(1).select(card_text(v), card_text(v, "yi"), card_text(v, "wan"), auto_text(v)).first()
    assert tuple(got) == (number, yi, wan, auto)
    assert got[0] == f"{float(value):,.0f}" and got[1] == f"{float(value) / 1e8:,.2f}亿"


def test_display_of_nothing_percent_and_names(spark):
    null = F.lit(None).cast("decimal(18,2)")
    got = spark.range(1).select(auto_text(null), auto_text(F.lit(99.85), "pct"), in_wan(F.lit(25000)), in_wan(F.lit(35000)),
                                masked_name(F.lit("ab")), masked_name(F.lit(None).cast("string"))).first()
    assert tuple(got) == ("-", "99.85%", 2.0, 4.0, "ab**", "***")


def test_top_k_never_sorts_everything(spark):
    rows = txns(spark, ("a", at(1), "1", "ATM"))
    for df in (insights.recent_transactions(rows), insights.risk_alerts(rows)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_json_shape_of_the_kpi_list(spark):
    kpis = spark.createDataFrame([("B", "二", Decimal("2.5"), "U"), ("A", "一", Decimal("1"), "U")],
                                 "kpi_code string, kpi_name string, kpi_value decimal(18,4), kpi_unit string")
    assert [json.loads(x) for x in insights.kpi_list(kpis).toJSON().collect()] == [
        {"kpi_code": "A", "kpi_name": "一", "kpi_value": 1.0, "kpi_unit": "U"},
        {"kpi_code": "B", "kpi_name": "二", "kpi_value": 2.5, "kpi_unit": "U"}]
    assert [r.kpi_value for r in insights.kpi_text(kpis).collect()] == ["1.0000", "2.5000"]
