"""Risk predicates shared by batch queries and streams."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

LARGE_AMOUNT = Decimal("500000")
HIGH_AMOUNT = Decimal("1000000")
NIGHT_FROM = 22
NIGHT_UNTIL = 6

# Channels that leave the bank (fixed values).
CROSS_BANK_CHANNELS = ("ALIPAY", "WECHAT_PAY", "UNIONPAY")


def is_large(amount: Column, large=LARGE_AMOUNT) -> Column:
    return amount > F.lit(large)


def is_night(time: Column) -> Column:
    hour = F.hour(time)
    return (hour >= NIGHT_FROM) | (hour < NIGHT_UNTIL)


def risk_level(amount: Column, large=LARGE_AMOUNT, high=HIGH_AMOUNT) -> Column:
    return (
        F.when(amount > F.lit(high), "HIGH")
        .when(amount > F.lit(large), "MEDIUM")
        .otherwise("LOW")
    )
