"""Suspicious money movement, for batch frames and streams alike."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.predicates import is_night
from ledgerlake.session import scratch_dir


# microseconds of the units an interval text may name
_UNITS = {"second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6, "day": 86400 * 10**6}


def micros(width: str) -> int:
    """Length of an interval text such as ``10 minutes``."""
    number, unit = width.split()
    return int(number) * _UNITS[unit.rstrip("s")]


def fast_in_out(
    transactions: DataFrame,
    width: str = "10 minutes",
    min_in: Decimal = Decimal("100000"),
    ratio: float = 0.8,
    time: str = "trans_time",
) -> DataFrame:
    """Credits after which most of the money leaves the account within ``width``; one row per credit.

    A credit's debits are those later than it, by ``width`` at most. Rows are
    dealt to their account and stretch of time of that width, debits also to
    the stretch before, so that a credit and all its debits share a group, and a busy account is
    split by time. Rows without a time or account take no part.
    """
    length = micros(width)
    at, stretch = F.unix_micros(F.col(time).cast("timestamp")), F.col("at") - F.pmod("at", F.lit(length))
    timed = transactions.where(F.col(time).isNotNull() & F.col("account_no").isNotNull()).select(
        "account_no", "dr_cr_flag", "trans_amt", F.col(time).alias("time"), at.alias("at")
    )
    large = (F.col("dr_cr_flag") == "C") & (F.col("trans_amt") >= F.lit(min_in))
    debit = F.col("dr_cr_flag") == "D"
    places = F.when(large, F.array(stretch)).when(debit, F.array(stretch, stretch - length))
    dealt = timed.select("*", F.explode(places).alias("stretch"))
    later = Window.partitionBy("account_no", "stretch").orderBy("at").rangeBetween(1, length)
    found = dealt.withColumns({
        "out_amt": F.sum(F.when(debit, F.col("trans_amt"))).over(later),
        "last_out": F.max(F.when(debit, F.col("time"))).over(later),
    })
    return found.where(large & (F.col("out_amt") >= F.col("trans_amt") * F.lit(ratio))).select(
        "account_no", F.col("time").alias("in_time"), F.col("trans_amt").alias("in_amt"), "out_amt", "last_out",
        F.lit("FAST_IN_OUT").alias("alert_type"),
    )


def fast_in_out_split(
    transactions: DataFrame,
    width: str = "10 minutes",
    min_in: Decimal = Decimal("100000"),
    ratio: float = 0.8,
    time: str = "trans_time",
) -> DataFrame:
    """The rows of ``fast_in_out``, for tables in which one account has many rows at any one time.

    Debits are summed up along each account's time. What leaves after a credit
    is the sum at its end less the sum at its own time, so each large credit asks
    for two sums. Rows and questions are sorted in ranges, which cut an account with many rows
    anywhere; sums run inside a range, and are moved up by the account's ranges before. The sorted
    rows are written once.
    """
    length = micros(width)
    at, debit = F.unix_micros(F.col(time).cast("timestamp")), F.col("dr_cr_flag") == "D"
    large = (F.col("dr_cr_flag") == "C") & (F.col("trans_amt") >= F.lit(min_in))
    timed = transactions.where(F.col(time).isNotNull() & F.col("account_no").isNotNull() & (debit | large)).select(
        "account_no", F.col(time).alias("time"), "trans_amt", debit.alias("debit"), at.alias("at"), F.monotonically_increasing_id().alias("row")
    )
    # a question comes after all debits of its moment
    asked = F.array(F.struct(F.col("at"), F.lit(1).alias("asks")), F.struct((F.col("at") + length).alias("at"), F.lit(2).alias("asks")))
    own = F.array(F.struct(F.col("at"), F.lit(0).alias("asks")))
    dealt = timed.select(
        "account_no", "time", "trans_amt", "debit", "row", F.explode(F.when(F.col("debit"), own).otherwise(asked)).alias("x")
    ).select("account_no", "time", "trans_amt", "debit", "row", "x.at", "x.asks")
    order = ["account_no", "at", "asks", "row"]
    path = scratch_dir(transactions.sparkSession, "in-out")
    dealt.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()).write.parquet(path)
    placed = transactions.sparkSession.read.parquet(path).withColumn("part", F.shiftright("place", 33))

    out = F.when(F.col("debit"), F.col("trans_amt"))
    moment = F.when(F.col("debit"), F.struct("at", "time"))
    # a row for each account and range
    earlier = Window.partitionBy("account_no").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = placed.groupBy("account_no", "part").agg(F.sum(out).alias("n"), F.max(moment).alias("m")).select(
        "account_no", "part", F.sum("n").over(earlier).alias("before"), F.max("m").over(earlier).alias("moment_before")
    )
    inside = Window.partitionBy("account_no", "part").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = placed.withColumns({"upto": F.sum(out).over(inside), "moment": F.max(moment).over(inside)}).where("asks > 0")
    answers = summed.join(carried, ["account_no", "part"]).select(
        "account_no", "row", "asks", "at", "time", "trans_amt",
        (F.coalesce("upto", F.lit(0)) + F.coalesce("before", F.lit(0))).alias("upto"), F.coalesce("moment", "moment_before").alias("moment"),
    )
    first, second = (F.max(F.when(F.col("asks") == k, F.col("upto"))) for k in (1, 2))
    found = answers.groupBy("account_no", "row", "time", "trans_amt").agg(
        (second - first).cast("decimal(28,2)").alias("out_amt"), F.max(F.when(F.col("asks") == 2, F.col("moment"))).alias("last"),
        F.min("at").alias("at"),
    )
    # some debit lies after the credit
    return found.where((F.col("last.at") > F.col("at")) & (F.col("out_amt") >= F.col("trans_amt") * F.lit(ratio))).select(
        "account_no", F.col("time").alias("in_time"), F.col("trans_amt").alias("in_amt"), "out_amt", F.col("last.time").alias("last_out"),
        F.lit("FAST_IN_OUT").alias("alert_type"),
    )


def fast_in_out_stream(
    rows: DataFrame, width: str = "10 minutes", min_in: Decimal = Decimal("100000"), ratio: float = 0.8
) -> DataFrame:
    """The same alerts from a stream of rows with event time ``txn_ts`` and unique ``trans_id``; append mode.

    A join of large credits with later debits of the account, bounded by time, so
    that state is dropped once the watermark has passed.
    """
    credits = rows.where((F.col("dr_cr_flag") == "C") & (F.col("trans_amt") >= F.lit(min_in))).select(
        F.col("trans_id").alias("in_id"), F.col("account_no").alias("in_account"), F.col("trans_amt").alias("in_amt"),
        F.col("txn_ts").alias("in_time"),
    )
    debits = rows.where(F.col("dr_cr_flag") == "D").select(
        "account_no", F.col("trans_amt").alias("out"), F.col("txn_ts").alias("out_time")
    )
    within = F.expr(f"in_account = account_no AND out_time > in_time AND out_time <= in_time + INTERVAL {width}")
    pairs = credits.join(debits, within)
    return (
        pairs.groupBy("in_id", "account_no", "in_amt", "in_time")
        .agg(F.sum("out").alias("out_amt"), F.max("out_time").alias("last_out"))
        .where(F.col("out_amt") >= F.col("in_amt") * F.lit(ratio))
        .select("account_no", "in_time", "in_amt", "out_amt", "last_out", F.lit("FAST_IN_OUT").alias("alert_type"))
    )


def night_activity(transactions: DataFrame, min_count: int = 3, time: str = "trans_time") -> DataFrame:
    """Accounts with repeated night transactions on one day."""
    return (
        transactions.where(is_night(F.col(time)))
        .groupBy("account_no", F.to_date(time).alias("trans_date"))
        .agg(F.count(F.lit(1)).alias("night_cnt"), F.sum("trans_amt").alias("night_amt"))
        .where(F.col("night_cnt") >= min_count)
        .withColumn("alert_type", F.lit("NIGHT_ACTIVITY"))
    )
