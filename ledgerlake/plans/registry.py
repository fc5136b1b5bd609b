"""Every operator as a named query over the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.display import auto_text
from ledgerlake.operators import checks, history, insights, marts, patterns, vault
from ledgerlake.plans import daily, fixtures
from ledgerlake.plans.fixtures import DAY
from ledgerlake.schemas import SOURCES, TABLES, struct
from ledgerlake.session import STREAM_CONF, configure, scratch_dir
from ledgerlake.sources import delimited, feed
from ledgerlake.sources.changes import ChangeTable
from ledgerlake.sources.known_keys import KnownKeys
from ledgerlake.sources.lake import Lake, create_tables, export_json, insert_day, latest_day
from ledgerlake.streaming import detect, monitor

Query = Callable[[SparkSession, str], DataFrame]

# Event values end below 500, so risk queries over them use lower thresholds than the defaults.
LARGE, HIGH = Decimal("300"), Decimal("400")

# Days compared by the history queries.
BEFORE, AFTER, LAST = "1998-06-30", "1999-03-31", "1999-12-31"


def comparable(df: DataFrame) -> DataFrame:
    """Without run times; decimals as doubles, days and times as text, so that any client reads the same values."""
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if field.name in ("etl_time", "ingest_time"):
            continue
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return df.select(*columns)


# --- vault --------------------------------------------------------------------------


def _hub(name: str) -> Query:
    hub = vault.HUBS[name]
    return lambda spark, sf: vault.build_hub(fixtures.BUILDERS[hub.source](spark, sf), hub, DAY)


def sat_customer(spark, sf):
    return vault.build_sat_customer(fixtures.customers(spark, sf), DAY)


def sat_balance(spark, sf):
    return vault.build_sat_balance(fixtures.balances(spark, sf), fixtures.accounts(spark, sf), DAY)


def sat_transaction(spark, sf):
    return vault.build_sat_transaction(fixtures.transactions(spark, sf), DAY)


def link_cust_acct(spark, sf):
    return vault.build_link_cust_acct(fixtures.accounts(spark, sf), DAY)


def link_cust_loan(spark, sf):
    return vault.build_link_cust_loan(fixtures.loans(spark, sf), DAY)


def link_txn_acct(spark, sf):
    return vault.build_link_txn_acct(fixtures.transactions(spark, sf), DAY)


# --- marts --------------------------------------------------------------------------


def cust_daily_summary(spark, sf):
    return marts.customer_summary(link_cust_acct(spark, sf), sat_balance(spark, sf))


def cust_daily_summary_extended(spark, sf):
    inputs = marts.SummaryInputs(
        fixtures.loans(spark, sf), fixtures.transactions(spark, sf), fixtures.accounts(spark, sf)
    )
    return marts.customer_summary(link_cust_acct(spark, sf), sat_balance(spark, sf), inputs)


def mgmt_kpi(spark, sf):
    return marts.management_kpis(vault.build_vault(fixtures.sources(spark, sf), DAY))


def daily_kpis(spark, sf):
    """Transaction count and amount of every shipping day, as KPI rows with their day."""
    facts = sat_transaction(spark, sf)
    per_day = facts.groupBy(F.col("trans_date").cast("string").alias("dt")).agg(
        F.countDistinct("transaction_hash_key").cast("decimal(18,4)").alias("DAILY_TXN_CNT"),
        F.sum("trans_amt").cast("decimal(18,4)").alias("DAILY_TXN_AMT"),
    )
    return per_day.unpivot(["dt"], ["DAILY_TXN_CNT", "DAILY_TXN_AMT"], "kpi_code", "kpi_value")


def kpi_change(spark, sf):
    days = daily_kpis(spark, sf)
    kpis = marts.as_kpi_rows(days, "dt")
    return marts.with_kpi_changes(kpis, days, "decimal(18,2)")  # counts of single days grow more than tenfold


# --- dashboards -----------------------------------------------------------------------


def event_facts(spark, sf):
    return vault.build_sat_transaction(fixtures.event_transactions(spark, sf), DAY)


def risk_overview_computed(spark, sf):
    return insights.risk_overview(event_facts(spark, sf), LARGE, computed_rates=True)


def summary_texts(spark, sf):
    """Assets of every customer as display text."""
    amount = F.col("total_asset_amt")
    return cust_daily_summary(spark, sf).select(
        "customer_hash_key",
        auto_text(amount, "wan").alias("wan_text"),
        auto_text(amount, "yi").alias("yi_text"),
        auto_text(amount).alias("auto_text"),
    )


def dashboard_cube(spark, sf):
    """Four views of the dashboard from one pass, their values in one column."""
    views = insights.cube_views(insights.transaction_cube(event_facts(spark, sf), LARGE))
    tall = None
    for name, df in views.items():
        keys = [c for c in ("hour", "channel") if c in df.columns]
        values = [c for c in df.columns if c not in keys]
        rows = df.select(
            F.lit(name).alias("view"), (F.col(keys[0]).cast("string") if keys else F.lit("")).alias("key"),
            F.explode(F.create_map(*[x for c in values for x in (F.lit(c), F.col(c).cast("double"))])).alias("measure", "value"),
        )
        tall = rows if tall is None else tall.unionByName(rows)
    return tall


def kpi_change_asof(spark, sf):
    """Changes of every working day; at weekends there are no figures."""
    days = daily_kpis(spark, sf).where(F.weekday(F.to_date("dt")) < 5)
    return marts.with_kpi_changes_asof(marts.as_kpi_rows(days, "dt"), days, change_type="decimal(18,2)")


# --- loads and storage ------------------------------------------------------------------


def _load(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        staged = delimited.write_text(fixtures.BUILDERS[name](spark, sf), scratch_dir(spark, f"stage-{name}"))
        return delimited.load_source(spark, name, staged, DAY)

    return run


def ods_rejects(spark, sf):
    """Payment extract in which failed payments carry a text amount and a text time."""
    failed = F.col("event_type") == "error"
    raw = fixtures.table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("pay_id"),
        F.lit(None).cast("string").alias("order_no"), F.lit(None).cast("string").alias("payer_acct"),
        F.lit(None).cast("string").alias("payee_acct"),
        F.when(failed, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("amount"),
        F.lit(None).cast("string").alias("pay_channel"), F.col("event_type").alias("pay_status"),
        F.when(F.col("event_type") == "view", F.lit("soon")).otherwise(F.col("ts").cast("string")).alias("create_time"),
        F.lit("").alias("complete_time"),
    )
    return delimited.rejected_cells(raw, "payment").select(
        "pay_id", "pay_status", F.array_join("rejected", ",").alias("rejected")
    )


def day_overwrite(spark, sf):
    """Two days written, the first of them twice: each day holds its last write only."""
    lake = Lake(spark, scratch_dir(spark, "lake"))
    accounts = delimited.type_rows(fixtures.accounts(spark, sf), "account", BEFORE)
    for rows, dt in (
        (accounts, BEFORE),
        (accounts.where("status = 'NORMAL'"), BEFORE),
        (accounts.where("status <> 'NORMAL'"), AFTER),
    ):
        lake.write_day("ods_account", rows, dt)
    return lake.read("ods_account", BEFORE, AFTER).groupBy("dt", "status").agg(F.count(F.lit(1)).alias("row_cnt"))


def day_versions(spark, sf):
    """A day written, written anew and dropped: what readers of each step of the log see."""
    lake = Lake(spark, scratch_dir(spark, "lake"))
    accounts = delimited.type_rows(fixtures.accounts(spark, sf), "account", BEFORE)
    lake.write_day("ods_account", accounts, BEFORE)
    lake.write_day("ods_account", accounts.where("status = 'NORMAL'"), BEFORE)
    lake.write_day("ods_account", accounts.where("status <> 'NORMAL'"), AFTER)
    lake.drop_day("ods_account", BEFORE)
    steps = None
    for version in lake.log("ods_account").versions():
        rows = lake.read("ods_account", version=version).groupBy("dt", "status").agg(F.count(F.lit(1)).alias("row_cnt"))
        rows = rows.withColumn("version", F.lit(version))
        steps = rows if steps is None else steps.unionByName(rows)
    return steps


def day_drop(spark, sf):
    """Two days written, the second dropped: the first is all there is."""
    lake = Lake(spark, scratch_dir(spark, "lake"))
    accounts = delimited.type_rows(fixtures.accounts(spark, sf), "account", BEFORE)
    lake.write_day("ods_account", accounts.where("status = 'NORMAL'"), BEFORE)
    lake.write_day("ods_account", accounts.where("status <> 'NORMAL'"), AFTER)
    lake.drop_day("ods_account", AFTER)
    return lake.read("ods_account").groupBy("dt", "status").agg(F.count(F.lit(1)).alias("row_cnt"))


def newest_day(spark, sf):
    days = sat_transaction(spark, sf).withColumn("dt", F.col("trans_date").cast("string"))
    return latest_day(days, DAY)


def lake_latest_day(spark, sf):
    """The newest day written, found in the log: days of the first and last shipping date."""
    lake = Lake(spark, scratch_dir(spark, "lake"))
    facts = sat_transaction(spark, sf)
    ends = facts.agg(F.min("trans_date").cast("string"), F.max("trans_date").cast("string")).first()
    for dt in ends[::-1]:
        lake.write_day("sat_transaction", facts.where(F.col("trans_date") == F.lit(dt).cast("date")), dt)
    return lake.latest_day("sat_transaction").join(
        lake.read_day("sat_transaction", ends[1]).groupBy("dt").agg(F.count(F.lit(1)).alias("row_cnt")), "dt"
    )


def catalog_tables(spark, sf):
    """Declared tables below a scratch folder, a day of hub keys inserted and read by SQL, then dropped again."""
    tables = [TABLES[n] for n in ("hub_account", "hub_org")]
    at = scratch_dir(spark, "catalog")
    named = [replace(t, database=f"scratch_{at[-8:]}") for t in tables]
    create_tables(spark, named, at)
    for table, name in zip(named, ("hub_account", "hub_org")):
        insert_day(spark, table, _hub(name)(spark, sf), DAY)
    counts = " UNION ALL ".join(
        f"SELECT '{t.physical}' AS table_name, dt, COUNT(1) AS row_cnt, COUNT(DISTINCT {t.bucket_by}) AS keys FROM {t.qualified} GROUP BY dt"
        for t in named
    )
    path = f"{at}/counts"
    spark.sql(counts).write.parquet(path)
    spark.sql(f"DROP DATABASE {named[0].database} CASCADE")
    return spark.read.parquet(path)


def json_export(spark, sf):
    path = scratch_dir(spark, "json")
    export_json(insights.channel_distribution(sat_transaction(spark, sf)), path)
    return spark.read.schema("channel string, cnt bigint, amt decimal(18,2)").json(path)


# --- checks ---------------------------------------------------------------------------------


def reconcile(spark, sf):
    """Counts of a day's tables, which are written once and then counted."""
    lake = Lake(spark, scratch_dir(spark, "lake"), "parquet")
    for name, build in fixtures.BUILDERS.items():
        lake.write_day(f"ods_{name}", delimited.type_rows(build(spark, sf), name, DAY), DAY)
    daily.build_vault_day(lake, DAY)
    daily.build_marts_day(lake, DAY)
    return daily.reconcile_day(lake, DAY)


def load_report(spark, sf):
    """What a day's loads count of their rows while they write them."""
    lake, stages = Lake(spark, scratch_dir(spark, "lake"), "parquet"), scratch_dir(spark, "stage")
    for name, build in fixtures.BUILDERS.items():
        delimited.write_text(build(spark, sf), SOURCES[name].stage_path(stages, DAY))
    daily.load_day(lake, stages, DAY)
    return daily.load_report(lake, DAY)


def dq_checks(spark, sf):
    sources = fixtures.sources(spark, sf)
    # count drift: personal against all customers stands for two days
    before = {"customer": sources["customer"], "transaction": fixtures.event_transactions(spark, sf)}
    return checks.quality_report(sources, before)


# --- history ------------------------------------------------------------------------------------


def _customer_day(spark, sf, dt):
    return vault.build_sat_customer(fixtures.customer_snapshot(spark, sf, dt == BEFORE), dt)


def scd2_customer(spark, sf):
    return history.next_customer_versions(_customer_day(spark, sf, BEFORE), _customer_day(spark, sf, AFTER), AFTER)


def customer_history(spark, sf):
    """All versions on the second day: those closed on it and those current on it."""
    days = _customer_day(spark, sf, BEFORE).withColumn("dt", F.lit(BEFORE)).unionByName(
        scd2_customer(spark, sf).withColumn("dt", F.lit(AFTER))
    )
    return history.customer_history(days, AFTER).select(
        "customer_hash_key", "load_date", "load_end_date", "is_current", "cust_level", "status"
    )


def version_checks(spark, sf):
    return history.version_rules(customer_history(spark, sf))


def _hub_day(spark, sf, dt):
    return vault.build_hub(fixtures.customer_snapshot(spark, sf, dt == BEFORE), vault.CUSTOMER, dt)


def hub_first_seen(spark, sf):
    days = _hub_day(spark, sf, BEFORE).unionByName(_hub_day(spark, sf, AFTER))
    return history.first_seen(days, "customer_hash_key", "customer_id")


def hub_new_rows(spark, sf):
    return history.new_hub_rows(_hub_day(spark, sf, AFTER), _hub_day(spark, sf, BEFORE), "customer_hash_key")


def hub_known_keys(spark, sf):
    """Three days of a hub: keys absent on the second keep their first day on the third, whichever day saw them first."""
    known = KnownKeys(spark, scratch_dir(spark, "known"), vault.CUSTOMER.key)
    days = {
        BEFORE: _hub_day(spark, sf, BEFORE), AFTER: _hub_day(spark, sf, AFTER),
        LAST: vault.build_hub(fixtures.customers(spark, sf), vault.CUSTOMER, LAST),
    }
    for dt, rows in days.items():
        seen = known.first_seen(rows, dt)
        known.add(rows, dt)
    return seen


def link_end_dating(spark, sf):
    before, after = (
        vault.build_link_cust_acct(fixtures.account_snapshot(spark, sf, dt == BEFORE), dt) for dt in (BEFORE, AFTER)
    )
    return history.next_links(before, after, AFTER)


def _changes(spark, sf):
    return feed.decode_changes(fixtures.change_feed(spark, sf))


def cdc_latest(spark, sf):
    return history.latest_changes(_changes(spark, sf)).select(
        "trans_id", "op", "account_no", "trans_type", "trans_amt", "trans_time", "channel"
    )


def cdc_apply(spark, sf):
    base = fixtures.table(spark, sf, "customer").select(
        F.concat(F.lit("ACCT"), F.col("c_custkey").cast("string")).alias("trans_id"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("trans_amt"),
        F.col("c_mktsegment").alias("channel"),
    )
    return history.apply_changes(base, _changes(spark, sf))


def cdc_merge(spark, sf):
    """The feed in three batches that come in the wrong order, one of them twice, merged into the base when read."""
    table = ChangeTable(spark, scratch_dir(spark, "changes"), _CDC_BASE)
    table.load(fixtures.table(spark, sf, "customer").select(
        F.concat(F.lit("ACCT"), F.col("c_custkey").cast("string")).alias("trans_id"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("trans_amt"),
        F.col("c_mktsegment").alias("channel"),
    ))
    changes = _changes(spark, sf).withColumn("part", F.pmod(F.xxhash64("batch"), F.lit(3)))
    for part in (2, 0, 2, 1):
        table.apply(changes.where(F.col("part") == part), str(part))
        if part == 0:
            table.compact()
    return table.read()


_CDC_BASE = struct("trans_id string, trans_amt decimal(18,2), channel string")


# --- patterns and streams -----------------------------------------------------------------------------


def fast_in_out(spark, sf):
    return patterns.fast_in_out(fixtures.event_transactions(spark, sf), "1 day", min_in=Decimal("20"), ratio=0.5)


def fast_in_out_split(spark, sf):
    return patterns.fast_in_out_split(fixtures.event_transactions(spark, sf), "1 day", min_in=Decimal("20"), ratio=0.5)


def night_activity(spark, sf):
    return patterns.night_activity(fixtures.event_transactions(spark, sf), min_count=2)


# A credit and a debit of the far future: they move the watermarks past all other rows, so that append mode finishes those.
CLOSING_ROWS = [
    (f'{{"trans_id": "CLOSE-{flag}", "account_no": "CLOSE-{flag}", "trans_amt": 1000000, "dr_cr_flag": "{flag}", "trans_time": "2100-01-01 00:00:00"}}',)
    for flag in "CD"
]


def _staged_feed(spark, sf, close=False):
    """The feed written as text files, then read as a stream."""
    path = scratch_dir(spark, "feed")
    rows = fixtures.feed(spark, sf)
    if close:
        rows = rows.unionByName(spark.createDataFrame(CLOSING_ROWS, "value string"))
    rows.write.text(path)
    return feed.file_source(spark, path)


def _appended(spark, sf, transform):
    """All rows that a stream over the feed appends until its last window is closed."""
    out = scratch_dir(spark, "appended")
    result = transform(monitor.with_event_time(feed.decode_rows(_staged_feed(spark, sf, close=True))))
    _finish(monitor.start_append(result, f"{out}/rows", f"{out}/checkpoint", finite=True))
    return spark.read.schema(result.schema).parquet(f"{out}/rows")


def _finish(query) -> None:
    query.awaitTermination()


def stream_decode(spark, sf):
    """Rows of the feed when it also carries change envelopes and broken text."""
    broken = fixtures.table(spark, sf, "events").select(F.col("event_type").alias("value"))
    mixed = fixtures.feed(spark, sf).unionByName(fixtures.change_feed(spark, sf)).unionByName(broken)
    return feed.decode_rows(mixed).select("trans_id", "account_no", "trans_amt", "trans_time", "channel")


def stream_large_amount(spark, sf):
    out = scratch_dir(spark, "alerts")
    alerts = monitor.large_amount_alerts(feed.decode_rows(_staged_feed(spark, sf)), LARGE, HIGH)
    _finish(monitor.start_append(alerts, f"{out}/rows", f"{out}/checkpoint", finite=True))
    return spark.read.schema(alerts.schema).parquet(f"{out}/rows")


def stream_channel_window(spark, sf):
    out = scratch_dir(spark, "windows")
    rows = monitor.with_event_time(feed.decode_rows(_staged_feed(spark, sf)))
    _finish(monitor.start_account_windows(rows, f"{out}/rows", f"{out}/checkpoint", "1 hour", finite=True, files=4))
    return monitor.read_channel_windows(spark, f"{out}/rows")


def stream_channel_window_10s(spark, sf):
    return _appended(spark, sf, monitor.channel_windows)


def stream_channel_success(spark, sf):
    return _appended(spark, sf, lambda rows: monitor.channel_success(rows, failed=("error",)))


def stream_fast_in_out(spark, sf):
    return _appended(spark, sf, lambda rows: patterns.fast_in_out_stream(rows, "1 day", Decimal("20"), 0.5))


def stream_fast_in_out_state(spark, sf):
    """The same alerts from each account's state, with timers."""
    before = {name: spark.conf.get(name, None) for name in STREAM_CONF}
    for name, value in STREAM_CONF.items():
        spark.conf.set(name, value)
    try:
        return _appended(spark, sf, lambda rows: detect.fast_in_out_alerts(rows, "1 day", Decimal("20"), 0.5))
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def channel_sketches(spark, sf):
    """Hours and days of accounts from ten-second sketches, held against the exact counts."""
    rows = monitor.with_event_time(feed.decode_rows(fixtures.feed(spark, sf)))
    small = monitor.sketch_windows(rows)
    parts = None
    for width in ("1 hour", "1 day"):
        rolled = monitor.estimated(monitor.roll_up_sketches(small, width)).withColumnRenamed("active_accounts", "estimate")
        exact = monitor.channel_windows(rows, width).select("window_start", "channel", "active_accounts")
        both = rolled.join(exact, ["window_start", "channel"]).select(
            F.lit(width).alias("width"), "window_start", "channel", "txn_cnt", "txn_amt", "active_accounts",
            (F.abs(F.col("estimate") - F.col("active_accounts")) <= monitor.error_bound(F.col("active_accounts"))).alias("within_bound"),
        )
        parts = both if parts is None else parts.unionByName(both)
    return parts


def channel_window(spark, sf):
    """Ten-second windows of the whole feed as one batch."""
    return monitor.channel_windows(monitor.with_event_time(feed.decode_rows(fixtures.feed(spark, sf))))


def channel_success(spark, sf):
    rows = monitor.with_event_time(feed.decode_rows(fixtures.feed(spark, sf)))
    return monitor.channel_success(rows, failed=("error",))


def _compared(query: Query) -> Query:
    return lambda spark, sf: comparable(query(configure(spark), sf))


def _facts(insight, *args) -> Query:
    return lambda spark, sf: insight(event_facts(spark, sf), *args)


QUERIES: dict[str, Query] = {
    name: _compared(query)
    for name, query in {
        **{name: _hub(name) for name in vault.HUBS},
        "sat_customer": sat_customer,
        "sat_balance": sat_balance,
        "sat_transaction": sat_transaction,
        "link_cust_acct": link_cust_acct,
        "link_cust_loan": link_cust_loan,
        "link_txn_acct": link_txn_acct,
        "cust_daily_summary": cust_daily_summary,
        "cust_daily_summary_extended": cust_daily_summary_extended,
        "mgmt_kpi": mgmt_kpi,
        "kpi_list": lambda spark, sf: insights.kpi_list(mgmt_kpi(spark, sf)),
        "kpi_text": lambda spark, sf: insights.kpi_text(mgmt_kpi(spark, sf)),
        "kpi_cards": lambda spark, sf: insights.kpi_cards(mgmt_kpi(spark, sf)),
        "kpi_change": kpi_change,
        "kpi_change_asof": kpi_change_asof,
        "aum_distribution": lambda spark, sf: insights.aum_distribution(cust_daily_summary(spark, sf)),
        "hourly_trend": _facts(insights.hourly_trend),
        "hourly_counts": _facts(insights.hourly_counts),
        "channel_distribution": _facts(insights.channel_distribution),
        "channel_counts": _facts(insights.channel_counts, 6),
        "account_types": lambda spark, sf: insights.account_types(fixtures.accounts(spark, sf)),
        "top_customers": lambda spark, sf: insights.top_customers(cust_daily_summary(spark, sf), sat_customer(spark, sf)),
        "masked_top_customers": lambda spark, sf: insights.masked_top_customers(
            cust_daily_summary(spark, sf), sat_customer(spark, sf)
        ),
        "transaction_summary": lambda spark, sf: insights.transaction_summary(sat_transaction(spark, sf)),
        "recent_transactions": _facts(insights.recent_transactions),
        "risk_overview": _facts(insights.risk_overview, LARGE),
        "risk_overview_computed": risk_overview_computed,
        "risk_alerts": _facts(insights.risk_alerts, LARGE, HIGH),
        "summary_texts": summary_texts,
        "dashboard_cube": dashboard_cube,
        **{f"ods_load_{name}": _load(name) for name in SOURCES},
        "ods_rejects": ods_rejects,
        "day_overwrite": day_overwrite,
        "day_versions": day_versions,
        "day_drop": day_drop,
        "lake_latest_day": lake_latest_day,
        "catalog_tables": catalog_tables,
        "latest_day": newest_day,
        "json_export": json_export,
        "reconcile": reconcile,
        "load_report": load_report,
        "dq_checks": dq_checks,
        "scd2_customer": scd2_customer,
        "customer_history": customer_history,
        "version_checks": version_checks,
        "hub_first_seen": hub_first_seen,
        "hub_new_rows": hub_new_rows,
        "hub_known_keys": hub_known_keys,
        "link_end_dating": link_end_dating,
        "cdc_latest": cdc_latest,
        "cdc_apply": cdc_apply,
        "cdc_merge": cdc_merge,
        "fast_in_out": fast_in_out,
        "fast_in_out_split": fast_in_out_split,
        "night_activity": night_activity,
        "stream_decode": stream_decode,
        "stream_large_amount": stream_large_amount,
        "stream_channel_window": stream_channel_window,
        "stream_channel_window_10s": stream_channel_window_10s,
        "stream_channel_success": stream_channel_success,
        "stream_fast_in_out": stream_fast_in_out,
        "stream_fast_in_out_state": stream_fast_in_out_state,
        "channel_sketches": channel_sketches,
        "channel_window": channel_window,
        "channel_success": channel_success,
    }.items()
}
