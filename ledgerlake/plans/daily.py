"""The daily run: staged files to sources, vault, marts and dashboards, one day at a time.

Each step reads the written tables of the step before, so a lost executor or a
failed step costs that step only, and every step can be rerun for its day.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.functions import keys
from ledgerlake.operators import checks, history, insights, marts, vault
from ledgerlake.schemas import SOURCES, TABLES
from ledgerlake.session import scratch_dir
from ledgerlake.sources import feed
from ledgerlake.sources.changes import ChangeTable
from ledgerlake.sources.delimited import read_text, split_rejects, type_rows, with_rejects
from ledgerlake.sources.known_keys import KnownKeys
from ledgerlake.sources.lake import Lake, export_json
from ledgerlake.sources.snapshots import SnapshotLog


def load_day(lake: Lake, stage_root: str, dt: str, quarantine: str | None = None) -> None:
    """Staged extracts to typed source tables.

    With ``quarantine``, rows that lost a cell in the cast are also written
    there, as text, below their source and day, and lines with too few or too many
    cells go there only. Without, such a line fails the load. An extract is
    parsed once either way. What the quality rules need of single rows is
    counted while they are written, and kept for ``check_day``.
    """
    counted = {}
    for name, source in SOURCES.items():
        raw = read_text(lake.spark, source.stage_path(stage_root, dt))
        if quarantine:
            parsed = scratch_dir(lake.spark, f"parsed-{name}")
            marked = with_rejects(raw, name)
            marked.write.parquet(parsed)
            raw, aside = split_rejects(lake.spark.read.schema(marked.schema).parquet(parsed))
            export_json(aside, f"{quarantine.rstrip('/')}/{name}/dt={dt}")
        raw, seen = checks.observed(raw, name)
        lake.write_day(f"ods_{name}", type_rows(raw, name, dt), dt)
        counted[name] = seen.get
    log = _counts(lake)
    folder = log.fresh()
    checks.observed_rules(lake.spark, counted).coalesce(1).write.parquet(f"{log.root}/{folder}")
    log.commit(lambda days: {dt: folder})


def _counts(lake: Lake) -> SnapshotLog:
    return SnapshotLog(lake.spark, f"{lake.root}/_load_counts")


def load_report(lake: Lake, dt: str) -> DataFrame | None:
    """What was counted while a day was loaded: rules of single rows and row counts; None for a day loaded by other means."""
    log = _counts(lake)
    folder = log.state().get(dt)
    if not folder:
        return None
    return lake.spark.read.schema("rule string, table_name string, failed long, total long").parquet(f"{log.root}/{folder}")


def day_sources(lake: Lake, dt: str) -> dict[str, DataFrame]:
    return {name: lake.read_day(f"ods_{name}", dt) for name in SOURCES}


def known_keys(lake: Lake, name: str) -> KnownKeys:
    """The keys of a hub that any day has seen."""
    return KnownKeys(lake.spark, f"{lake.path(name)}_known", vault.HUBS[name].key)


def build_vault_day(
    lake: Lake, dt: str, previous: str | None = None, tracked: Iterable[str] = keys.TRACKED_ATTRIBUTES
) -> None:
    """Source tables to vault tables. With ``previous``, customers and links keep their history from that day.

    It must be the newest day written before ``dt``: from an older one, and from
    one never written, versions and links would be lost. Hub rows have the load
    date and source with which any day written before has first seen their key. ``tracked`` are the attributes whose
    change makes a new version; it should be the same on every day.
    """
    if previous:
        for name in ("sat_customer", "link_cust_acct"):
            earlier = [day for day in lake.days(name) if day < dt]
            if not earlier or earlier[-1] != previous:
                raise ValueError(
                    f"{name}: the newest day written before {dt} is {earlier[-1] if earlier else 'none'}, not {previous}"
                )
    tables = vault.build_vault(day_sources(lake, dt), dt, tracked)
    if previous:
        tables["sat_customer"] = history.next_customer_versions(
            lake.read_day("sat_customer", previous).drop("dt"), tables["sat_customer"], dt
        )
        tables["link_cust_acct"] = history.next_links(
            lake.read_day("link_cust_acct", previous).drop("dt"), tables["link_cust_acct"], dt
        )
        for name in vault.HUBS:
            known = known_keys(lake, name)
            for day in sorted(set(lake.days(name)) - set(known.days())):
                if day < dt:  # written without a history
                    known.add(lake.read_day(name, day), day)
            tables[name] = known.first_seen(tables[name], dt)
    for name, df in tables.items():
        lake.write_day(name, df, dt)
    if previous:
        for name in vault.HUBS:
            known_keys(lake, name).add(lake.read_day(name, dt), dt)


def vault_day(lake: Lake, dt: str) -> dict[str, DataFrame]:
    return {name: lake.read_day(name, dt) for name, t in TABLES.items() if t.database == "bank_dwd"}


def build_marts_day(lake: Lake, dt: str, extended: bool = False) -> None:
    """Vault tables to the customer summary and the KPI table.

    ``extended`` also fills the summary's loan, transaction and product columns
    and the KPIs' year and month change.
    """
    tables = vault_day(lake, dt)
    links = tables["link_cust_acct"].where("is_active")
    inputs = None
    if extended:
        rows = day_sources(lake, dt)
        inputs = marts.SummaryInputs(rows["loan"], rows["transaction"], rows["account"])
    summary = marts.customer_summary(links, tables["sat_balance"], inputs)
    lake.write_day("cust_daily_summary", summary, dt)

    kpis = marts.management_kpis(tables)
    if extended:
        # strictly earlier days: the day being replaced must not be read
        earlier = lake.read("mgmt_kpi", missing_ok=True).where(F.col("dt") < dt)
        kpis = marts.with_kpi_changes(kpis.withColumn("dt", F.lit(dt)), earlier)
    # seven rows
    lake.write_day("mgmt_kpi", kpis.coalesce(1), dt)


def dashboard(lake: Lake, dt: str) -> dict[str, DataFrame]:
    """The ten dashboard queries of one day, by name; four of them share one pass over the transactions."""
    kpis = lake.read_day("mgmt_kpi", dt)
    summary = lake.read_day("cust_daily_summary", dt)
    customers = lake.read_day("sat_customer", dt)
    transactions = lake.read_day("sat_transaction", dt)
    shared = insights.cube_views(insights.transaction_cube(transactions))
    return {
        "kpi": insights.kpi_list(kpis),
        "aum_distribution": insights.aum_distribution(summary),
        "hourly_trend": shared["hourly_trend"],
        "channel_distribution": shared["channel_distribution"],
        "account_types": insights.account_types(lake.read_day("ods_account", dt)),
        "top_customers": insights.top_customers(summary, customers),
        "transaction_summary": shared["transaction_summary"],
        "transactions": insights.recent_transactions(transactions),
        "risk_overview": shared["risk_overview"],
        "risk_alerts": insights.risk_alerts(transactions),
    }


def export_dashboard(lake: Lake, dt: str, out: str) -> None:
    """Each dashboard query as JSON lines in its own folder."""
    for name, df in dashboard(lake, dt).items():
        export_json(df, f"{out.rstrip('/')}/{name}")


def reconcile_day(lake: Lake, dt: str) -> DataFrame:
    """Row counts of every table of one day, except the KPI table."""
    return checks.reconcile({name: lake.read_day(name, dt) for name in TABLES if name != "mgmt_kpi"})


def check_day(lake: Lake, dt: str, before: str | None = None) -> DataFrame:
    """The quality rules over one day's sources; with ``before``, row counts are held against that day.

    Rules that the loads of the days have counted are taken from there.
    """
    now, then = load_report(lake, dt), load_report(lake, before) if before else None
    earlier = day_sources(lake, before) if before and (now is None or then is None) else None
    return checks.quality_report(day_sources(lake, dt), earlier, counted=now, counted_before=then)


def change_table(lake: Lake) -> ChangeTable:
    """The transactions as change feeds leave them."""
    table = TABLES["ods_transaction"]
    return ChangeTable(lake.spark, f"{lake.root}/{table.database}/{table.physical}_changes", table.schema)


def apply_changes_day(lake: Lake, feed_rows: DataFrame, before: str, dt: str) -> None:
    """A change feed merged into the transactions, and what they are then written as day ``dt``.

    The first feed finds the rows of day ``before``. Later ones find the change
    table, whatever day they come from: an older change that comes late does not undo a newer one.
    """
    changes = change_table(lake)
    if not changes.has_base():
        changes.load(lake.read_day("ods_transaction", before).drop("dt"))
    changes.apply(feed.decode_changes(feed_rows), dt)
    lake.write_day("ods_transaction", changes.read(), dt)


def start_changes(lake: Lake, feed_rows: DataFrame, checkpoint: str, finite: bool = False) -> StreamingQuery:
    """Merges a live feed into the change table, a batch at a time; a retried batch replaces itself."""
    changes = change_table(lake)

    def merge(batch: DataFrame, number: int) -> None:
        changes.apply(feed.decode_changes(batch), f"stream-{number}")

    writer = feed_rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(merge)
    return (writer.trigger(availableNow=True) if finite else writer).start()


def run_day(
    lake: Lake,
    stage_root: str,
    dt: str,
    previous: str | None = None,
    extended: bool = False,
    quarantine: str | None = None,
    tracked: Iterable[str] = keys.TRACKED_ATTRIBUTES,
) -> None:
    """Load, vault and marts of one day."""
    load_day(lake, stage_root, dt, quarantine)
    build_vault_day(lake, dt, previous, tracked)
    build_marts_day(lake, dt, extended)
