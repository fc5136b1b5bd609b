from collections import Counter

import pytest

from ledgerlake.operators import insights
from ledgerlake.plans import daily, fixtures
from ledgerlake.plans.registry import comparable
from ledgerlake.schemas import SOURCES, TABLES
from ledgerlake.sources.delimited import write_text
from ledgerlake.sources.lake import Lake, publish_tables

D1, D2 = "2024-01-30", "2024-01-31"


def stage(spark, root, sf_dir, dt, **changed):
    for name, df in {**fixtures.sources(spark, sf_dir), **changed}.items():
        write_text(df, SOURCES[name].stage_path(root, dt))


@pytest.fixture(scope="module")
def run(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("daily")
    lake = Lake(spark, str(root / "lake"))
    stages = str(root / "stg")
    # the second day: no customer of the first nation group any more, levels of corporates changed
    stage(spark, stages, sf_dir, D1)
    stage(spark, stages, sf_dir, D2, customer=fixtures.customers(spark, sf_dir).where("nationality <> 'NATION_1'")
          .selectExpr(*[c if c != "cust_level" else "if(cust_type = 'CORPORATE', 'VIP', cust_level) as cust_level"
                        for c in SOURCES["customer"].schema.names]))
    daily.run_day(lake, stages, D1)
    daily.run_day(lake, stages, D2, previous=D1, extended=True)
    return lake, stages


def bag(df):
    return Counter(tuple(r) for r in comparable(df).collect())


def test_first_day_equals_the_operators_on_the_tables(spark, sf_dir, run):
    lake, _ = run
    from ledgerlake.plans import registry

    for table, query in (("cust_daily_summary", registry.cust_daily_summary), ("mgmt_kpi", registry.mgmt_kpi)):
        assert bag(lake.read_day(table, D1).drop("dt")) == bag(query(spark, sf_dir)), table


def test_every_table_has_its_day(run):
    lake, _ = run
    counts = {r.table_name: r.row_cnt for r in daily.reconcile_day(lake, D1).collect()}
    assert set(counts) == set(TABLES) - {"mgmt_kpi"} and all(counts.values())
    assert lake.latest_day().first().dt == D2


def test_a_rerun_changes_nothing(run):
    lake, stages = run
    names = ["sat_customer", "link_cust_acct", "cust_daily_summary", "mgmt_kpi", "hub_org"]
    before = {n: bag(lake.read(n)) for n in names}
    daily.run_day(lake, stages, D2, previous=D1, extended=True)
    assert {n: bag(lake.read(n)) for n in names} == before


def test_bad_cells_are_set_aside(spark, run, tmp_path):
    lake, stages = run
    daily.load_day(Lake(spark, str(tmp_path / "lake")), stages, D1, str(tmp_path / "aside"))
    assert spark.read.schema("rejected array<string>").json(f"{tmp_path}/aside/*/dt={D1}").count() == 0
    text = spark.createDataFrame([("P1", "ten", "2024-01-30 10:00:00"), ("P2", "10", "x")], "pay_id string, amount string, create_time string")
    for name in SOURCES["payment"].schema.names:
        if name not in text.columns:
            text = text.selectExpr("*", f"cast(null as string) as {name}")
    root = str(tmp_path / "stg")
    stage(spark, root, "/root/testdata/sf0.001", D1)
    write_text(text, SOURCES["payment"].stage_path(root, D1))
    other = Lake(spark, str(tmp_path / "lake"))
    daily.load_day(other, root, D1, str(tmp_path / "aside"))
    aside = spark.read.json(f"{tmp_path}/aside/payment/dt={D1}").collect()
    assert {r.pay_id: r.rejected for r in aside} == {"P1": ["amount"], "P2": ["create_time"]}
    assert other.read_day("ods_payment", D1).count() == 2


def test_sql_users_read_the_published_days(spark, run):
    lake, _ = run
    for table in TABLES.values():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.database}")
        spark.sql(f"DROP TABLE IF EXISTS {table.qualified}")
    publish_tables(lake)
    for name, table in TABLES.items():
        published = spark.table(table.qualified)
        assert sorted({r.dt for r in published.select("dt").distinct().collect()}) == lake.days(name)
        assert bag(published.where(published.dt == D1).select(*lake.read_day(name, D1).columns)) == bag(lake.read_day(name, D1)), name
    publish_tables(lake)  # nothing new
    for table in TABLES.values():
        spark.sql(f"DROP TABLE {table.qualified}")


def test_command_line(spark, sf_dir, run, tmp_path):
    lake, stages = run
    from ledgerlake.__main__ import main

    out = tmp_path / "out"
    main(["run", "--lake", str(tmp_path / "lake"), "--stage", stages, "--dt", D1], spark)
    main(["export", "--lake", str(tmp_path / "lake"), "--dt", D1, "--out", str(out)], spark)
    assert len(list(out.iterdir())) == 10
    assert bag(Lake(spark, str(tmp_path / "lake")).read_day("mgmt_kpi", D1)) == bag(lake.read_day("mgmt_kpi", D1))


def test_history_of_the_second_day(run):
    lake, _ = run
    first, second = lake.read_day("sat_customer", D1), lake.read_day("sat_customer", D2)
    total, corporate = first.count(), first.where("cust_type = 'CORPORATE'").count()
    left = first.where("nationality = 'NATION_1'").count()
    left_corporate = first.where("nationality = 'NATION_1' and cust_type = 'CORPORATE'").count()
    assert left and second.where("is_current").count() == total - left
    assert second.where("not is_current").count() == left + corporate - left_corporate
    assert second.where("is_current and load_date = date'2024-01-31'").count() == corporate - left_corporate


def test_a_day_is_not_built_from_itself(run):
    lake, _ = run
    for previous in (D2, "2024-02-01"):
        with pytest.raises(ValueError):
            daily.build_vault_day(lake, D2, previous)


def test_dashboards_agree(run, tmp_path):
    lake, _ = run
    views = daily.dashboard(lake, D1)
    assert len(views) == 10
    kpis = {r.kpi_code: r.kpi_value for r in views["kpi"].collect()}
    total = views["transaction_summary"].first()
    assert sum(r.cnt for r in views["channel_distribution"].collect()) == total.total_cnt
    assert sum(r.cnt for r in views["hourly_trend"].collect()) == total.total_cnt
    assert total.total_amt == kpis["DAILY_TXN_AMT"] and total.total_cnt >= kpis["DAILY_TXN_CNT"]
    assert sum(r.cnt for r in views["account_types"].collect()) == kpis["TOTAL_ACCOUNT"]
    assert sum(r.cnt for r in views["aum_distribution"].collect()) == lake.read_day("cust_daily_summary", D1).count()
    assert views["transactions"].count() == 20 and views["risk_alerts"].count() == 10
    daily.export_dashboard(lake, D1, str(tmp_path))
    again = lake.spark.read.json(f"{tmp_path}/account_types")
    assert {(r.type, r.cnt) for r in again.collect()} == {(r.type, r.cnt) for r in views["account_types"].collect()}
    assert insights.preview(lake.read_day("sat_transaction", D1)).count() == 5


def test_stored_days_are_read_alone(run):
    lake, _ = run
    df = lake.read_day("sat_transaction", D1).select("trans_amt").where("trans_amt > 500000")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(trans_amt,500000.00)" in plan and "ReadSchema: struct<trans_amt:decimal(18,2)>" in plan
    assert df.inputFiles() and all(f"/dt={D1}/" in f for f in df.inputFiles())


def test_a_day_is_built_from_the_newest_written_before_it(spark, run, tmp_path):
    lake, stages = run
    other = Lake(spark, str(tmp_path / "lake"))
    daily.load_day(other, stages, D1)
    with pytest.raises(ValueError):  # none written before
        daily.build_vault_day(other, D1, "2026-01-01")
    daily.build_vault_day(other, D1)
    daily.load_day(other, stages, D2)
    with pytest.raises(FileNotFoundError):  # its sources were never loaded
        daily.build_vault_day(other, "2026-12-30", D1)
    with pytest.raises(ValueError):
        daily.build_vault_day(other, D2, "2026-01-01")
    daily.build_vault_day(other, D2, D1)
    first = {r.customer_id: r.load_date for r in other.read_day("hub_customer", D1).collect()}
    kept = [r for r in other.read_day("hub_customer", D2).collect() if r.customer_id in first]
    assert kept and all(r.load_date == first[r.customer_id] for r in kept)


def test_quality_of_a_day(run):
    lake, _ = run
    assert {r.rule for r in daily.check_day(lake, D1).collect()} >= {"null_key", "duplicate_key", "orphan_account"}
    assert "row_count_drift" in {r.rule for r in daily.check_day(lake, D2, D1).collect()}


def test_loads_count_what_the_rules_need(spark, run):
    lake, _ = run
    counted = {(r.rule, r.table_name): (r.failed, r.total) for r in daily.load_report(lake, D1).collect()}
    from ledgerlake.operators import checks

    for r in checks.quality_report(daily.day_sources(lake, D1)).collect():
        if (r.rule, r.table_name) in counted:
            assert counted[r.rule, r.table_name] == (r.failed, r.total)
    assert ("balance_identity", "balance") in counted and len(counted) == 17
    report = {(r.rule, r.table_name): r.failed for r in daily.check_day(lake, D2, D1).collect()}
    assert {t for rule, t in report if rule == "row_count_drift"} == set(SOURCES)


def test_one_pass_gives_the_four_views(run):
    lake, _ = run
    rows = lake.read_day("sat_transaction", D1)
    for data in (rows, rows.limit(0)):
        for computed in (False, True):
            views = insights.cube_views(insights.transaction_cube(data), computed)
            known = {
                "hourly_trend": insights.hourly_trend(data), "channel_distribution": insights.channel_distribution(data),
                "transaction_summary": insights.transaction_summary(data), "risk_overview": insights.risk_overview(data, computed_rates=computed),
            }
            for name, df in known.items():
                assert [tuple(r) for r in views[name].collect()] == [tuple(r) for r in df.collect()], name
