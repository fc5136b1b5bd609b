"""First-seen days that survive absent, late and repeated days."""

from datetime import date

from pyspark.sql import functions as F

from ledgerlake.operators import vault
from ledgerlake.plans import daily
from ledgerlake.sources.known_keys import KnownKeys
from ledgerlake.sources.lake import Lake

D1, D2, D3 = "2026-06-13", "2026-06-14", "2026-06-15"
KEY = vault.CUSTOMER.key


def hub(spark, dt, *ids):
    return vault.build_hub(spark.createDataFrame([(i,) for i in ids], "customer_id string"), vault.CUSTOMER, dt)


def dates(df):
    return {r.customer_id: str(r.load_date) for r in df.collect()}


def test_absent_days_do_not_reset_a_key(spark, tmp_path):
    known = KnownKeys(spark, str(tmp_path), KEY)
    known.add(hub(spark, D1, "a", "b"), D1)
    assert dates(known.first_seen(hub(spark, D2, "b", "c"), D2)) == {"b": D1, "c": D2}
    known.add(hub(spark, D2, "b", "c"), D2)
    assert dates(known.first_seen(hub(spark, D3, "a", "b", "c", "d"), D3)) == {"a": D1, "b": D1, "c": D2, "d": D3}
    assert known.days() == [D1, D2] and known.known().count() == 3


def test_days_may_come_late_and_again(spark, tmp_path):
    known = KnownKeys(spark, str(tmp_path), KEY)
    known.add(hub(spark, D2, "a", "b"), D2)
    assert dates(known.first_seen(hub(spark, D1, "a"), D1)) == {"a": D1}
    known.add(hub(spark, D1, "a"), D1)
    assert dates(known.first_seen(hub(spark, D3, "a", "b"), D3)) == {"a": D1, "b": D2}
    known.add(hub(spark, D2, "b", "e"), D2)  # the day is written anew, with other keys
    assert dates(known.first_seen(hub(spark, D3, "a", "b", "e"), D3)) == {"a": D1, "b": D2, "e": D2}
    assert dates(known.first_seen(hub(spark, D2, "b"), D2)) == {"b": D2}


def test_the_filter_never_hides_a_known_key(spark, tmp_path):
    ids = spark.range(20_000).select(F.col("id").cast("string").alias("customer_id"))
    first = vault.build_hub(ids, vault.CUSTOMER, D1)
    for bitmaps in (1, 64):  # crowded and roomy
        known = KnownKeys(spark, f"{tmp_path}/{bitmaps}", KEY, bitmaps)
        known.add(first, D1)
        today = vault.build_hub(ids.selectExpr("cast(customer_id + 10000 as string) as customer_id"), vault.CUSTOMER, D2)
        counts = {str(r.load_date): r["count"] for r in known.first_seen(today, D2).groupBy("load_date").count().collect()}
        assert counts == {D1: 10_000, D2: 10_000}


def test_only_perhaps_known_keys_meet_the_stored_ones(spark, tmp_path):
    known = KnownKeys(spark, str(tmp_path), KEY)
    known.add(hub(spark, D1, "a"), D1)
    plan = known.first_seen(hub(spark, D2, "a", "b"), D2)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join LeftOuter, (customer_hash_key" in line]
    assert joins and "Filter" in plan[plan.index(joins[0]) :].splitlines()[1] + plan[plan.index(joins[0]) :].splitlines()[2]


def test_the_daily_run_keeps_first_days(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path))
    days = {D1: ("a", "b"), D2: ("b",), D3: ("a", "b", "c")}

    def sources(lake, dt):
        empty = {n: spark.createDataFrame([], s.schema) for n, s in daily.SOURCES.items()}
        rows = [tuple(i if n == "customer_id" else None for n in daily.SOURCES["customer"].schema.names) for i in days[dt]]
        return {**empty, "customer": spark.createDataFrame(rows, daily.SOURCES["customer"].schema)}

    monkeypatch.setattr(daily, "day_sources", sources)
    daily.build_vault_day(lake, D1)  # without a history: found later
    daily.build_vault_day(lake, D2, D1)
    daily.build_vault_day(lake, D3, D2)
    daily.build_vault_day(lake, D3, D2)
    assert dates(lake.read_day("hub_customer", D3)) == {"a": D1, "b": D1, "c": D3}
    assert dates(lake.read_day("hub_customer", D2)) == {"b": D1}
    first = lake.read_day("sat_customer", D3).where("is_current").select("load_date").distinct().collect()
    assert {r.load_date for r in first} == {date(2026, 6, 13), date(2026, 6, 15)}
