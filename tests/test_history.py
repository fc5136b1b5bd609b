from datetime import date
from decimal import Decimal

from ledgerlake.operators import checks, history, patterns, vault
from ledgerlake.schemas import SOURCES
from ledgerlake.sources import feed

D1, D2, D3 = "2026-06-13", "2026-06-14", "2026-06-15"
CUSTOMER = vault.CUSTOMER.key


def customers(spark, *rows):
    """(id, level, address) rows as the customer source."""
    from ledgerlake.schemas import SOURCES

    names = SOURCES["customer"].schema.names
    cells = [{"customer_id": i, "cust_level": lv, "address": ad} for i, lv, ad in rows]
    return spark.createDataFrame([tuple(c.get(n) for n in names) for c in cells], SOURCES["customer"].schema)


def day(spark, dt, *rows):
    return vault.build_sat_customer(customers(spark, *rows), dt)


def shape(df):
    return sorted((r.cust_level, str(r.load_date), str(r.load_end_date), r.is_current) for r in df.collect())


OPEN = "9999-12-31"


def test_versions_carry_close_open_and_end(spark):
    first = day(spark, D1, ("same", "A", "x"), ("moved", "B", "x"), ("tracked", "C", "x"), ("gone", "D", "x"))
    second = day(spark, D2, ("same", "A", "x"), ("moved", "B", "y"), ("tracked", "C2", "x"), ("new", "E", "x"))
    rows = history.next_customer_versions(first, second, D2)
    assert shape(rows) == sorted([
        ("A", D1, OPEN, True), ("B", D1, OPEN, True),  # address is not tracked
        ("C", D1, D2, False), ("C2", D2, OPEN, True), ("D", D1, D2, False), ("E", D2, OPEN, True)])
    kept = history.next_customer_versions(first, second, D2, close_missing=False)
    assert ("D", D1, OPEN, True) in shape(kept)


def test_untracked_attributes_are_those_of_today(spark):
    first = day(spark, D1, ("a", "A", "old street"), ("b", "B", "x"))
    second = history.next_customer_versions(first, day(spark, D2, ("a", "A", "new street"), ("b", "B2", "y")), D2)
    rows = sorted((r.cust_level, r.address, str(r.load_date), r.is_current) for r in second.collect())
    assert rows == [("A", "new street", D1, True), ("B", "x", D1, False), ("B2", "y", D2, True)]
    third = history.next_customer_versions(second, day(spark, D3, ("a", "A", None), ("b", "B2", "y")), D3)
    assert sorted((r.cust_level, r.address, str(r.load_date)) for r in third.collect()) == [("A", None, D1), ("B2", "y", D2)]


def test_tracked_attributes_are_a_parameter(spark):
    def tracked(dt, *rows):
        sources = {n: spark.createDataFrame([], s.schema) for n, s in SOURCES.items()}
        return vault.build_vault({**sources, "customer": customers(spark, *rows)}, dt, ("cust_level", "address"))["sat_customer"]

    moved = history.next_customer_versions(tracked(D1, ("a", "A", "x")), tracked(D2, ("a", "A", "y")), D2)
    assert shape(moved) == [("A", D1, D2, False), ("A", D2, OPEN, True)]


def test_third_day_ignores_closed_rows_and_a_return_opens_anew(spark):
    first = day(spark, D1, ("a", "A", "x"), ("b", "B", "x"))
    second = history.next_customer_versions(first, day(spark, D2, ("a", "A2", "x")), D2)
    third = history.next_customer_versions(second, day(spark, D3, ("a", "A2", "x"), ("b", "B", "x")), D3)
    assert shape(third) == [("A2", D2, OPEN, True), ("B", D3, OPEN, True)]
    assert third.columns == first.columns

    from pyspark.sql import functions as F

    days = first.withColumn("dt", F.lit(D1))
    for df, dt in ((second, D2), (third, D3)):
        days = days.unionByName(df.withColumn("dt", F.lit(dt)))
    known = history.customer_history(days, D3)
    assert shape(known) == sorted([("A", D1, D2, False), ("B", D1, D2, False), ("A2", D2, OPEN, True), ("B", D3, OPEN, True)])
    assert {r.rule: r.failed for r in history.version_rules(known).collect()} == {
        "several_current": 0, "ends_before_start": 0, "repeated_start": 0}
    doubled = history.version_rules(known.unionByName(known))
    assert {r.rule: r.failed for r in doubled.collect()} == {"several_current": 2, "ends_before_start": 0, "repeated_start": 2}


def test_repeated_customer_rows_give_one_version(spark):
    twice = day(spark, D2, ("a", "A", "x"), ("a", "B", "x"), ("a", "A", "x"))
    rows = history.next_customer_versions(day(spark, D1, ("z", "Z", "x")), twice, D2)
    assert rows.where("is_current").count() == 1


def test_first_seen_and_new_rows(spark):
    def hub(dt, *ids):
        return vault.build_hub(spark.createDataFrame([(i,) for i in ids], "customer_id string"), vault.CUSTOMER, dt)

    both = hub(D1, "a", "b").unionByName(hub(D2, "b", "c"))
    seen = {r.customer_id: str(r.load_date) for r in history.first_seen(both, CUSTOMER, "customer_id").collect()}
    assert seen == {"a": D1, "b": D1, "c": D2}
    assert [r.customer_id for r in history.new_hub_rows(hub(D2, "b", "c"), hub(D1, "a", "b"), CUSTOMER).collect()] == ["c"]


def test_links_end_once(spark):
    def link(dt, *pairs):
        rows = spark.createDataFrame([(a, c, date(2020, 1, 1)) for a, c in pairs], "account_no string, customer_id string, open_date date")
        return vault.build_link_cust_acct(rows, dt)

    second = history.next_links(link(D1, ("a", "x"), ("b", "x")), link(D2, ("a", "x"), ("c", "y")), D2)
    got = sorted((str(r.load_date), str(r.rel_end_date), r.is_active) for r in second.collect())
    assert got == [(D1, "2026-06-14", False), (D1, "None", True), (D2, "None", True)]
    third = history.next_links(second, link(D3, ("a", "x"), ("c", "y")), D3)
    assert third.count() == 2 and third.where("not is_active").count() == 0


FEED = [
    '{"id":1,"database":"bank_source","table":"t_transaction","type":"INSERT","es":100,"ts":1,"isDdl":false,'
    '"data":[{"trans_id":"1","trans_amt":"10.5","trans_time":"2026-06-14 10:00:00"},{"trans_id":"2","trans_amt":"x"}]}',
    '{"id":2,"database":"bank_source","table":"t_transaction","type":"UPDATE","es":200,"data":[{"trans_id":"1","trans_amt":"11"},{"trans_id":"1","trans_amt":"12"}]}',
    '{"id":3,"database":"bank_source","table":"t_transaction","type":"DELETE","es":300,"data":[{"trans_id":"2"}]}',
    '{"id":4,"table":"other","type":"INSERT","es":400,"data":[{"trans_id":"9"}]}',
    '{"id":5,"database":"bank_source","table":"t_transaction","type":"CREATE","es":500,"isDdl":true,"data":null}',
    '{"trans_id":"plain","trans_amt":7}', "broken", None,
]


def test_change_feed(spark):
    topic = spark.createDataFrame([(x,) for x in FEED], "value string")
    changes = feed.decode_changes(topic)
    assert changes.count() == 5
    latest = history.latest_changes(changes).collect()
    assert [(r.trans_id, r.trans_amt, r.op) for r in latest] == [("1", Decimal("12.00"), "UPDATE")]
    base = spark.createDataFrame([("2", Decimal(1)), ("3", Decimal(3))], "trans_id string, trans_amt decimal(18,2)")
    assert sorted(tuple(r) for r in history.apply_changes(base, changes).collect()) == [("1", Decimal("12.00")), ("3", Decimal("3.00"))]
    assert [r.trans_id for r in feed.decode_rows(topic).collect()] == ["plain"]


def test_changes_onto_a_base_with_a_common_and_a_missing_key(spark):
    changes = feed.decode_changes(spark.createDataFrame([(x,) for x in FEED], "value string"))
    rows = [("2", Decimal(i)) for i in range(50)] + [(None, Decimal(i)) for i in range(50)] + [("7", Decimal(i)) for i in range(50)]
    base = spark.createDataFrame(rows, "trans_id string, trans_amt decimal(18,2)")
    plain = sorted(map(str, history.apply_changes(base, changes).collect()))
    assert len(plain) == 101


def test_quality_rules(spark):
    acct = spark.createDataFrame([("A", "C"), ("A", "C"), ("A ", "C"), (None, "C"), ("", "X")], "account_no string, customer_id string")
    failed = {r.rule: (r.failed, r.total) for r in checks.key_rules(acct, "account", "account_no").collect()}
    assert failed == {"null_key": (2, 5), "duplicate_key": (2, 5)}
    owners = spark.createDataFrame([("C",), ("C",), (None,)], "customer_id string")
    assert checks.orphan_rule(acct, owners, "account", "customer_id", "orphan_customer").first().failed == 1
    bal = spark.createDataFrame([(Decimal(3), Decimal(2), Decimal(1)), (Decimal(3), Decimal(3), Decimal(1)), (None, None, None)],
                                "balance decimal(18,2), avail_balance decimal(18,2), frozen_amt decimal(18,2)")
    assert tuple(checks.balance_rule(bal).first()) == ("balance_identity", "balance", 1, 3)
    empty = acct.limit(0)
    assert {(r.failed, r.total) for r in checks.key_rules(empty, "account", "account_no").collect()} == {(0, 0)}
    assert checks.drift_rule(acct, empty, "account").first().failed == 1
    assert checks.drift_rule(acct, acct, "account").first().failed == 0


IN_OUT = [
    ("quick", "C", 200000, "10:01:00"), ("quick", "D", 190000, "10:04:00"), ("edge", "C", 200000, "10:09:00"), ("edge", "D", 190000, "10:11:00"),
    ("slow", "C", 200000, "10:00:00"), ("slow", "D", 190000, "11:00:00"), ("before", "D", 190000, "10:00:00"), ("before", "C", 200000, "10:01:00"),
    ("small", "C", 20, "10:00:00"), ("small", "D", 19, "10:01:00"),
    # mostly gone before the money came in
    ("first", "D", 190000, "10:00:00"), ("first", "C", 200000, "10:01:00"), ("first", "D", 1, "10:02:00"),
    ("late", "C", 200000, "10:04:00"), ("late", "D", 190000, "10:10:30"), ("limit", "C", 200000, "10:04:00"), ("limit", "D", 190000, "10:14:00"),
    ("over", "C", 200000, "10:04:00"), ("over", "D", 190000, "10:14:01"), ("same", "C", 200000, "10:04:00"), ("same", "D", 190000, "10:04:00"),
    ("twice", "C", 200000, "10:00:00"), ("twice", "C", 200000, "10:01:00"), ("twice", "D", 90000, "10:02:00"), ("twice", "D", 90000, "10:03:00"),
]


def test_fast_in_out(spark):
    rows = spark.createDataFrame([(a, f, Decimal(v), "2026-06-14 " + t) for a, f, v, t in IN_OUT] + [(None, "C", Decimal(200000), None)],
                                 "account_no string, dr_cr_flag string, trans_amt decimal(18,2), t string")
    rows = rows.selectExpr("*", "cast(t as timestamp) as trans_time")
    found = [r.account_no for r in patterns.fast_in_out(rows).collect()]
    assert sorted(found) == ["edge", "late", "limit", "quick", "twice", "twice"]


def in_out_rows(spark, rows):
    made = spark.createDataFrame([(a, f, Decimal(v), "2026-06-14 " + t) for a, f, v, t in rows], "account_no string, dr_cr_flag string, trans_amt decimal(18,2), t string")
    return made.selectExpr("*", "cast(t as timestamp) as trans_time")


def test_split_sums_find_the_same(spark):
    rows = in_out_rows(spark, [*IN_OUT, (None, "C", 200000, "10:00:00")])
    assert sorted(map(str, patterns.fast_in_out_split(rows).collect())) == sorted(map(str, patterns.fast_in_out(rows).collect()))


def test_a_hot_account_is_cut_into_ranges(spark):
    import random

    rng = random.Random(4)
    # one account has most rows, many of them in the same second
    rows = [
        ("hot" if rng.random() < 0.7 else rng.choice("abc"), rng.choice("CDD"), rng.randint(1, 300), f"10:{rng.choice([5, rng.randint(0, 59)]):02d}:{rng.randint(0, 9):02d}")
        for _ in range(4000)
    ]
    frame = in_out_rows(spark, rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = patterns.fast_in_out_split(frame, "1 minute", Decimal("100"), 0.5)
        assert sorted(map(str, found.collect())) == sorted(map(str, patterns.fast_in_out(frame, "1 minute", Decimal("100"), 0.5).collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "[account_no" in plan and plan.count("Window") == 2
    stored = spark.read.parquet(next(f for f in found.inputFiles()).rsplit("/", 1)[0])
    parts = stored.where("account_no = 'hot'").selectExpr("shiftright(place, 33) as part").distinct().count()
    assert parts >= 4


def test_night_activity(spark):
    rows = spark.createDataFrame([("a", f"2026-06-14 {h}:00:00") for h in ("01", "02", "23", "12")] + [("b", "2026-06-14 01:00:00")],
                                 "account_no string, t string").selectExpr("account_no", "cast(t as timestamp) as trans_time", "1.5 as trans_amt")
    assert [(r.account_no, r.night_cnt, r.night_amt) for r in patterns.night_activity(rows).collect()] == [("a", 3, Decimal("4.5"))]


def test_changes_of_other_databases_and_of_keys(spark):
    row = '"data": [{"trans_id": "%s", "trans_amt": "1.00"}]'
    lines = [
        '{"id": 1, "database": "bank_source", "table": "t_transaction", "type": "INSERT", "es": 1, ' + row % 1 + "}",
        '{"id": 2, "database": "other_db", "table": "t_transaction", "type": "UPDATE", "es": 2, ' + row % 9 + "}",
        '{"id": 3, "database": "bank_source", "table": "t_transaction", "type": "UPDATE", "es": 3, "old": [{"trans_id": "1"}], ' + row % 2 + "}",
        '{"id": 4, "database": "bank_source", "table": "t_transaction", "type": "UPDATE", "es": 4, "old": [{"memo": "x"}], ' + row % 2 + "}",
    ]
    changes = feed.decode_changes(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert sorted((r.op, r.trans_id) for r in changes.collect()) == [("DELETE", "1"), ("INSERT", "1"), ("UPDATE", "2"), ("UPDATE", "2")]
    assert [r.trans_id for r in history.latest_changes(changes).collect()] == ["2"]


def test_rules_on_one_table_and_key_share_a_shuffle(spark, tmp_path):
    for name in ("account", "balance"):
        spark.range(50).selectExpr("cast(id as string) as account_no", "cast(id as string) as customer_id").write.parquet(f"{tmp_path}/{name}")
    acct, bal = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("account", "balance"))
    report = checks.key_rules(acct, "account", "account_no").unionByName(checks.key_rules(bal, "balance", "account_no")).unionByName(
        checks.orphan_rule(bal, acct, "balance", "account_no", "orphan_account"))
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan
