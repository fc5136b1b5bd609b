"""Random inputs against plain Python."""

import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import history, marts, vault
from ledgerlake.schemas import SOURCES

DAYS = ["2026-06-01", "2026-06-02", "2026-06-03", "2026-06-04", "2026-06-05"]


@pytest.mark.parametrize("seed", range(4))
def test_versions_over_several_days(spark, seed):
    rng = random.Random(seed)
    snapshots = [{f"c{i}": rng.choice("AB") for i in range(30) if rng.random() < 0.7} for _ in DAYS]

    expected, current = [], {}
    for dt, snapshot in zip(DAYS, snapshots):
        for key in set(current) - {k for k, v in snapshot.items() if current.get(k, (None,))[0] == v}:
            level, start = current.pop(key)
            expected.append((key, level, start, dt, False))
        for key, level in snapshot.items():
            current.setdefault(key, (level, dt))
    expected += [(key, level, start, vault.OPEN_END, True) for key, (level, start) in current.items()]

    names = SOURCES["customer"].schema.names
    previous, days = None, None
    for dt, snapshot in zip(DAYS, snapshots):
        cells = [{"customer_id": k, "cust_name": k, "cust_level": v} for k, v in snapshot.items()]
        rows = spark.createDataFrame([tuple(c.get(n) for n in names) for c in cells], SOURCES["customer"].schema)
        today = vault.build_sat_customer(rows, dt)
        if previous is not None:
            today = history.next_customer_versions(previous, today, dt)
        # each day is stored before the next reads it
        today = spark.createDataFrame(today.collect(), today.schema)
        days = today.withColumn("dt", F.lit(dt)) if days is None else days.unionByName(today.withColumn("dt", F.lit(dt)))
        previous = today
    known = history.customer_history(days, DAYS[-1])
    got = [(r.cust_name, r.cust_level, str(r.load_date), str(r.load_end_date), r.is_current) for r in known.collect()]
    assert sorted(got) == sorted(expected)
    assert all(r.failed == 0 for r in history.version_rules(known).collect())


@pytest.mark.parametrize("seed", range(4))
def test_summary_of_random_links_and_balances(spark, seed):
    rng = random.Random(seed)
    links = [(f"c{rng.randrange(6)}", f"a{rng.randrange(8)}") for _ in range(40)]
    balances = [(f"a{rng.randrange(10)}", rng.choice([None, Decimal(rng.randrange(-500, 500)) / 100])) for _ in range(30)]
    total, held = defaultdict(Decimal), defaultdict(set)
    for customer, account in links:
        for other, amount in balances:
            if account == other:
                total[customer] += amount or 0
                held[customer].add(account)
    summary = marts.customer_summary(
        spark.createDataFrame(links, "customer_hash_key string, account_hash_key string"),
        spark.createDataFrame(balances, "account_hash_key string, balance decimal(18,2)"),
    )
    got = {r.customer_hash_key: (r.total_asset_amt, r.account_cnt) for r in summary.collect()}
    assert got == {c: (total[c], len(held[c])) for c in held}


@pytest.mark.parametrize("seed", range(3))
def test_newest_change_per_key(spark, seed):
    rng = random.Random(seed)
    changes = [(f"k{rng.randrange(8)}", rng.choice(["INSERT", "UPDATE", "DELETE"]), rng.randrange(5), rng.randrange(4), i)
               for i in range(60)]
    newest = {}
    for row in changes:
        if row[0] not in newest or row[2:] > newest[row[0]][2:]:
            newest[row[0]] = row
    df = spark.createDataFrame(changes, "trans_id string, op string, es long, batch long, pos int")
    got = sorted(tuple(r) for r in history.latest_changes(df).select("trans_id", "op", "es", "batch", "pos").collect())
    assert got == sorted(r for r in newest.values() if r[1] != "DELETE")
