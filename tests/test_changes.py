"""Change tables: any order and cut of a feed gives one result; late changes, deletes, compaction, retries."""

import itertools
import json
import random
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlake.plans import daily
from ledgerlake.schemas import SOURCES, struct
from ledgerlake.sources import feed
from ledgerlake.sources.changes import ChangeTable
from ledgerlake.sources.delimited import type_rows
from ledgerlake.sources.lake import Lake

SCHEMA = struct("trans_id string, trans_amt decimal(18,2), channel string")
KINDS = "trans_id string, trans_amt decimal(18,2), channel string, op string, es long, batch long, pos int"


def changes(spark, *rows):
    """(key, amount, op, es) rows."""
    return spark.createDataFrame([(k, None if a is None else Decimal(a), "c", op, es, es, 0) for k, a, op, es in rows], KINDS)


def shown(table):
    return sorted(((r.trans_id, None if r.trans_amt is None else int(r.trans_amt)) for r in table.read().collect()), key=str)


def base(spark, *rows):
    return spark.createDataFrame([(k, Decimal(a), "b") for k, a in rows], "trans_id string, trans_amt decimal(18,2), channel string")


FEED = [("a", 1, "INSERT", 100), ("a", 2, "UPDATE", 200), ("b", 3, "INSERT", 150), ("b", None, "DELETE", 300), ("b", 9, "UPDATE", 250), ("x", 7, "UPDATE", 120)]


def test_any_order_of_batches_gives_one_result(spark, tmp_path):
    for n, order in enumerate(itertools.islice(itertools.permutations(range(3)), 0, 6, 2)):
        table = ChangeTable(spark, f"{tmp_path}/{n}", SCHEMA)
        table.load(base(spark, ("x", 5), ("y", 6)))
        for k in order:
            table.apply(changes(spark, *FEED[2 * k : 2 * k + 2]), str(k))
            if k == 1:
                table.compact()
        assert shown(table) == [("a", 2), ("x", 7), ("y", 6)]
        table.compact()
        assert table.batches() == [] and shown(table) == [("a", 2), ("x", 7), ("y", 6)]


def test_an_older_change_that_comes_late_loses(spark, tmp_path):
    table = ChangeTable(spark, str(tmp_path), SCHEMA)
    table.load(base(spark, ("k", 0)))
    table.apply(changes(spark, ("k", 200, "UPDATE", 200), ("d", None, "DELETE", 200)), "1")
    table.compact()
    table.apply(changes(spark, ("k", 100, "UPDATE", 100), ("d", 100, "INSERT", 100)), "2")
    assert shown(table) == [("k", 200)]  # nor does the deleted key come back
    table.compact(forget_before=201)
    table.apply(changes(spark, ("d", 150, "INSERT", 150)), "3")
    assert shown(table) == [("d", 150), ("k", 200)]  # a delete that was given up


def test_random_feeds_against_brute_force(spark, tmp_path):
    rng = random.Random(1)
    rows = [(rng.choice("abcdefgh"), rng.randint(0, 99), rng.choice(["INSERT", "UPDATE", "DELETE"]), t) for t in rng.sample(range(1000), 120)]
    known = {"a": 1000, "z": 1001}
    for k, a, op, _ in sorted(rows, key=lambda r: r[3]):
        known.pop(k, None)
        if op != "DELETE":
            known[k] = a
    table = ChangeTable(spark, str(tmp_path), SCHEMA)
    table.load(base(spark, ("a", 1000), ("z", 1001)))
    rng.shuffle(rows)
    for n in range(4):
        table.apply(changes(spark, *rows[30 * n : 30 * n + 30]), str(n))
    table.apply(changes(spark, *rows[:30]), "0")  # once more
    assert shown(table) == sorted(known.items())


def test_rows_without_changes_stay_as_they_are(spark, tmp_path):
    table = ChangeTable(spark, str(tmp_path), SCHEMA)
    assert not table.has_base() and shown(table) == []
    table.load(base(spark, ("t", 1), ("t", 2), ("u", 3), ("u", 3), (None, 4)))
    table.apply(changes(spark, ("u", 8, "UPDATE", 1), (None, 5, "UPDATE", 1)), "1")
    assert sorted(map(str, shown(table))) == sorted(map(str, [("t", 1), ("t", 2), ("u", 8), (None, 4)]))
    empty = ChangeTable(spark, f"{tmp_path}/none", SCHEMA)
    empty.apply(changes(spark, ("n", 1, "INSERT", 1)), "1")
    empty.compact()
    assert shown(empty) == [("n", 1)]


def test_a_reader_keeps_its_version_and_old_folders_go(spark, tmp_path):
    table = ChangeTable(spark, str(tmp_path), SCHEMA)
    table.load(base(spark, ("a", 1)))
    reader = table.read()
    table.apply(changes(spark, ("a", 2, "UPDATE", 5)), "1")
    table.compact()
    assert [int(r.trans_amt) for r in reader.collect()] == [1]
    assert [int(r.trans_amt) for r in table.read(version=2).collect()] == [2]
    assert table.vacuum(keep=1, older_than=0) == 2 and shown(table) == [("a", 2)]


def test_the_base_is_not_shuffled_for_few_changes(spark, tmp_path):
    table = ChangeTable(spark, str(tmp_path), SCHEMA)
    spark.range(300_000).select(F.col("id").cast("string").alias("trans_id"), F.lit(1).cast("decimal(18,2)").alias("trans_amt"), F.lit("b").alias("channel")).createOrReplaceTempView("rows")
    table.load(spark.table("rows"))
    table.apply(changes(spark, ("5", 2, "UPDATE", 5), ("7", None, "DELETE", 5)), "1")
    merged = table.read()
    assert merged.count() == 299_999
    plan = merged._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():  # the base is the one side of broadcast joins only
        assert "SortMergeJoin" not in line or "trans_id" in line
    assert "BroadcastHashJoin" in plan and "LeftAnti, BuildRight" in plan


def envelope(es, op, **cells):
    return json.dumps({"id": es, "database": "bank_source", "table": "t_transaction", "type": op, "es": es, "isDdl": False, "data": [cells]})


def test_days_and_a_live_feed_share_one_table(spark, tmp_path):
    lake = Lake(spark, f"{tmp_path}/lake")
    rows = spark.createDataFrame([("1", "10"), ("2", "20")], "trans_id string, trans_amt string")
    for name in SOURCES["transaction"].schema.names:
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("string"))
    lake.write_day("ods_transaction", type_rows(rows, "transaction", "2026-06-13"), "2026-06-13")
    topic = lambda *lines: spark.createDataFrame([(x,) for x in lines], "value string")
    daily.apply_changes_day(lake, topic(envelope(200, "UPDATE", trans_id="1", trans_amt="11"), envelope(210, "DELETE", trans_id="2")), "2026-06-13", "2026-06-14")
    daily.apply_changes_day(lake, topic(envelope(100, "UPDATE", trans_id="1", trans_amt="9"), envelope(120, "INSERT", trans_id="2", trans_amt="7")), "2026-06-14", "2026-06-15")
    for dt in ("2026-06-14", "2026-06-15"):
        assert [(r.trans_id, r.trans_amt) for r in lake.read_day("ods_transaction", dt).collect()] == [("1", Decimal("11.00"))]
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "1.json").write_text(envelope(300, "INSERT", trans_id="3", trans_amt="30") + "\n" + envelope(50, "INSERT", trans_id="2", trans_amt="1") + "\n")
    for _ in range(2):
        query = daily.start_changes(lake, feed.file_source(spark, str(folder)), f"{tmp_path}/cp", finite=True)
        query.awaitTermination()
    assert sorted((r.trans_id, int(r.trans_amt)) for r in daily.change_table(lake).read().collect()) == [("1", 11), ("3", 30)]
