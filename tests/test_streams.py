import json
import os
from collections import defaultdict
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

import pytest

from ledgerlake.operators import patterns
from ledgerlake.session import STREAM_CONF
from ledgerlake.sources import feed
from ledgerlake.sources.snapshots import SnapshotLog
from ledgerlake.streaming import detect, monitor


def row(time, account="a", amount=1, channel="ATM", **more):
    return {"trans_id": f"T{time}{account}", "account_no": account, "trans_amt": amount, "channel": channel,
            "trans_time": f"2026-06-14 {time}", **more}


class Topic:
    """A folder of JSON-line files, oldest first."""

    def __init__(self, folder):
        self.folder, self.count = folder, 0
        folder.mkdir()

    def send(self, *rows):
        path = self.folder / f"{self.count:03d}.json"
        path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n")
        os.utime(path, (1_700_000_000 + self.count, 1_700_000_000 + self.count))
        self.count += 1


def timed(spark, topic, per_trigger=1):
    return monitor.with_event_time(feed.decode_rows(feed.file_source(spark, str(topic.folder), per_trigger)))


def stats(df):
    return sorted((str(r.window_start)[11:], r.channel, r.txn_cnt, r.txn_amt, r.active_accounts) for r in df.collect())


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def test_lenient_decode(spark):
    rows = ['{"trans_id":"1","trans_amt":"x","channel":"ATM"}', '{"trans_id":"2","trans_amt":"7.125"}', "{broken", "", "[]", "{}",
            '{"other":1}', '{"trans_id":null,"account_no":"A"}', '{"trans_id":"3","trans_amt":5,"memo":null,"extra":[1]}']
    got = feed.decode_rows(spark.createDataFrame([(r,) for r in rows], "value string")).collect()
    assert [(r.trans_id, r.account_no, r.trans_amt) for r in got] == [
        ("1", None, None), ("2", None, Decimal("7.13")), (None, "A", None), ("3", None, Decimal("5.00"))]


def test_bytes_decode_like_text(spark):
    df = spark.createDataFrame([(json.dumps(row("10:00:00")).encode(),)], "value binary")
    assert feed.decode_rows(df).first().account_no == "a"


def test_append_windows_drop_late_rows_and_keep_the_last_window_open(spark, tmp_path):
    topic = Topic(tmp_path / "in")
    topic.send(row("10:00:01", "a"), row("10:00:02", "b", 2), row("10:00:03", "a", 3))
    topic.send(row("10:00:04", "c", 4), row("10:01:00"))  # in time; moves the watermark to 10:00:50
    topic.send(row("10:05:00"))
    topic.send(row("10:00:05", "d"), row("10:05:01", "b"))  # first row far behind the watermark: dropped
    topic.send(row("10:20:00"))
    windows = monitor.channel_windows(timed(spark, topic))
    finish(monitor.start_append(windows, str(tmp_path / "out"), str(tmp_path / "cp"), finite=True))
    got = stats(spark.read.schema(windows.schema).parquet(str(tmp_path / "out")))
    assert got == [("10:00:00", "ATM", 4, Decimal("10.00"), 3), ("10:01:00", "ATM", 1, Decimal("1.00"), 1),
                   ("10:05:00", "ATM", 2, Decimal("2.00"), 2)]


def test_live_windows_hold_open_ones_and_survive_a_restart(spark, tmp_path):
    topic = Topic(tmp_path / "in")
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    topic.send(row("10:00:01", "a"), row("10:00:02", "b"))
    topic.send(row("10:00:03", "a", 5), row("10:00:04", None, None))
    finish(monitor.start_account_windows(timed(spark, topic), out, cp, finite=True))
    assert stats(monitor.read_channel_windows(spark, out)) == [("10:00:00", "ATM", 4, Decimal("7.00"), 2)]
    topic.send(row("10:00:05", "c"), row("10:00:11", "a"))
    finish(monitor.start_account_windows(timed(spark, topic), out, cp, finite=True))
    assert stats(monitor.read_channel_windows(spark, out)) == [
        ("10:00:00", "ATM", 5, Decimal("8.00"), 3), ("10:00:10", "ATM", 1, Decimal("1.00"), 1)]
    finish(monitor.start_account_windows(timed(spark, topic), out, cp, finite=True))  # nothing new
    assert len(stats(monitor.read_channel_windows(spark, out))) == 2


def test_hot_channel_and_account_equal_brute_force(spark):
    rows = spark.range(9000).select(
        F.concat(F.lit("2026-06-14 10:0"), (F.col("id") % 5).cast("string"), F.lit(":01")).alias("trans_time"),
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("C"), (F.col("id") % 11).cast("string"))).alias("channel"),
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("account_no"),
        (F.col("id") % 13).cast("decimal(18,2)").alias("trans_amt"))
    got = stats(monitor.channel_windows(monitor.with_event_time(rows)))
    count, amount, held = defaultdict(int), defaultdict(Decimal), defaultdict(set)
    for r in rows.collect():
        key = (r.trans_time[11:18] + "0", r.channel)
        count[key] += 1
        amount[key] += r.trans_amt
        held[key].add(r.account_no)
    assert got == sorted((*k, count[k], amount[k], len(held[k])) for k in count)


def test_alerts(spark, tmp_path):
    topic = Topic(tmp_path / "in")
    topic.send(row("10:00:00", "a", 500000), row("10:00:01", "b", 500000.01), row("10:00:02", "c", 1000000),
               row("10:00:03", "d", 1000000.01), row("10:00:04", "e", None), "broken")
    alerts = monitor.large_amount_alerts(feed.decode_rows(feed.file_source(spark, str(topic.folder))))
    finish(monitor.start_append(alerts, str(tmp_path / "out"), str(tmp_path / "cp"), finite=True))
    got = spark.read.schema(alerts.schema).parquet(str(tmp_path / "out")).orderBy("account_no").collect()
    assert [(r.account_no, r.risk_level, r.alert_type) for r in got] == [
        ("b", "MEDIUM", "LARGE_AMOUNT"), ("c", "MEDIUM", "LARGE_AMOUNT"), ("d", "HIGH", "LARGE_AMOUNT")]
    assert alerts.columns == ["trans_id", "trans_time", "account_no", "trans_amt", "channel", "alert_type", "risk_level"]


def test_channel_success_counts_non_reversals(spark):
    rows = spark.createDataFrame(
        [("2026-06-14 10:04:59", "ATM", "REVERSAL"), ("2026-06-14 10:00:00", "ATM", "X"), ("2026-06-14 10:05:00", "ATM", None), ("bad", "ATM", "X")],
        "trans_time string, channel string, trans_type string")
    got = sorted((str(r.window_start)[11:], r.total_cnt, r.success_cnt) for r in monitor.channel_success(monitor.with_event_time(rows)).collect())
    assert got == [("10:00:00", 2, 1), ("10:05:00", 1, 0)]


def test_future_rows_go_aside(spark):
    rows = spark.createDataFrame([("now", "2026-06-14 10:00:30"), ("ahead", "2026-06-14 23:00:00"), ("bad", "x")], "id string, trans_time string")
    rows = rows.withColumn("timestamp", F.lit(datetime(2026, 6, 14, 10, 0, 0)))
    good, ahead = monitor.split_future(rows)
    assert {r.id for r in good.collect()} == {"now", "bad"} and [r.id for r in ahead.collect()] == ["ahead"]


def test_state_holds_accounts_as_rows_not_as_sets(spark, tmp_path):
    topic = Topic(tmp_path / "in")
    topic.send(row("10:00:00"))
    plan = monitor.channel_windows(timed(spark, topic))._jdf.queryExecution().toString()
    assert "collect_set" not in plan and "collect_list" not in plan


def test_fast_in_out_as_a_stream(spark, tmp_path):
    topic = Topic(tmp_path / "in")
    topic.send(row("10:01:00", "quick", 200000, dr_cr_flag="C"), row("10:01:00", "slow", 200000, dr_cr_flag="C"))
    topic.send(row("10:03:00", "quick", 190000, dr_cr_flag="D"))
    topic.send(row("11:00:00", "slow", 190000, dr_cr_flag="D"))
    topic.send(row("13:00:00", "none", 1, dr_cr_flag="D"))
    alerts = patterns.fast_in_out_stream(timed(spark, topic))
    finish(monitor.start_append(alerts, str(tmp_path / "out"), str(tmp_path / "cp"), finite=True))
    got = spark.read.schema(alerts.schema).parquet(str(tmp_path / "out")).collect()
    assert {r.account_no for r in got} == {"quick"}
    assert [(str(r.in_time)[11:], str(r.last_out)[11:]) for r in got] == [("10:01:00", "10:03:00")]


@pytest.fixture
def rocksdb(spark):
    for name, value in STREAM_CONF.items():
        spark.conf.set(name, value)
    yield
    for name in STREAM_CONF:
        spark.conf.unset(name)


def alerts_of(spark, topic, tmp_path, **options):
    found = detect.fast_in_out_alerts(timed(spark, topic), **options)
    finish(monitor.start_append(found, str(tmp_path / "alerts"), str(tmp_path / "state"), finite=True))
    rows = spark.read.schema(found.schema).parquet(str(tmp_path / "alerts")).collect()
    return sorted((r.account_no, str(r.in_time)[11:], int(r.in_amt), int(r.out_amt), str(r.last_out)[11:]) for r in rows)


def test_open_credits_meet_debits_of_later_batches(spark, tmp_path, rocksdb):
    topic = Topic(tmp_path / "in")
    topic.send(row("10:01:00", "quick", 200000, dr_cr_flag="C"), row("10:01:00", "slow", 200000, dr_cr_flag="C"), row("10:01:00", "small", 20, dr_cr_flag="C"))
    topic.send(row("10:03:00", "quick", 100000, dr_cr_flag="D"), row("10:02:55", "quick", 90000, dr_cr_flag="D"))
    topic.send(row("10:11:00", "quick", 5, dr_cr_flag="D"), row("11:00:00", "slow", 190000, dr_cr_flag="D"))
    topic.send(row("13:00:00", "none", 1, dr_cr_flag="D"), row("13:00:00", None, 200000, dr_cr_flag="C"))
    assert alerts_of(spark, topic, tmp_path) == [("quick", "10:01:00", 200000, 190005, "10:11:00")]


def test_a_debit_may_come_before_its_credit(spark, tmp_path, rocksdb):
    topic = Topic(tmp_path / "in")
    topic.send(row("10:00:08", "a", 150000, dr_cr_flag="D"))
    # the credit comes later than its debit, and twice in one second
    topic.send(row("10:00:05", "a", 160000, dr_cr_flag="C"), row("10:00:05", "a", 150000, dr_cr_flag="C"), row("10:00:08", "a", 150000, dr_cr_flag="C"))
    topic.send(row("12:00:00", "b", 1, dr_cr_flag="D"))
    assert alerts_of(spark, topic, tmp_path) == [("a", "10:00:05", 150000, 150000, "10:00:08"), ("a", "10:00:05", 160000, 150000, "10:00:08")]


def test_early_alerts_come_once(spark, tmp_path, rocksdb):
    topic = Topic(tmp_path / "in")
    topic.send(row("10:01:00", "a", 200000, dr_cr_flag="C"))
    topic.send(row("10:03:00", "a", 170000, dr_cr_flag="D"))
    topic.send(row("10:04:00", "a", 30000, dr_cr_flag="D"))
    assert alerts_of(spark, topic, tmp_path, early=True) == [("a", "10:01:00", 200000, 170000, "10:03:00")]


def test_a_half_written_batch_is_not_seen(spark, tmp_path, monkeypatch):
    topic, out, cp = Topic(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    topic.send(row("10:00:01", "a"))
    finish(monitor.start_account_windows(timed(spark, topic), out, cp, finite=True))
    topic.send(row("10:00:02", "b"))
    commit = SnapshotLog.commit

    def killed(self, edit):
        raise RuntimeError("killed before it published")

    monkeypatch.setattr(SnapshotLog, "commit", killed)
    with pytest.raises(Exception, match="killed"):
        monitor.start_account_windows(timed(spark, topic), out, cp, finite=True).awaitTermination()
    monkeypatch.setattr(SnapshotLog, "commit", commit)
    assert [r[2] for r in stats(monitor.read_channel_windows(spark, out))] == [1]
    finish(monitor.start_account_windows(timed(spark, topic), out, cp, finite=True))  # the batch is tried again
    assert [(r[2], r[4]) for r in stats(monitor.read_channel_windows(spark, out))] == [(2, 2)]
    assert monitor.vacuum_windows(spark, out, older_than=0) == 1


def test_sketches_roll_up_without_the_accounts(spark):
    rows = monitor.with_event_time(spark.range(60_000).select(
        F.concat(F.lit("2026-06-14 1"), (F.col("id") % 3).cast("string"), F.lit(":"), F.lpad((F.col("id") % 7 * 8).cast("string"), 2, "0"), F.lit(":00")).alias("trans_time"),
        F.when(F.col("id") % 3 == 0, "HOT").otherwise("ATM").alias("channel"), (F.col("id") % 9001).cast("string").alias("account_no"),
        F.lit(1).cast("decimal(18,2)").alias("trans_amt")))
    day = monitor.estimated(monitor.roll_up_sketches(monitor.roll_up_sketches(monitor.sketch_windows(rows), "1 hour"), "1 day"))
    exact = {r.channel: r.active_accounts for r in monitor.channel_windows(rows, "1 day").collect()}
    for r in day.collect():
        assert abs(r.active_accounts - exact[r.channel]) <= exact[r.channel] * 4 * 1.04 / 64 + 1
    assert {r.channel: r.txn_cnt for r in day.collect()} == {"HOT": 20_000, "ATM": 40_000}


def test_live_windows_read_from_a_day_on(spark, tmp_path):
    topic = Topic(tmp_path / "in")
    topic.send(row("23:59:59"), {**row("00:00:01"), "trans_time": "2026-06-15 00:00:01"})
    out = str(tmp_path / "out")
    finish(monitor.start_account_windows(timed(spark, topic), out, str(tmp_path / "cp"), finite=True))
    assert len(stats(monitor.read_channel_windows(spark, out))) == 2
    assert [r[0] for r in stats(monitor.read_channel_windows(spark, out, since="2026-06-15"))] == ["00:00:00"]


def test_a_path_whose_checkpoint_is_lost_is_refused(spark, tmp_path):
    topic, out = Topic(tmp_path / "in"), str(tmp_path / "out")
    topic.send(row("10:00:01"), row("10:00:02"))
    finish(monitor.start_account_windows(timed(spark, topic), out, str(tmp_path / "cp"), finite=True))
    topic.send(row("10:00:03"))
    with pytest.raises(ValueError):
        monitor.start_account_windows(timed(spark, topic), out, str(tmp_path / "other"), finite=True)
    finish(monitor.start_account_windows(timed(spark, topic), out, str(tmp_path / "cp"), finite=True))
    assert [r[2] for r in stats(monitor.read_channel_windows(spark, out))] == [3]


def test_closed_days_are_compacted(spark, tmp_path):
    topic, out, small = Topic(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "small")
    for time, day in (("23:00:00", 13), ("23:00:01", 13), ("10:00:00", 14)):
        topic.send({**row(time), "trans_time": f"2026-06-{day} {time}"})
        finish(monitor.start_account_windows(timed(spark, topic), out, str(tmp_path / "cp"), finite=True))
    before = stats(monitor.read_channel_windows(spark, out))
    assert monitor.compact_days(spark, out, small, "2026-06-14") == ["2026-06-13"]
    assert stats(monitor.read_channel_windows(spark, out, compacted=small)) == before
    assert len(stats(monitor.read_channel_windows(spark, out))) == len(before) - 1
    assert len(stats(monitor.read_channel_windows(spark, out, since="2026-06-14", compacted=small))) == len(before) - 1
    assert monitor.compact_days(spark, out, small, "2026-06-14") == []
