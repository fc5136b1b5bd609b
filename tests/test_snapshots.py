"""The log of manifests: readers during a rewrite, killed writers, writers at once, vacuum."""

import json
import threading

import pytest

from ledgerlake.operators.vault import HUBS, build_hub
from ledgerlake.sources.lake import Lake
from ledgerlake.sources.snapshots import WHOLE, SnapshotLog

D1, D2 = "2026-06-13", "2026-06-14"


def hub(spark, dt, *ids):
    return build_hub(spark.createDataFrame([(i,) for i in ids], "customer_id string"), HUBS["hub_customer"], dt)


def ids(df):
    return sorted((r.dt, r.customer_id) for r in df.collect())


def test_entries_are_set_replaced_and_removed(spark, tmp_path):
    log = SnapshotLog(spark, str(tmp_path))
    assert log.versions() == [] and log.state() == {}
    assert log.commit(lambda now: {"a": "x", "b": "y"}) == 1
    assert log.commit(lambda now: {"a": "z", "b": None, "c": None}) == 2
    assert log.commit(lambda now: {"a": "z"}) == 2  # nothing new
    assert log.state() == {"a": "z"} and log.state(1) == {"a": "x", "b": "y"}
    with pytest.raises(FileNotFoundError):
        log.state(7)


def test_a_long_log_is_read_from_its_last_whole_manifest(spark, tmp_path):
    log = SnapshotLog(spark, str(tmp_path))
    for k in range(2 * WHOLE + 3):
        log.commit(lambda now, k=k: {f"e{k % 7}": f"f{k}", "gone": None if k % 2 else "g"})
    known = {f"e{k % 7}": f"f{k}" for k in range(2 * WHOLE + 3)} | {"gone": "g"}
    assert log.state() == known
    whole = json.loads((tmp_path / "_log" / f"{2 * WHOLE:012d}.json").read_text())
    assert len(whole) >= 7
    (tmp_path / "_log" / f"{WHOLE + 1:012d}.json").write_text("not read any more")
    assert log.state() == known


def test_writers_at_once_lose_nothing(spark, tmp_path):
    def write(k):
        log = SnapshotLog(spark, str(tmp_path))
        for n in range(5):
            log.commit(lambda now, n=n: {f"{k}-{n}": "x"})

    threads = [threading.Thread(target=write, args=(k,)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    log = SnapshotLog(spark, str(tmp_path))
    assert len(log.state()) == 20 and log.versions() == list(range(1, 21))


def test_a_commit_starts_again_from_newer_entries(spark, tmp_path):
    log, tries = SnapshotLog(spark, str(tmp_path)), []

    def edit(now):
        tries.append(dict(now))
        if len(tries) == 1:
            SnapshotLog(spark, str(tmp_path)).commit(lambda other: {"first": "x"})
        return {"second": "after-" + ",".join(sorted(now))}

    assert log.commit(edit) == 2
    assert tries == [{}, {"first": "x"}] and log.state() == {"first": "x", "second": "after-first"}


def test_a_reader_keeps_its_day_while_it_is_rewritten(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.write_day("hub_customer", hub(spark, D1, "a", "b"), D1)
    reader = lake.read_day("hub_customer", D1)
    lake.write_day("hub_customer", hub(spark, D1, "c"), D1)
    assert ids(reader) == [(D1, "a"), (D1, "b")]
    assert ids(lake.read_day("hub_customer", D1)) == [(D1, "c")]
    assert ids(lake.read("hub_customer", version=1)) == [(D1, "a"), (D1, "b")]


def test_a_killed_writer_leaves_no_trace(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path))
    lake.write_day("hub_customer", hub(spark, D1, "a"), D1)

    def killed(self, edit):
        raise KeyboardInterrupt

    monkeypatch.setattr(SnapshotLog, "commit", killed)
    with pytest.raises(KeyboardInterrupt):
        lake.write_day("hub_customer", hub(spark, D1, "b"), D1)
    with pytest.raises(KeyboardInterrupt):
        lake.write_day("hub_customer", hub(spark, D2, "b"), D2)
    monkeypatch.undo()
    assert ids(lake.read("hub_customer")) == [(D1, "a")] and lake.days("hub_customer") == [D1]
    assert lake.vacuum("hub_customer") == 0  # too fresh: a writer may still be at work
    assert lake.vacuum("hub_customer", older_than=0) == 2
    assert ids(lake.read("hub_customer")) == [(D1, "a")]


def test_vacuum_keeps_what_kept_manifests_name(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    for k in range(3):
        lake.write_day("hub_customer", hub(spark, D1, f"a{k}"), D1)
    lake.write_day("hub_customer", hub(spark, D2, "b"), D2)
    lake.drop_day("hub_customer", D2)
    assert lake.vacuum("hub_customer", keep=2, older_than=0) == 2
    assert ids(lake.read("hub_customer", version=4)) == [(D1, "a2"), (D2, "b")]
    assert lake.vacuum("hub_customer", keep=1, older_than=0) == 1
    assert ids(lake.read("hub_customer")) == [(D1, "a2")]
