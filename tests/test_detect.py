"""The state of fast in-and-out, driven without a stream: how often it is touched, and what it finds."""

import random

import pandas as pd
import pytest

from ledgerlake.streaming.detect import _InOut

LENGTH = 10_000_000


class Handle:
    """State and timers of one account; counts what is written or read."""

    def __init__(self):
        self.calls, self.timers, self.maps = 0, set(), []

    def getMapState(self, name, *schemas):
        self.maps.append(Map(self))
        return self.maps[-1]

    def getValueState(self, name, schema):
        return Value(self)

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.discard(at)


class Map:
    def __init__(self, handle):
        self.handle, self.rows = handle, {}

    def __getattribute__(self, name):
        if name not in ("handle", "rows"):
            self.handle.calls += 1
        return object.__getattribute__(self, name)

    def containsKey(self, key):
        return key in self.rows

    def getValue(self, key):
        return self.rows.get(key)

    def updateValue(self, key, value):
        self.rows[key] = value

    def removeKey(self, key):
        del self.rows[key]

    def keys(self):
        return iter(list(self.rows))

    def iterator(self):
        return iter(list(self.rows.items()))


class Value:
    def __init__(self, handle):
        self.handle, self.row = handle, None

    def get(self):
        self.handle.calls += 1
        return self.row

    def update(self, row):
        self.handle.calls += 1
        self.row = row

    def clear(self):
        self.handle.calls += 1
        self.row = None


class Times:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    getExpiryTimeInMs = getCurrentWatermarkInMs


def frame(rows):
    return pd.DataFrame(rows, columns=["at", "cents", "debit"])


def driven(batches, early=False):
    """The alerts of one account; a batch is its rows in frames, and the watermark after it."""
    handle, found = Handle(), []
    processor = _InOut(LENGTH, 0.5, early)
    processor.init(handle)
    for frames, mark in batches:
        if frames:
            found += [*processor.handleInputRows(("a",), iter([frame(f) for f in frames]), Times(0))]
        for at in sorted(t for t in handle.timers if t <= mark):
            if at in handle.timers:
                found += [*processor.handleExpiredTimer(("a",), Times(mark), Times(at))]
                handle.timers.discard(at)
    return sorted(tuple(map(int, r[1:])) for f in found for r in f.itertuples(index=False)), handle


def expected(rows):
    out = []
    for at, cents, debit in rows:
        after = [(t, c) for t, c, d in rows if d and at < t <= at + LENGTH]
        total = sum(c for _, c in after)
        if not debit and total and total >= cents * 0.5:
            out.append((at, cents, total, max(t for t, _ in after)))
    return sorted(out)


def some_rows(seed, n, start, stop):
    pick = random.Random(seed)
    return [(pick.randrange(start, stop, 500_000), pick.randrange(1, 90), pick.random() < 0.5) for _ in range(n)]


def test_state_is_touched_by_batches_not_rows():
    rows = some_rows(1, 3000, 0, 2_000_000_000)
    found, handle = driven([([rows[:2000], rows[2000:]], 0), ([], 10**9)])
    assert found == expected(rows)
    assert handle.calls < 30
    assert not any(m.rows for m in handle.maps) and not handle.timers


@pytest.mark.parametrize("seed", range(5))
def test_batches_find_what_one_table_holds(seed):
    """Rows come at most a step behind the watermark's moment; each batch moves it."""
    step, batches, every = 5_000_000, [], []
    for k in range(30):
        rows = some_rows(seed * 100 + k, 12, k * step + 500_000, (k + 2) * step) if k % 7 else []
        every += rows
        batches.append(([rows] if rows else [], k * step // 1000))
    found, handle = driven([*batches, ([], 10**9)])
    assert found == expected(every)
    assert not any(m.rows for m in handle.maps) and not handle.timers


def test_state_is_bounded_by_the_width():
    step = 5_000_000
    debits = [([[(k * step + 1_000_000, 5, True)]], k * step // 1000) for k in range(200)]
    _, handle = driven(debits)
    assert sum(len(m.rows) for m in handle.maps) <= 6


def test_early_alerts_are_told_once():
    rows = [(0, 100, False), (1_000_000, 40, True), (2_000_000, 20, True), (3_000_000, 50, True)]
    found, handle = driven([([[r]], 0) for r in rows] + [([], 10**9)], early=True)
    assert found == [(0, 100, 60, 2_000_000)]
    assert not any(m.rows for m in handle.maps) and not handle.timers


def test_large_sums_are_exact():
    big = 4 * 10**18
    rows = [(0, 10, False), (1, big, True), (2, big, True), (3_000_000, 10, False), (3_000_001, 7, True), (13_000_002, big, True)]
    found, _ = driven([([rows], 0), ([], 10**9)])
    assert found == expected(rows)
