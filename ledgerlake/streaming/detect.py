"""Fast in-and-out as a stateful stream: each account's open credits and the debits near them, no pairs of rows.

State of an account is its large credits still open and its debits, in parts as they came: a batch adds one part per frame of
rows, whatever is there already. One event-time timer per account stands at the end of its first open credit; when the
watermark has passed it, the parts are read, credits that ended are judged by running sums, and only parts that lose rows are
written again. Debits stay while an open credit, or one that may still come, lies before them, so state is bounded by the
width and the watermark's delay.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ledgerlake.operators.patterns import micros

_ALERT = "account_no string, in_at long, in_cents long, out_cents long, last_out long"


class _InOut(StatefulProcessor):
    """Times are microseconds, amounts hundredths, so that they are exact."""

    def __init__(self, length: int, ratio: float, early: bool):
        self.length, self.ratio, self.early = length, ratio, early

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.parts = handle.getMapState("parts", "number long", "at array<long>, cents array<long>, debit array<boolean>")
        # the number of the next part, and the timer that stands
        self.head = handle.getValueState("head", "next long, timer long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        known = self.head.get()
        number, timer = known if known else (0, None)
        due = []
        for news in rows:
            part = tuple(news[name].to_numpy() for name in ("at", "cents", "debit"))
            self._write(number, part)
            number += 1
            due.append(self._due(part[0], part[2]))
        if self.early:
            yield from self._settle(key, None)
        self.head.update((number, self._timer(timer, min(due))))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        known = self.head.get()
        if not known or known[1] != expiredTimerInfo.getExpiryTimeInMs():
            return
        now = timerValues.getCurrentWatermarkInMs() * 1000
        left = []
        yield from self._settle(key, now, left)
        if left:
            self.head.update((known[0], self._timer(None, min(left))))
        else:
            self.head.clear()

    def _write(self, number: int, part: tuple) -> None:
        self.parts.updateValue((number,), tuple(column.tolist() for column in part))

    def _due(self, at: np.ndarray, debit: np.ndarray) -> int:
        """When rows can first go: the end of the first credit; debits alone go together."""
        return int(at.max() if debit.all() else at[~debit].min() + self.length)

    def _timer(self, stands: int | None, at: int) -> int:
        """The timer of an account, no later than ``at`` is over."""
        asked = at // 1000 + 1
        if stands is not None and stands <= asked:
            return stands
        if stands is not None:
            self.handle.deleteTimer(stands)
        self.handle.registerTimer(asked)
        return asked

    def _settle(self, key: Any, now: int | None, left: list | None = None) -> Iterator[pd.DataFrame]:
        """Judges credits, those that ended before ``now`` or with ``early`` all, and drops rows that are done.

        ``left`` takes when rows of what stays can first go.
        """
        numbers = [number for (number,) in self.parts.keys()]
        kinds = (np.int64, np.int64, bool)
        parts = [tuple(np.array(c, k) for c, k in zip(self.parts.getValue((n,)), kinds)) for n in numbers]
        at, cents, debit = (np.concatenate(columns) for columns in zip(*parts))
        outs, credits = np.flatnonzero(debit), np.flatnonzero(~debit)
        outs = outs[np.argsort(at[outs], kind="stable")]
        moments, amounts = at[outs], cents[outs]
        if len(amounts) and float(np.abs(amounts.astype(float)).max()) * len(amounts) >= 2.0**62:
            amounts = amounts.astype(object)  # sums beyond a long stay exact
        upto = np.concatenate([np.zeros(1, amounts.dtype), np.cumsum(amounts)])

        ended = np.zeros(len(credits), bool) if now is None else at[credits] + self.length < now
        asked = credits if now is None else credits[ended & (not self.early)]
        first, end = np.searchsorted(moments, at[asked], "right"), np.searchsorted(moments, at[asked] + self.length, "right")
        gone = (upto[end] - upto[first]).tolist()
        alerts = [
            (i, (key[0], int(at[i]), int(cents[i]), out, int(moments[e - 1])))
            for i, out, e in zip(asked.tolist(), gone, end.tolist()) if out and out >= int(cents[i]) * self.ratio
        ]
        keep = np.ones(len(at), bool)
        keep[credits[ended]] = False
        if self.early:
            keep[[i for i, _ in alerts]] = False  # told once
        if now is not None:
            # debits from after an open credit, or one that is not late yet
            open_at = at[credits[keep[credits]]]
            keep &= ~debit | (at >= now) | (at > (open_at.min() if len(open_at) else now))
        start = 0
        for number, part in zip(numbers, parts):
            kept = keep[start:start + len(part[0])]
            start += len(kept)
            if not kept.any():
                self.parts.removeKey((number,))
            elif not kept.all():
                self._write(number, tuple(column[kept] for column in part))
        if left is not None and keep.any():
            left.append(self._due(at[keep], debit[keep]))
        if alerts:
            yield pd.DataFrame([alert for _, alert in alerts], columns=_NAMES)

    def close(self) -> None:
        pass


_NAMES = [part.split()[0] for part in _ALERT.split(", ")]


def fast_in_out_alerts(
    rows: DataFrame, width: str = "10 minutes", min_in: Decimal = Decimal("100000"), ratio: float = 0.8, early: bool = False
) -> DataFrame:
    """The alerts of ``patterns.fast_in_out`` from a stream of rows with event time ``txn_ts``.

    A credit's alert comes once the watermark has passed its end, with all that left. With
    ``early`` it comes as soon as the ratio is reached, with what has left by then, and once. Rows behind the watermark
    take no part, nor rows without an account. The session's state store must be RocksDB (``session.STREAM_CONF``).
    """
    debit = F.col("dr_cr_flag") == "D"
    large = (F.col("dr_cr_flag") == "C") & (F.col("trans_amt") >= F.lit(min_in))
    asked = rows.where(F.col("account_no").isNotNull() & F.col("trans_amt").isNotNull() & (debit | large)).select(
        "account_no", "txn_ts", F.unix_micros("txn_ts").alias("at"), (F.col("trans_amt") * 100).cast("long").alias("cents"), debit.alias("debit")
    )
    found = asked.groupBy("account_no").transformWithStateInPandas(
        statefulProcessor=_InOut(micros(width), ratio, early), outputStructType=_ALERT, outputMode="append", timeMode="EventTime"
    )
    amount = lambda c: (F.col(c).cast("decimal(28,2)") / 100).cast("decimal(28,2)")
    return found.select(
        "account_no", F.timestamp_micros("in_at").alias("in_time"), amount("in_cents").cast("decimal(18,2)").alias("in_amt"),
        amount("out_cents").alias("out_amt"), F.timestamp_micros("last_out").alias("last_out"), F.lit("FAST_IN_OUT").alias("alert_type"),
    )
