"""Counter deltas on a stream whose samples arrive out of order (SM-01), with ``transformWithStateInPandas``.

Samples wait in map state until event time has moved past them, then run through WN-01 in time order. What comes too
late for its place is not lost: it leaves as a row of its own, marked, for a second dataset.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from statsweep.streaming.state import (FIRST, NULL_FLAG, _interval_ms, _micros, _packed, _samples, _unpacked, bucketed, keyed_deltas,
                                       newer_than, no_samples, nullable)

BUCKETS = 128  # of keys; a frame holds a pane of one, so there are fewer than where a frame is all that arrived


class ReorderedDeltas(StatefulProcessor):
    """Buffer of the samples of one bucket of keys, and the last released sample of each.

    ``pane``: map state, (pane start, number) -> rows that wait in the pane, packed as they came; a pane is an eighth of
    the hold. ``last``: the keys' last released samples, packed. ``due``: the pending timer.
    """

    def __init__(self, counters: Sequence[str], time_col: str, tiebreak: str, reset_col: str | None, hold_ms: int,
                 watermark_ms: int, ttl_ms: int, doubles: frozenset[str], integers: Sequence[str], columns: Sequence[str], out_columns: Sequence[str]):
        self.counters, self.time_col, self.tiebreak, self.reset_col = list(counters), time_col, tiebreak, reset_col
        self.hold_ms, self.lead_ms, self.ttl_ms = hold_ms, watermark_ms - hold_ms, ttl_ms
        self.pane_us = max(hold_ms * 1000 // 8, 1_000_000)
        self.arriving = ["_key", "_et", *columns, *[NULL_FLAG + c for c in integers]]
        self.doubles, self.integers, self.columns, self.out_columns = doubles, list(integers), list(columns), list(out_columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pane = handle.getMapState("pane", "start long, number long", "rows binary")
        self.last = handle.getValueState("last", "rows binary")
        self.due = handle.getValueState("due", "ms long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, panes = self._last(), self._panes()
        for pdf in rows:
            # Spark renames columns with a leading underscore; the bucket comes last
            pdf = nullable(pdf.iloc[:, :len(self.arriving)].set_axis(self.arriving, axis=1), self.integers, ["_key", *self.columns])
            late = pdf[self.time_col].isna().to_numpy() | ~newer_than(self._rows(pdf), last)
            if late.any():
                yield self._late(pdf[late])
            pdf = pdf[~late]
            start = _micros(pdf[self.time_col]) // self.pane_us * self.pane_us
            at = np.argsort(start, kind="stable")
            for place in np.split(at, np.flatnonzero(np.diff(start[at])) + 1) if len(at) else []:
                s = int(start[place[0]])
                numbers = panes.setdefault(s, [])
                numbers.append(numbers[-1] + 1 if numbers else 0)
                self.pane.updateValue((s, numbers[-1]), (_packed(pdf.iloc[place]),))
        yield from self._release(timerValues.getCurrentWatermarkInMs(), panes, last)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.due.clear()
        yield from self._release(timerValues.getCurrentWatermarkInMs(), self._panes(), self._last())

    def close(self) -> None:
        pass

    def _last(self) -> pd.DataFrame:
        held = self.last.get()
        return no_samples(self.counters, self.doubles) if held is None else _unpacked(bytes(held[0]))

    def _panes(self) -> dict[int, list[int]]:
        """Pane starts with the numbers of what waits in them."""
        out: dict[int, list[int]] = {}
        for start, number in sorted((int(k[0]), int(k[1])) for k in self.pane.keys()):
            out.setdefault(start, []).append(number)
        return out

    def _ties(self, pdf: pd.DataFrame) -> np.ndarray:
        return pdf[self.tiebreak].fillna(FIRST).to_numpy(dtype=np.int64)

    def _rows(self, pdf: pd.DataFrame) -> pd.DataFrame:
        return _samples(pdf, self.time_col, self._ties(pdf), self.counters, self.reset_col, self.doubles)

    def _late(self, pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.reindex(columns=self.out_columns).astype({c: object for c in self.out_columns if c.endswith("_kind")}).assign(is_late=True)

    def _release(self, watermark_ms: int, panes: dict[int, list[int]], last: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """Rows at or before the watermark plus the lead, pane by pane in time order; then the next timer."""
        upto = (watermark_ms + self.lead_ms) * 1000 if watermark_ms > 0 else None
        waiting = None
        for s in sorted(panes):
            if upto is None or s > upto:
                waiting = s
                break
            pdf = pd.concat([_unpacked(bytes(self.pane.getValue((s, n))[0])) for n in panes[s]], ignore_index=True)
            ready = _micros(pdf[self.time_col]) <= upto
            if ready.any() or len(panes[s]) > 1:
                for n in panes[s]:
                    self.pane.removeKey((s, n))
                if not ready.all():
                    self.pane.updateValue((s, 0), (_packed(pdf[~ready]),))
            if ready.any():
                done = pdf[ready].reset_index(drop=True)
                rows = self._rows(done)
                out, last = keyed_deltas(done, rows, last, rows["tb"].to_numpy(), self.counters, self.ttl_ms * 1000, self.doubles)
                yield out.assign(is_late=False)[self.out_columns]
            if not ready.all():
                waiting = int(_micros(pdf[self.time_col])[~ready].min())
                break
        ends = last["t"].to_numpy() // 1000 + self.ttl_ms
        last, ends = last[ends >= watermark_ms], ends[ends >= watermark_ms]  # a row that could follow others would start the series again
        if len(last):
            self.last.update((_packed(last),))
        else:
            self.last.clear()
        if waiting is not None:
            self._wake(-(-waiting // 1000) - self.lead_ms, watermark_ms)
        elif len(last):
            self._wake(int(ends.min()) + 1, watermark_ms)

    def _wake(self, ms: int, watermark_ms: int) -> None:
        """One timer per bucket, at ``ms`` or as soon as event time moves."""
        ms = max(int(ms), watermark_ms + 1)
        held = self.due.get()
        if held is not None and held[0] == ms:
            return
        if held is not None:
            self.handle.deleteTimer(held[0])
        self.handle.registerTimer(ms)
        self.due.update((ms,))


def _doubles(fields: StructType, counters: Sequence[str]) -> frozenset[str]:
    return frozenset(c for c in counters if fields[c].dataType.simpleString() in ("double", "float"))


def delta_schema(fields: StructType, counters: Sequence[str]) -> StructType:
    """Columns of a sample with its deltas."""
    out = StructType(list(fields)).add("elapsed_seconds", "double")
    for c in counters:
        out = out.add(f"{c}_kind", "string").add(f"{c}_delta", "double" if c in _doubles(fields, counters) else "long").add(f"{c}_rate", "double")
    return out


def stream_counter_delta_reordered(stream: DataFrame, keys: Sequence[str], counters: Sequence[str] | str, hold: str = "10 minutes",
                                   time_col: str = "source_collected_at", reset_col: str | None = "stats_reset",
                                   tiebreak: str = "event_id", idle_ttl: str = "1 day", watermark: str = "1 day",
                                   buckets: int = BUCKETS) -> DataFrame:
    """SM-01 over samples that arrive up to ``hold`` late: WN-01 in the order of ``(time, tiebreak)``.

    A sample waits until the latest event time seen, of any key, is ``hold`` past its own. Samples that come later than that
    still take their place while no newer one of their key has been released; otherwise they, and samples without a
    time, come out at once with ``is_late`` true and without deltas. Samples more than ``watermark`` (at least ``hold``)
    behind are dropped by Spark and counted in the query's progress (``numRowsDroppedByWatermark``). Samples repeated
    inside the hold are rows of their own, as in the batch form; repeated after their release they are late. A null
    ``tiebreak`` comes first. A gap longer than ``idle_ttl`` starts the series again.

    Keys are dealt over ``buckets`` by hash; raise it with the number of keys, before the checkpoint's first run only.
    State of a bucket: what arrived in the last ``hold``, in panes of an eighth of it, and one sample of each key. A frame
    holds one pane or one Arrow batch, whatever the backlog; ``maxFilesPerTrigger`` bounds the batch. Needs the RocksDB state
    store (``StreamJob.run(rocksdb=True)``). Output: the input columns, ``elapsed_seconds``, ``c_kind``, ``c_delta`` and
    ``c_rate`` per counter, ``is_late``. ``late_and_deltas`` splits it into two datasets.
    """
    keys = list(keys)
    counters = [counters] if isinstance(counters, str) else list(counters)
    hold_ms, watermark_ms = _interval_ms(hold), _interval_ms(watermark)
    if watermark_ms < hold_ms:
        raise ValueError("the watermark has to be at least as long as the hold")
    fields = stream.schema
    doubles = _doubles(fields, counters)
    out = delta_schema(fields, counters).add("is_late", "boolean")
    plain, integers = bucketed(stream, keys, time_col, watermark, buckets)
    processor = ReorderedDeltas(counters, time_col, tiebreak, reset_col, hold_ms, watermark_ms, _interval_ms(idle_ttl), doubles,
                                integers, fields.names, out.names)
    return plain.groupBy("_bucket").transformWithStateInPandas(processor, out, "Append", "EventTime")


def late_and_deltas() -> dict:
    """Targets of ``write_multi``: samples with their deltas, and samples too late for one."""
    return {"deltas": lambda d: d.where(~F.col("is_late")).drop("is_late"), "late": lambda d: d.where("is_late").drop("is_late")}
