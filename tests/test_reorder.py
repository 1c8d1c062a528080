"""Streamed deltas of samples out of order: equal to the batch form, late samples in a second dataset."""

import datetime as dt
import random

from pyspark.sql import functions as F

from statsweep.operators.deltas import counter_delta
from statsweep.streaming.reorder import delta_schema, late_and_deltas, stream_counter_delta_reordered
from statsweep.streaming.runner import STATE_STORE, StreamJob
from statsweep.streaming.windows import read_committed, write_multi

T0 = dt.datetime(2024, 1, 1)
SCHEMA = ("server_id string, k long, source_collected_at timestamp_ntz, stats_reset timestamp_ntz, c long, d double, event_id long, "
          "note string")
COUNTERS = ["c", "d"]


def _run(spark, name, slices, **options):
    """Each slice landed and read in its own run; deltas and late samples."""
    job = StreamJob(spark, name)
    writer = write_multi(late_and_deltas(), job.sink)
    schema = spark.createDataFrame([], SCHEMA).schema
    for rows in slices:
        job.land(spark.createDataFrame(rows, SCHEMA).repartition(4))
        job.run(stream_counter_delta_reordered(job.source(schema, max_files=4), ["server_id", "k"], COUNTERS, **options),
                foreach_batch=writer, rocksdb=True)
    return (read_committed(spark, job.sink, "deltas", delta_schema(schema, COUNTERS)).drop("batch_id"),
            read_committed(spark, job.sink, "late", delta_schema(schema, COUNTERS)).drop("batch_id"))


def _closing(minutes):
    return [(None, None, T0 + dt.timedelta(minutes=minutes), None, None, None, None, None)]


def _values(df):
    cols = ["server_id", "k", "event_id", "elapsed_seconds", *[f"{c}_{x}" for c in COUNTERS for x in ("kind", "delta", "rate")]]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: (r[0] or "", r[1] or 0, r[2]))


def test_samples_out_of_order_equal_the_batch_form(spark):
    rnd, rows, eid = random.Random(5), [], 0
    for key in (("a", 1), ("a", 2), ("b", 1), (None, 3), ("b", None)):
        c = 2**60 if key[0] == "a" else 0
        for m in range(0, 240, 2):
            eid += 1
            c = c + rnd.randrange(50) if rnd.random() > 0.05 else rnd.randrange(5)
            t = T0 + dt.timedelta(minutes=m - m % 4, microseconds=rnd.randrange(3))  # ties in time
            rows.append((*key, t, T0 if m < 150 else T0 + dt.timedelta(hours=2), c, None if rnd.random() < 0.05 else c / 3, eid, "é" if m % 3 else None))
    rows = [r if rnd.random() > 0.05 else (*r[:4], None, *r[5:]) for r in rows]
    slices = [[], [], []]
    for r in rows:  # a third comes up to one hour late
        at = int((r[2] - T0).total_seconds() // 3600)
        slices[min(2, at + (rnd.random() < 0.33))].append(r)
    for part in slices:
        rnd.shuffle(part)
    slices[-1] += _closing(10_000)
    deltas, late = _run(spark, "reorder", slices, hold="2 hours", watermark="10 hours", idle_ttl="1 day")
    want = counter_delta(spark.createDataFrame(rows, SCHEMA), ["server_id", "k"], COUNTERS, "source_collected_at", "stats_reset", ["event_id"])
    assert late.count() == 0
    assert _values(deltas) == _values(want)
    assert not spark.conf.get(STATE_STORE, "").endswith("RocksDBStateStoreProvider")  # the session keeps its store


def test_samples_too_late_are_rows_of_their_own(spark):
    m = dt.timedelta(minutes=1)
    at = lambda minute, eid, c, k=1: ("s", k, None if minute is None else T0 + minute * m, T0, c, float(c), eid, None)
    deltas, late = _run(spark, "too-late", [
        [at(0, 1, 10), at(10, 2, 20), at(100, 3, 50)],             # 0 and 10 are released, 100 waits
        [at(5, 4, 15), at(95, 5, 45), at(None, 6, 1), at(4, 7, 3, k=2), at(10, 2, 20)],  # 5, a repeat and no time: late; key 2 has no newer sample
        _closing(5_000),
        [at(9_000, 8, 60)], _closing(90_000)], hold="30 minutes", watermark="2 hours", idle_ttl="1 day")
    got = sorted((r.k, r.event_id, r.c_kind, r.c_delta) for r in deltas.where("k IS NOT NULL").collect())
    assert got == [(1, 1, "first", None), (1, 2, "delta", 10), (1, 3, "delta", 5), (1, 5, "delta", 25), (1, 8, "first", None), (2, 7, "first", None)]
    rows = late.collect()
    assert sorted(r.event_id for r in rows) == [2, 4, 6] and all(r.c_kind is None for r in rows)


def test_frames_are_panes(spark, monkeypatch):
    """A backlog of one key is released pane by pane."""
    import pandas as pd

    from statsweep.streaming import reorder

    class Map:
        def __init__(self): self.d = {}
        def containsKey(self, k): return k in self.d
        def getValue(self, k): return self.d.get(k)
        def updateValue(self, k, v): self.d[k] = v
        def removeKey(self, k): self.d.pop(k)
        def keys(self): return iter(list(self.d))

    class Value:
        v = None
        def get(self): return self.v
        def update(self, v): self.v = v
        def clear(self): self.v = None

    class Handle:
        def getMapState(self, *a): return Map()
        def getValueState(self, *a): return Value()
        def registerTimer(self, ms): pass
        def deleteTimer(self, ms): pass

    class Clock:
        def getCurrentWatermarkInMs(self): return int(pd.Timestamp("2024-02-01").value // 1_000_000)

    cols = ["t", "tb", "c"]
    p = reorder.ReorderedDeltas(["c"], "t", "tb", None, 3_600_000, 3_600_000, 10**10, frozenset(), [], cols,
                                [*cols, "elapsed_seconds", "c_kind", "c_delta", "c_rate", "is_late"])
    p.init(Handle())
    n = 20_000
    pdf = pd.DataFrame({"_key": "k", "_et": None, "t": pd.Timestamp(T0) + pd.to_timedelta(range(n), unit="s"), "tb": range(n), "c": range(n)}).sample(frac=1, random_state=1)
    frames = list(p.handleInputRows(("k",), iter([pdf[:9000], pdf[9000:]]), Clock()))
    assert max(len(f) for f in frames) <= 450 and sum(len(f) for f in frames) == n  # an eighth of an hour
    assert (pd.concat(frames)["c_delta"].dropna() == 1).all()
