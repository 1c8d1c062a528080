"""Rules and streams at the findings of the third review."""

import datetime as dt

from statsweep.plans.rules import PACKS, evaluate

T0 = dt.datetime(2024, 1, 1)


def test_cache_hit_is_critical_below_95(spark):
    """RL-04: a hit ratio held for 15 minutes is judged at 99, 97 and 95 %."""
    pack = next(p for p in PACKS if p.pack_id == "RL-04")
    rule = next(r for r in pack.rules if r.rule_id == "cache_hit")
    rows = [("s", db, T0 + dt.timedelta(minutes=5 * i), i, hit) for db, hit in ((1, 98.0), (2, 96.0), (3, 94.0)) for i in range(5)]
    df = spark.createDataFrame(rows, "server_id string, datid long, source_collected_at timestamp_ntz, event_id long, cache_hit_percent double")
    got = {(r.datid, r.severity, r.threshold) for r in evaluate(df, [rule], list(pack.keys), pack.time_col, list(pack.tiebreak)).collect()}
    assert got == {(1, "warning", 99.0), (2, "high", 97.0), (3, "critical", 95.0)}


SCHEMA = "server_id string, k long, source_collected_at timestamp_ntz, stats_reset timestamp_ntz, c long, d double, event_id long"
VALUES = ["server_id", "k", "event_id", "elapsed_seconds", *[f"{c}_{x}" for c in ("c", "d") for x in ("kind", "delta", "rate")]]


def _sorted(df):
    return sorted((tuple(r) for r in df.select(*VALUES).collect()), key=lambda r: (r[0] or "", r[1] or 0, r[2]))


def _many_keys():
    """Three series of big integers, null keys, null counters and resets beside many short ones."""
    import random

    rnd, rows = random.Random(3), []
    for key in [("a", 2**60), ("a", 2**60 + 1), (None, 3), ("b", None), *(("s", i) for i in range(60))]:
        c = 2**60 + 1 if key[0] == "a" else 0
        for m in range(0, 240, 8 if key[0] != "s" else 60):
            c = c + rnd.randrange(50) if rnd.random() > 0.1 else rnd.randrange(5)
            rows.append((*key, T0 + dt.timedelta(minutes=m - m % 16), T0 if m < 150 else T0 + dt.timedelta(hours=2),
                         None if rnd.random() < 0.05 else c, None if rnd.random() < 0.05 else c / 3, len(rows)))
    return rows


def _state_rows(spark, job, **options):
    return spark.read.format("statestore").options(**options).load(job.checkpoint).count()


def test_stream_state_is_by_bucket_of_keys(spark):
    """64 keys in two groups: the deltas of the batch form, and state that is pruned key by key."""
    from statsweep.operators.deltas import counter_delta
    from statsweep.streaming.runner import StreamJob
    from statsweep.streaming.state import stream_counter_delta

    rows = _many_keys()
    df, job = spark.createDataFrame(rows, SCHEMA), StreamJob(spark, "buckets")
    cut = T0 + dt.timedelta(minutes=100)
    for part in ([r for r in rows if r[2] < cut], [r for r in rows if r[2] >= cut]):
        job.land(spark.createDataFrame(part, SCHEMA).repartition(3))
        job.run(stream_counter_delta(job.source(df.schema), ["server_id", "k"], ["c", "d"], idle_ttl="1 day", buckets=2))
    want = counter_delta(df, ["server_id", "k"], ["c", "d"], "source_collected_at", "stats_reset", ["event_id"])
    assert _sorted(job.result()) == _sorted(want)
    assert _state_rows(spark, job) <= 2
    for day in (4, 9):  # event time passes all keys' last samples plus a day
        job.land(spark.createDataFrame([("z", 1, T0 + dt.timedelta(days=day), T0, 1, 1.0, 10_000 + day)], SCHEMA))
        job.run(stream_counter_delta(job.source(df.schema), ["server_id", "k"], ["c", "d"], idle_ttl="1 day", buckets=2))
    assert _state_rows(spark, job) == 1


def test_reorder_buffer_is_by_bucket_of_keys(spark):
    """64 keys in two groups, a third of the samples late: the deltas of the batch form."""
    import random

    from statsweep.operators.deltas import counter_delta
    from statsweep.streaming.reorder import delta_schema, late_and_deltas, stream_counter_delta_reordered
    from statsweep.streaming.runner import StreamJob
    from statsweep.streaming.windows import read_committed, write_multi

    rows, rnd = _many_keys(), random.Random(4)
    df, job = spark.createDataFrame(rows, SCHEMA), StreamJob(spark, "reorder-buckets")
    slices = [[], [], []]
    for r in rows:
        slices[min(2, (r[2] - T0).seconds // 5400 + (rnd.random() < 0.33))].append(r)
    slices[2].append((None, None, T0 + dt.timedelta(days=7), None, None, None, None))
    writer = write_multi(late_and_deltas(), job.sink)
    for part in slices:
        rnd.shuffle(part)
        job.land(spark.createDataFrame(part, SCHEMA).repartition(3))
        job.run(stream_counter_delta_reordered(job.source(df.schema), ["server_id", "k"], ["c", "d"], hold="4 hours", watermark="10 hours",
                                               idle_ttl="1 day", buckets=2), foreach_batch=writer, rocksdb=True)
    got = read_committed(spark, job.sink, "deltas", delta_schema(df.schema, ["c", "d"]))
    want = counter_delta(df, ["server_id", "k"], ["c", "d"], "source_collected_at", "stats_reset", ["event_id"])
    assert _sorted(got) == _sorted(want)
    assert _state_rows(spark, job, stateVarName="last") <= 2


def test_a_dropped_cache_is_freed_at_once():
    """A worker's cache of another operator goes when the next operator asks for its own, cycles included."""
    import gc
    import weakref

    from statsweep.llm.common import Parts, worker_cache

    class Holder:
        def __init__(self):
            self.parts = Parts(self.fill)  # as the sentencepiece codec: the cache holds its owner

        def fill(self, part):
            return b"x" * len(part)

    gc.disable()
    try:
        held = worker_cache("r3-first")
        held["codec"] = Holder()
        assert held["codec"].parts["ab"] == b"xx"
        gone = weakref.ref(held["codec"])
        del held
        assert worker_cache("r3-second") == {}
        assert gone() is None
    finally:
        gc.enable()
