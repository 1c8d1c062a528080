"""Stored high-water marks, and all-or-nothing writes of a batch to several datasets."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from statsweep.operators.ledger import collector_health, overlapping_runs
from statsweep.sources.marks import MarkStore, StaleRead
from statsweep.streaming import windows as SW

T0 = dt.datetime(2024, 1, 1, 12)
M = dt.timedelta(minutes=1)


def test_three_reads_equal_one(spark, tmp_path):
    rows = [(f"s{i % 3}" if i % 7 else None, i, T0 + (i - 40) * M) for i in range(200)] + [("late", 900, T0 + 80 * M), ("s0", 901, None)]
    source = spark.createDataFrame(rows, "server_id string, n long, end_time timestamp_ntz")
    store = MarkStore(spark, str(tmp_path / "store"), source)
    assert store.rows().count() == 0 and store.last_read() == 0
    times = ["2024-01-01 12:00:00", "2024-01-01 12:30:00", "2024-01-01 14:00:00"]
    first = {r.n for r in store.read(1, source, times[0]).collect()}
    assert first == {n for _, n, t in rows if t and T0 - 17 * M < t <= T0 - 2 * M}
    store.read(2, source, times[1])
    # a retry returns what was read, whatever its time and whatever has arrived since
    more = source.unionByName(spark.createDataFrame([("s1", 950, T0 + 27 * M)], source.schema))
    assert {r.n for r in store.read(2, more, times[2]).collect()} == {n for _, n, t in rows if t and T0 - 2 * M < t <= T0 + 28 * M}
    with pytest.raises(StaleRead):
        store.read(1, source, times[0])
    with pytest.raises(StaleRead):
        store.read(5, source, times[2])
    store.read(3, source, times[2])
    got = sorted(r.n for r in store.rows().collect())
    assert got == sorted(n for _, n, t in rows if t and T0 - 17 * M < t <= T0 + 118 * M)  # a key first seen later misses nothing


def test_a_read_that_broke_off_is_run_again(spark, tmp_path):
    rows = [("s", i, T0 - i * M) for i in range(30)]
    source = spark.createDataFrame(rows, "server_id string, n long, end_time timestamp_ntz")
    store = MarkStore(spark, str(tmp_path / "store"), source)
    source.limit(3).write.parquet(str(tmp_path / "store" / "rows" / "read_id=1"))  # rows without marks don't count
    (tmp_path / "store" / "marks" / "read_id=1").mkdir(parents=True)
    assert store.last_read() == 0 and store.rows().count() == 0
    store.read(1, source, "2024-01-01 12:00:00")
    assert sorted(r.n for r in store.rows().collect()) == list(range(2, 17))


def test_failure_between_two_datasets(spark, tmp_path):
    schema = "id long, v string, t timestamp_ntz"
    at = T0 + dt.timedelta(microseconds=123456)
    df = spark.createDataFrame([(1, "a", at), (2, None, None), (2, None, None)], schema)
    root, kept = str(tmp_path / "out"), str(tmp_path / "kept")
    targets = {"rows": lambda d: d, "ids": lambda d: d.select("id")}

    def down(_):
        raise RuntimeError("dataset down")

    SW.write_multi(targets, root, kept)(df, 0)
    SW.write_multi({**targets, "ids": down}, root, kept)(df.withColumn("v", F.lit("second")), 1)
    rows = lambda: sorted((r.batch_id, r.id, r.v, r.t) for r in SW.read_committed(spark, root, "rows", schema).fillna("-", ["v"]).collect() if r.t)
    ids = lambda: sorted((r.batch_id, r.id) for r in SW.read_committed(spark, root, "ids", "id long").collect())
    assert rows() == [(0, 1, "a", at)] and ids() == [(0, 1), (0, 2), (0, 2)]  # neither dataset has batch 1
    with pytest.raises(RuntimeError):
        SW.replay_fallback(spark, {**targets, "ids": down}, root, kept, schema)
    assert ids() == [(0, 1), (0, 2), (0, 2)]
    assert SW.replay_fallback(spark, targets, root, kept, schema) == [1]
    assert rows() == [(0, 1, "a", at), (1, 1, "second", at)] and len(ids()) == 6
    assert SW.replay_fallback(spark, targets, root, kept, schema) == [] and len(ids()) == 6
    assert SW.read_committed(spark, str(tmp_path / "none"), "rows", schema).count() == 0


def test_run_history_of_one_query_is_split_by_day(spark):
    """A key with all rows: overlaps and gaps equal the plain window, and no task holds the whole history."""
    import random

    rnd = random.Random(6)
    rows = [(i, "s", "Q00", T0 + rnd.randrange(40 * 1440) * M, rnd.choice([30, 900, 90_000])) for i in range(1500)]
    df = spark.createDataFrame(rows, "run_id long, server_id string, query_id string, started_at timestamp_ntz, ms long").select(
        "*", (F.col("started_at") + F.expr("make_dt_interval(0, 0, 0, ms)")).alias("completed_at"), F.col("ms").alias("duration_ms"))
    ordered = sorted(rows, key=lambda r: (r[3], r[0]))
    want, latest, missed = set(), None, 0
    for i, (n, _, _, start, s) in enumerate(ordered):
        if latest is not None and latest > start:
            want.add((n, latest))
        latest = max(x for x in (latest, start + dt.timedelta(seconds=s)) if x is not None)
        if i:
            missed += max(0, round((start - ordered[i - 1][3]).total_seconds() / 60) - 1)
    out = overlapping_runs(df)
    assert {(r.run_id, r.previous_completed_at) for r in out.collect()} == want
    assert collector_health(df, {"Q00": 60}).first().missed_ticks == missed
    assert "_kb" in out._jdf.queryExecution().optimizedPlan().toString()  # windows over (key, day)
