"""SURVEY section 5 checklist items and properties on the library's own operators."""

import datetime as dt
import random

from pyspark.sql import functions as F

from statsweep.operators.deltas import counter_delta
from statsweep.operators.joins import range_join
from statsweep.operators.ledger import overlapping_runs
from statsweep.operators.series import breach_runs
from statsweep.sources import bindings as B
from statsweep.sources.readers import read_incremental

T0 = dt.datetime(2024, 1, 1)
SF = "/root/testdata/sf0.001"


def test_toplevel_is_part_of_the_query_key(spark):
    rows = [(1, True, T0, 10), (1, False, T0 + dt.timedelta(seconds=5), 500),
            (1, True, T0 + dt.timedelta(seconds=10), 20), (1, False, T0 + dt.timedelta(seconds=15), 600)]
    df = spark.createDataFrame([("s", q, tl, t, None, c, i) for i, (q, tl, t, c) in enumerate(rows)],
                               "server_id string, queryid long, toplevel boolean, source_collected_at timestamp_ntz, "
                               "stats_since timestamp_ntz, calls long, seq long")
    out = counter_delta(df, ["server_id", "queryid", "toplevel"], ["calls"], reset_col="stats_since", tiebreak=["seq"])
    got = sorted((r.toplevel, r.calls_kind, r.calls_delta) for r in out.collect())
    assert got == [(False, "delta", 100), (False, "first", None), (True, "delta", 10), (True, "first", None)]


def test_deltas_rebuild_the_counter(spark):
    rnd = random.Random(11)
    rows, seq = [], 0
    for k in range(5):
        v = 0
        for m in range(60):
            v = v + rnd.randrange(0, 50) if rnd.random() > 0.1 else rnd.randrange(0, 10)  # sometimes resets
            rows.append(("s", k, T0 + dt.timedelta(minutes=m + rnd.random()), None, v, seq))
            seq += 1
    df = spark.createDataFrame(rows, "server_id string, k long, source_collected_at timestamp_ntz, "
                                     "stats_reset timestamp_ntz, c long, seq long")
    out = counter_delta(df, ["server_id", "k"], ["c"], tiebreak=["seq"], bucket_seconds=600).orderBy("k", "seq")
    prev = {}
    for r in out.collect():
        if r.c_kind == "delta":
            assert prev[r.k] + r.c_delta == r.c
        else:
            assert r.c_delta is None
        prev[r.k] = r.c


def test_incremental_reads_in_slices_equal_one_read(spark):
    ev = B.table(spark, SF, "events")
    waits = B.window_waits_input(spark, ev)
    marks = [dt.datetime(2024, 1, d) for d in (3, 9, 14, 22)]
    end = dt.datetime(2024, 2, 2)
    full = read_incremental(waits, F.lit(marks[0]), F.lit(end))
    parts = None
    bounds = marks[1:] + [end]
    for lo, hi in zip(marks, bounds):
        p = read_incremental(waits, F.lit(lo), F.lit(hi + dt.timedelta(minutes=2)))
        parts = p if parts is None else parts.unionByName(p)
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, parts.collect()))


def test_phase_boundaries_start_included_end_excluded(spark):
    phases = spark.createDataFrame([("p1", T0, T0 + dt.timedelta(hours=1)), ("p2", T0 + dt.timedelta(hours=1), None)],
                                   "phase_name string, start_time timestamp_ntz, end_time timestamp_ntz")
    pts = spark.createDataFrame([(1, T0 - dt.timedelta(microseconds=1)), (2, T0), (3, T0 + dt.timedelta(hours=1)),
                                 (4, T0 + dt.timedelta(days=400))], "i long, ts timestamp_ntz")
    got = {r.i: r.phase_name for r in range_join(pts, phases, "ts", "start_time", "end_time").collect()}
    assert got == {1: None, 2: "p1", 3: "p2", 4: "p2"}


def test_overlapping_runs_on_crafted_ledger(spark):
    m = dt.timedelta(minutes=1)
    runs = [("r1", T0, T0 + 5 * m), ("r2", T0 + 2 * m, T0 + 3 * m), ("r3", T0 + 4 * m, T0 + 6 * m),
            ("r4", T0 + 7 * m, T0 + 8 * m)]
    df = spark.createDataFrame([("s", "Q", r, a, b) for r, a, b in runs],
                               "server_id string, query_id string, run_id string, started_at timestamp_ntz, "
                               "completed_at timestamp_ntz")
    assert sorted(r.run_id for r in overlapping_runs(df).collect()) == ["r2", "r3"]


def test_breach_run_lengths_sum_to_breach_count(spark):
    s = B.metric_series(spark, B.table(spark, SF, "events"))
    cond = F.col("value") >= 60
    runs = breach_runs(s, cond, 3600)
    assert runs.agg(F.sum("run_samples")).first()[0] == s.where(cond).count()


def test_relation_shares_sum_to_100(spark):
    from statsweep.operators import cache as CA

    c = CA.cache_by_relation(B.buffers(B.table(spark, SF, "lineitem")), 1)
    mapped = CA.map_relations(c, B.buffer_catalog(B.table(spark, SF, "part")), 1663)
    rep = CA.relation_cache_report(mapped, k=None)
    for r in rep.groupBy("source_collected_at").agg(F.sum("share_of_current_database_cached_buffers_percent")
                                                    .alias("s")).collect():
        assert abs(r.s - 100.0) < 0.01 * 200  # each share rounded to 0.01
