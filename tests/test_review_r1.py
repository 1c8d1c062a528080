"""Clock changes, nulls in streams, long queues of waiters, quoted names, rule limits, scratch folders."""

import datetime as dt
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from statsweep.functions.scalars import quote_ident
from statsweep.operators.blocking import root_blockers, wait_edges, waits_on
from statsweep.operators.deltas import epoch_micros, seconds_between
from statsweep.operators.series import breach_runs
from statsweep.plans.rules import EXTRA_PACKS, PACKS
from statsweep.session import ensure_checkpoint_dir
from statsweep.streaming.state import _delta_frame, _fold

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture
def berlin(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", before)


def test_times_ignore_the_session_zone(berlin):
    times = [dt.datetime(2024, 3, 31, 1, 59, 59, 999999), dt.datetime(2024, 3, 31, 2, 30), dt.datetime(2024, 3, 31, 3),
             dt.datetime(2024, 10, 27, 2, 30), dt.datetime(1969, 12, 31, 23, 59, 59, 1), dt.datetime(2199, 1, 1, 0, 0, 0, 7)]
    df = berlin.createDataFrame([(i, t) for i, t in enumerate(times)], "i int, t timestamp_ntz")
    zero = F.expr("TIMESTAMP_NTZ'2024-03-31 00:00:00'")
    for r in df.select("i", epoch_micros("t").alias("us"), seconds_between("t", zero).alias("s")).collect():
        assert r.us == (times[r.i] - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
        assert r.s == (times[r.i] - dt.datetime(2024, 3, 31)) / dt.timedelta(seconds=1)


def test_breach_run_over_a_clock_change(berlin):
    rows = [("k", dt.datetime(2024, 3, 30, 12) + dt.timedelta(hours=i), 95.0) for i in range(48)]
    df = berlin.createDataFrame(rows, "k string, t timestamp_ntz, value double")
    runs = breach_runs(df, F.col("value") > 90, 3600, ["k"], "t").collect()
    assert len(runs) == 1


def _frames(parts, double=False):
    prev, out = None, []
    for part in parts:
        pdf = pd.DataFrame({"t": [T0 + dt.timedelta(seconds=s) for s, _ in part], "e": [s for s, _ in part],
                            "c": pd.Series([v for _, v in part], dtype="float64" if double or None in [v for _, v in part] else "int64")})
        frame, prev = _delta_frame(pdf, prev, "t", "e", ["c"], None, doubles=frozenset(["c"] if double else []))
        out += list(zip(frame["c_kind"], [None if pd.isna(x) else x for x in frame["c_delta"]]))
    return out


@pytest.mark.parametrize("double", [False, True])
def test_stream_delta_after_a_null(double):
    rows = [(1, 100), (2, None), (3, 300), (4, 400), (5, 50)]
    want = [("first", None), ("delta", None), ("delta", None), ("delta", 100), ("reset", None)]
    for cut in range(1, 5):
        assert _frames([rows[:cut], rows[cut:]], double) == want


def test_fold_jumps_equal_the_row_by_row_reading():
    rng = np.random.default_rng(4)
    for one in (True, False):
        t = np.sort(rng.integers(0, 4000, 300))
        cd = np.full(300, 90) if one else rng.choice([30, 90, 200], 300)
        pdf = pd.DataFrame({"server_id": "s", "target": "t", "rule": "r", "cooldown_s": cd, "seq": range(300),
                            "ts": [T0 + dt.timedelta(seconds=int(x)) for x in t]})
        for start in (None, 500):
            last, want = start, []
            for x, c in zip(t, cd):
                if last is None or x - last >= c:
                    want.append(x)
                    last = x
            us = None if start is None else int((T0 - dt.datetime(1970, 1, 1)).total_seconds() + start) * 1_000_000
            res, _ = _fold(pdf, us)
            assert [(x - T0).total_seconds() for x in res["fired_at"]] == want


def test_queue_of_waiters_and_cycles(spark):
    """A queue of 60, each blocked by all ahead; a chain of 40; a cycle with a tail."""
    locks = [("queue", p, list(range(1, p))) for p in range(2, 61)]
    locks += [("chain", p, [p - 1]) for p in range(2, 42)]
    locks += [("cycle", 1, [2]), ("cycle", 2, [3]), ("cycle", 3, [1, 9]), ("cycle", 4, [1])]
    df = spark.createDataFrame([(s, T0, p, False, b) for s, p, b in locks],
                               "server_id string, source_collected_at timestamp_ntz, pid int, granted boolean, blocking_pids array<int>")
    got = {(r.server_id, r.blocker_pid): (r.direct_waiters, r.total_waiters) for r in root_blockers(wait_edges(df)).collect()}
    assert got == {("queue", 1): (59, 59), ("chain", 1): (1, 40), ("cycle", 9): (1, 4)}
    assert waits_on(wait_edges(df).where("server_id = 'cycle'")).where("root_blocked_pid = blocker_pid").isEmpty()


def test_quote_ident(spark):
    names = ["orders", "user", "order", "a$b", "_x1", "Mixed", 'q"q', "value", "1a", ""]
    got = [r.q for r in spark.createDataFrame([(n,) for n in names], "n string").select(quote_ident("n").alias("q")).collect()]
    assert got == ["orders", '"user"', '"order"', '"a$b"', "_x1", '"Mixed"', '"q""q"', "value", '"1a"', '""']


# Limits as the specification states them, written apart from the packs.
LIMITS = {
    "chain_depth": {"high": 3, "critical": 5},
    "lock_wait": {"warning": 5, "high": 30, "critical": 60},
    "lock_wait_share": {"warning": 5, "high": 15},
    "io_wait_share": {"warning": 20, "high": 40},
    "connection_utilization": {"warning": 70, "high": 85, "critical": 95},
    "cache_hit": {"warning": 99, "high": 97, "critical": 95},
    "requested_checkpoints": {"warning": 20},
    "mostly_requested_checkpoints": {"high": 50},
    "unmatched_waits": {"high": 5},
    "unmapped_wait_event": {"warning": 1},
    "unmapped_wait_events": {"high": 1},
    "pending_restart": {"high": 1},
    "maintenance_stalled": {"high": 1},
    "long_maintenance": {"warning": 1800},
}


def test_rule_limits():
    import statsweep.plans.catalog  # noqa: F401  (adds the packs over derived inputs)

    rules = {r.rule_id: r for p in (*PACKS, *EXTRA_PACKS) for r in p.rules}
    for name, levels in LIMITS.items():
        assert dict(rules[name].levels) == levels, name
    assert "mean_time_ms < 50" in rules["short_frequent_parallel"].value
    assert rules["cache_hit"].sustain_s == 900 and rules["mostly_requested_checkpoints"].sustain_s is None


def test_no_private_scratch_folder_on_a_cluster():
    sc = SimpleNamespace(master="spark://host:7077", getConf=lambda: {}, getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf={}))
