"""Series operators: gaps end runs, coverage is required, consecutive counts rows."""

import datetime as dt

from pyspark.sql import functions as F

from statsweep.operators.series import breach_runs, changes, consecutive, increasing, stalled, sustained

T0 = dt.datetime(2024, 1, 1)


def _series(spark, values):
    rows = [("r", "cpu", "", T0 + dt.timedelta(minutes=m), float(v)) for m, v in values]
    return spark.createDataFrame(rows, "resource_id string, metric_id string, dimension_key string, "
                                       "time_utc timestamp_ntz, value double")


def test_missing_minute_ends_a_run(spark):
    s = _series(spark, [(0, 95), (1, 95), (3, 95), (4, 95), (5, 50), (6, 95)])
    runs = sorted((r.run_start.minute, r.run_samples) for r in breach_runs(s, F.col("value") >= 90, 60).collect())
    assert runs == [(0, 2), (3, 2), (6, 1)]


def test_sustained_needs_full_coverage(spark):
    s = _series(spark, [(0, 90), (1, 90), (2, 90), (5, 90), (6, 90)])
    out = {r.time_utc.minute: r.sustained for r in sustained(s, "value", 180, 60, 80.0).collect()}
    assert out == {0: False, 1: False, 2: True, 5: False, 6: False}


def test_consecutive(spark):
    s = _series(spark, [(0, 95), (1, 95), (2, 95), (3, 10), (4, 95)])
    out = {r.time_utc.minute: r.consecutive for r in consecutive(s, F.col("value") >= 90, 3).collect()}
    assert out == {0: False, 1: False, 2: True, 3: False, 4: False}


def test_time_buckets_equal_one_pass_over_the_history(spark):
    """Runs, changes and stalls over several days, one longer than a day, for a named and a null key."""
    step, day = 30, 48
    values = [(k * 7919 % 13) % 4 for k in range(2 * day)] + [3] * (2 * day + 5) + [(k * 31 % 7) % 4 for k in range(day)]
    rows = [(key, "cpu", "", T0 + dt.timedelta(minutes=step * i), float(v)) for key in ("r", None) for i, v in enumerate(values)]
    s = spark.createDataFrame(rows, "resource_id string, metric_id string, dimension_key string, "
                                    "time_utc timestamp_ntz, value double")
    runs, rises, since = [], [], []
    for i, v in enumerate(values):
        runs.append((runs[-1] if runs else 0) + 1 if v >= 1 else 0)
        rises.append((rises[-1] if rises else 0) + 1 if i and v > values[i - 1] else 0)
        since.append(since[-1] + 1 if i and v == values[i - 1] else 0)
    at = lambda r: int((r.time_utc - T0).total_seconds() // (60 * step))
    hot = F.col("value") >= 1
    for n in (2, 60):
        got = consecutive(s, hot, n).collect()
        assert len(got) == 2 * len(values) and all(r.consecutive == (runs[at(r)] >= n) for r in got)
    assert all(r.increasing == (rises[at(r)] >= 2) for r in increasing(s, "value", 3).collect())
    keys = ["resource_id", "metric_id", "dimension_key"]
    assert all(r.unchanged_seconds == since[at(r)] * 60.0 * step
               for r in stalled(s, "value", 3600, keys, "time_utc").collect())
    assert all(r.changed == (at(r) > 0 and since[at(r)] == 0) for r in changes(s, "value", keys, "time_utc").collect())
    want = sorted(runs[i] for i in range(len(runs)) if runs[i] and (i + 1 == len(runs) or not runs[i + 1]))
    got = breach_runs(s, hot, 60 * step).collect()
    assert sorted(r.run_samples for r in got if r.resource_id == "r") == want
    assert sorted(r.run_samples for r in got if r.resource_id is None) == want
    full = [min(values[max(0, i - 59):i + 1]) >= 1 and i >= 59 for i in range(len(values))]
    assert all(r.sustained == full[at(r)] for r in sustained(s, "value", 60 * 60 * step, 60 * step, 1.0, every=True).collect())
