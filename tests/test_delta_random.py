"""WN-01 on random series against a direct Python reading of the reset rules."""

import datetime as dt
import random

from statsweep.operators.deltas import counter_delta

T0 = dt.datetime(2024, 1, 1)


def _reference(rows):
    """rows sorted by (key, time, seq): yields (seq, kind, delta, rate, elapsed)."""
    out, last = {}, {}
    for k, t, seq, reset, c in rows:
        p = last.get(k)
        if p is None:
            out[seq] = ("first", None, None, None)
        else:
            el = (t - p[0]).total_seconds()
            if p[1] != reset or c < p[2]:
                out[seq] = ("reset", None, None, el)
            else:
                d = c - p[2]
                out[seq] = ("delta", d, d / el if el > 0 else 0.0, el)
        last[k] = (t, reset, c)
    return out


def test_random_series(spark):
    rnd = random.Random(5)
    rows, seq = [], 0
    for k in range(6):
        t, c = T0, 0
        reset = T0
        for _ in range(rnd.randrange(1, 120)):
            t = t + dt.timedelta(seconds=rnd.choice([0, 1, 15, 60, 3600, 86400 * 2]), microseconds=rnd.randrange(3))
            r = rnd.random()
            if r < 0.05:
                reset = None if rnd.random() < 0.5 else t
            c = c - rnd.randrange(1, 50) if r > 0.93 else c + rnd.randrange(0, 100)
            rows.append((k, t, seq, reset, c))
            seq += 1
    rows.sort(key=lambda x: (x[0], x[1], x[2]))
    want = _reference(rows)
    df = spark.createDataFrame([("s", k, t, r, c, s) for k, t, s, r, c in rows],
                               "server_id string, k long, source_collected_at timestamp_ntz, "
                               "stats_reset timestamp_ntz, c long, seq long")
    for bucket in (None, 60, 3600, 86400):
        got = counter_delta(df, ["server_id", "k"], ["c"], tiebreak=["seq"], bucket_seconds=bucket).collect()
        assert len(got) == len(rows)
        for r in got:
            kind, d, rate, el = want[r.seq]
            assert (r.c_kind, r.c_delta) == (kind, d), (bucket, r.seq)
            assert (r.c_rate is None) == (rate is None) and (rate is None or abs(r.c_rate - rate) < 1e-9)
            assert (r.elapsed_seconds is None) == (el is None) and (el is None or abs(r.elapsed_seconds - el) < 1e-9)
