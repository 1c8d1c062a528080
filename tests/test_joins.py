"""As-of and range joins against brute force, with broadcast and with shuffled interval sides."""

import datetime as dt
import random

from statsweep.operators.joins import align_asof, range_join

T0 = dt.datetime(2024, 1, 1)


def test_asof_matches_brute_force(spark):
    rnd = random.Random(7)
    left = [(rnd.randrange(3), i, T0 + dt.timedelta(minutes=rnd.randrange(5000))) for i in range(300)]
    right = [(rnd.randrange(3), 1000 + i, T0 + dt.timedelta(minutes=rnd.randrange(5000))) for i in range(200)]
    l = spark.createDataFrame(left, "k long, id long, t timestamp_ntz")
    r = spark.createDataFrame(right, "k long, rid long, rt timestamp_ntz")
    got = {x.id: x.rid for x in align_asof(l, r, ["k"], "t", "rt", ["rid"], bucket_seconds=86400).collect()}
    for k, i, t in left:
        cands = [(rt, rid) for kk, rid, rt in right if kk == k and rt <= t]
        assert got[i] == (max(cands)[1] if cands else None)


def test_asof_tolerance(spark):
    l = spark.createDataFrame([(1, 1, T0 + dt.timedelta(seconds=100))], "k long, id long, t timestamp_ntz")
    r = spark.createDataFrame([(1, 9, T0)], "k long, rid long, rt timestamp_ntz")
    assert align_asof(l, r, ["k"], "t", "rt", ["rid"], tolerance_s=60).first().rid is None
    assert align_asof(l, r, ["k"], "t", "rt", ["rid"], tolerance_s=120).first().rid == 9


def _both_plans(spark, run):
    """``run()`` with Spark's broadcast threshold as it is, and with broadcasts off."""
    out = [run()]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return [*out, run()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_range_join_broadcast_and_shuffled_agree(spark):
    iv = spark.createDataFrame([("a", T0, T0 + dt.timedelta(days=2)), ("b", T0 + dt.timedelta(days=2), None)],
                               "phase string, start_time timestamp_ntz, end_time timestamp_ntz")
    pts = spark.createDataFrame([(i, T0 + dt.timedelta(hours=12 * i)) for i in range(10)], "i long, ts timestamp_ntz")
    small, big = _both_plans(spark, lambda: {(r.i, r.phase) for r in range_join(
        pts, iv, "ts", "start_time", "end_time").collect()})
    assert small == big
    assert small == {(i, "a" if i < 4 else "b") for i in range(10)}


def test_range_join_random_with_keys_both_plans(spark):
    rnd = random.Random(21)
    ivs = []
    for k in range(3):
        t = T0
        for i in range(6):
            start = t + dt.timedelta(hours=rnd.randrange(0, 30))
            end = None if i == 5 else start + dt.timedelta(hours=rnd.randrange(1, 60))
            ivs.append((k, f"p{k}-{i}", start, end))
            t = start
    pts = [(i, rnd.randrange(3), T0 + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 12))) for i in range(300)]
    iv = spark.createDataFrame(ivs, "k long, phase string, start_time timestamp_ntz, end_time timestamp_ntz")
    pt = spark.createDataFrame(pts, "i long, k long, ts timestamp_ntz")
    want = set()
    for i, k, ts in pts:
        hit = [ph for kk, ph, s, e in ivs if kk == k and s <= ts and (e is None or ts < e)]
        want |= {(i, ph) for ph in hit} if hit else {(i, None)}
    for got in _both_plans(spark, lambda: {(r.i, r.phase) for r in range_join(
            pt, iv, "ts", "start_time", "end_time", ["k"]).collect()}):
        assert got == want


def test_range_join_odd_intervals(spark):
    """Intervals after the last row, before the first, empty, reversed, without a start; rows without a time."""
    h = lambda n: T0 + dt.timedelta(hours=n)
    iv = spark.createDataFrame([("late", h(5000), None), ("early", h(-90), h(-50)), ("empty", h(3), h(3)), ("reversed", h(9), h(1)),
                                ("unknown", None, h(9)), ("all", h(-999), None)],
                               "phase string, start_time timestamp_ntz, end_time timestamp_ntz")
    pts = spark.createDataFrame([(0, h(0)), (1, h(3)), (2, h(80)), (3, None)], "i long, ts timestamp_ntz")
    for got in _both_plans(spark, lambda: {(r.i, r.phase) for r in range_join(pts, iv, "ts", "start_time", "end_time").collect()}):
        assert got == {(0, "all"), (1, "all"), (2, "all"), (3, None)}
    assert range_join(pts.limit(0), iv, "ts", "start_time", "end_time").count() == 0


def test_asof_equal_right_times(spark):
    l = spark.createDataFrame([(1, 1, T0)], "k long, id long, t timestamp_ntz")
    r = spark.createDataFrame([(1, 7, T0), (1, 9, T0), (1, 8, T0)], "k long, rid long, rt timestamp_ntz")
    assert align_asof(l, r, ["k"], "t", "rt", ["rid"]).first().rid == 9
