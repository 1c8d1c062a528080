"""WN-01 semantics on hand-built rows: first sample, zero delta, fall, null-safe reset, zero elapsed."""

import datetime as dt

from pyspark.sql import functions as F

from statsweep.operators.deltas import counter_delta, with_previous

T0 = dt.datetime(2024, 1, 1)


def _rows(spark, rows):
    return spark.createDataFrame(
        rows, "server_id string, k long, source_collected_at timestamp_ntz, stats_reset timestamp_ntz, c long, seq long")


def test_reset_rules(spark):
    r1, r2 = T0, T0 + dt.timedelta(days=1)
    rows = [
        ("s", 1, T0, r1, 10, 1),                            # first
        ("s", 1, T0 + dt.timedelta(seconds=10), r1, 10, 2),  # equal value: zero delta
        ("s", 1, T0 + dt.timedelta(seconds=20), r1, 30, 3),  # delta 20 over 10 s
        ("s", 1, T0 + dt.timedelta(seconds=30), r1, 5, 4),   # fell: reset without a mark
        ("s", 1, T0 + dt.timedelta(seconds=40), r2, 50, 5),  # mark changed: reset
        ("s", 1, T0 + dt.timedelta(seconds=40), r2, 60, 6),  # zero elapsed: rate 0
        ("s", 1, T0 + dt.timedelta(seconds=50), None, 70, 7),  # mark to null: reset (null-safe)
        ("s", 1, T0 + dt.timedelta(seconds=60), None, 75, 8),  # null to null: delta
    ]
    for bucket in (None, 25, 86400):
        out = counter_delta(_rows(spark, rows), ["server_id", "k"], ["c"], tiebreak=["seq"], bucket_seconds=bucket)
        got = [(r.seq, r.c_kind, r.c_delta, r.c_rate) for r in out.orderBy("seq").collect()]
        assert got == [(1, "first", None, None), (2, "delta", 0, 0.0), (3, "delta", 20, 2.0), (4, "reset", None, None),
                       (5, "reset", None, None), (6, "delta", 10, 0.0), (7, "reset", None, None),
                       (8, "delta", 5, 0.5)], bucket


def test_bucketed_previous_equals_plain_lag(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    a = with_previous(ev, ["user_id"], ["ts", "event_id"], ["event_id"], "ts", "p", None)
    b = with_previous(ev, ["user_id"], ["ts", "event_id"], ["event_id"], "ts", "p", 3600)
    ka = {(r.event_id, r.p.event_id if r.p else None) for r in a.collect()}
    kb = {(r.event_id, r.p.event_id if r.p else None) for r in b.collect()}
    assert ka == kb and len(ka) == ev.count()


def test_hot_key_is_split_across_buckets(spark):
    """One key holding most rows: the bucketed plan partitions by (key, bucket)."""
    rows = [("s", 1, T0 + dt.timedelta(hours=h), T0, h, h) for h in range(200)]
    df = _rows(spark, rows)
    out = counter_delta(df, ["server_id", "k"], ["c"], tiebreak=["seq"], bucket_seconds=3600)
    assert out.where(F.col("c_kind") == "delta").count() == 199
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_bkt" in plan


def test_hot_key_spreads_over_partitions(spark):
    """One key with ~95% of the rows: the bucketed window spreads it; a plain key window cannot."""
    hot = [("s", 1, T0 + dt.timedelta(minutes=m), T0, m, m) for m in range(6000)]
    cold = [("s", k, T0 + dt.timedelta(minutes=m), T0, m, 100000 * k + m) for k in range(2, 12) for m in range(30)]
    df = _rows(spark, hot + cold)
    prev = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        def max_share(bucket):
            out = with_previous(df, ["server_id", "k"], ["source_collected_at", "seq"], ["c"],
                                "source_collected_at", "p", bucket)
            used = out.where(F.col("p").isNotNull() | F.col("p").isNull())  # keep the window in the plan
            sizes = [r["n"] for r in used.groupBy(F.spark_partition_id().alias("pid"))
                     .agg(F.count("p").alias("n")).collect()]
            return max(sizes) / sum(sizes)

        assert max_share(None) > 0.9
        assert max_share(3600) < 0.35
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", prev)
