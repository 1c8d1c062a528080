"""Trailing averages with coverage (batch and stream), run starts over buckets, expected samples, benefit bands."""

import datetime as dt
import random

from pyspark.sql import functions as F

from statsweep.operators.compare import parallelism_benefit
from statsweep.operators.deltas import running
from statsweep.operators.ledger import expected_samples
from statsweep.operators.series import sustained, trailing_averages
from statsweep.plans.rules import Rule, evaluate
from statsweep.streaming.windows import sliding_threshold

T0 = dt.datetime(2024, 1, 1)
MINUTE = dt.timedelta(minutes=1)


def _rows(spark, rows):
    return spark.createDataFrame(rows, "k string, t timestamp_ntz, v double")


def test_trailing_averages_equal_a_reading_by_hand(spark):
    """Several ranges over a day's end, gaps, null values, two samples in a minute, a null key."""
    rng = random.Random(3)
    rows = [(k, T0 + dt.timedelta(hours=23) + MINUTE * m + dt.timedelta(seconds=s), None if rng.random() < 0.03 else float(rng.randint(0, 100)))
            for k in ("a", None) for m in range(150) if rng.random() > 0.05 for s in ((5, 40) if m % 11 == 0 else (20,))]
    got = trailing_averages(_rows(spark, rows), {"a3": ("v", 180), "a10": ("v", 600)}, 60, ["k"], "t").collect()
    assert len(got) == len(rows)
    minute = lambda t: int((t - T0).total_seconds()) // 60
    some = 0
    for r in got:
        for name, n in (("a3", 3), ("a10", 10)):
            near = [(minute(t), v) for k, t, v in rows if k == r.k and minute(r.t) - n < minute(t) <= minute(r.t) and v is not None]
            whole = len({m for m, _ in near}) == n
            assert (r[name] is not None) == whole
            if whole:
                some += 1
                assert abs(r[name] - sum(v for _, v in near) / len(near)) < 1e-9
    assert some > 50


def test_run_starts_over_days_equal_one_pass(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for k in ("a", None):
        start, on = None, False
        for i in range(400):
            t = T0 + dt.timedelta(minutes=37 * i)
            on = on if rng.random() < (0.99 if k else 0.8) else not on
            start = (start or t) if on else None
            rows.append((k, t, float(on)))
            want[k, t] = start
    got = running(_rows(spark, rows), ["k"], ["t"], "t", starts={"s": F.col("v") > 0}).collect()
    assert {(r.k, r.t): r.s for r in got} == want


def test_rule_on_an_average_needs_every_sample(spark):
    df = _rows(spark, [("s", T0 + MINUTE * m, v) for m, v in [(0, 90.0), (1, 60.0), (2, 95.0), (4, 99.0), (5, 99.0), (6, 99.0)]])
    rules = [Rule("avg", "v", (("warning", 70.0), ("high", 99.0)), ">=", average_s=180), Rule("now", "v", (("critical", 99.0),), ">=")]
    hits = sorted((r.rule_id, r.t.minute, r.severity, r.value) for r in evaluate(df, rules, ["k"], "t", cadence_s=60).collect())
    assert hits == [("avg", 2, "warning", 81.666667), ("avg", 6, "high", 99.0), *[("now", m, "critical", 99.0) for m in (4, 5, 6)]]


def test_stream_threshold_equals_the_batch_form_and_needs_coverage(spark, tmp_path):
    """More panes than one bitmap word holds; a missing minute, a null value."""
    panes = 70
    rows = [("a", T0 + MINUTE * m, None if m == 300 else 50.0 + m % 60) for m in range(420) if m != 100]
    df = _rows(spark, rows)
    src, sink = str(tmp_path / "src"), str(tmp_path / "out")
    df.repartition(3).write.parquet(src)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = sliding_threshold(stream, "t", ["k"], "v", f"{panes} minutes", "1 minute", 70.0, panes, 60, watermark="2 days")
    q = (out.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True)
         .foreachBatch(lambda b, i: b.withColumn("batch", F.lit(i)).write.mode("overwrite").parquet(f"{sink}/b={i}")).start())
    assert q.awaitTermination(180)
    last = spark.read.parquet(sink).groupBy("window_start", "window_end").agg(F.max_by(F.struct("above_limit", "covered_panes"), "batch").alias("x"))
    flagged = {r.window_end for r in last.where("x.above_limit").collect()}
    batch = sustained(df.where("v IS NOT NULL"), "v", panes * 60, 60, 70.0, ["k"], "t")
    want = {r.t + MINUTE for r in batch.where("sustained").collect()}
    assert flagged == want and want
    assert last.agg(F.max("x.covered_panes")).first()[0] == panes


def test_expected_samples_fill_the_ticks_between_first_and_last_run(spark):
    at = lambda s: T0 + dt.timedelta(seconds=s)
    runs = spark.createDataFrame([("a", at(86_395)), ("a", at(86_400 + 61)), ("a", None), ("b", at(7))], "server_id string, started_at timestamp_ntz")
    got = sorted((r.server_id, (r.source_collected_at - T0).total_seconds()) for r in expected_samples(runs, 15).collect())
    assert got == [("a", 86_400.0 + 15 * i) for i in range(6)] + [("b", 15.0)]
    assert expected_samples(runs.limit(0), 15).count() == 0


def test_saturated_workers_and_lost_headroom_decide_the_label(spark):
    cols = "successful_rps_change_percent double, p99_ms_change_percent double, baseline_error_rate double, after_error_rate double, " \
           "baseline_pool double, after_pool double, baseline_cpu double, after_cpu double"
    rows = [(6.0, 0.0, 0.0, 0.0, 50.0, 60.0, 50.0, 55.0), (6.0, 0.0, 0.0, 0.0, 50.0, 95.0, 50.0, 50.0), (6.0, 0.0, 0.0, 0.0, 96.0, 97.0, 50.0, 50.0),
            (6.0, 0.0, 0.0, 0.0, 50.0, 60.0, 50.0, 56.0), (6.0, 0.0, 0.0, 0.0, None, None, None, None)]
    got = [r.parallelism_benefit for r in parallelism_benefit(spark.createDataFrame(rows, cols), workers="pool", cpu="cpu").collect()]
    assert got == ["positive", "negative", "positive", "neutral", "positive"]
