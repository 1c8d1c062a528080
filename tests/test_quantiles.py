"""Distributed exact percentiles equal numpy's linear interpolation, with a dominant group and null keys."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from statsweep.functions.quantiles import exact_percentiles, exact_summary


def test_exact_percentiles_match_numpy(spark):
    rnd = random.Random(3)
    rows = [("hot", rnd.random() * 100) for _ in range(3000)]
    rows += [(f"g{i % 7}", float(rnd.randrange(1000))) for i in range(700)]
    rows += [(None, float(i)) for i in range(11)] + [("one", 5.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    qs = [0.0, 0.5, 0.9, 0.95, 0.99, 1.0]
    got = {r.g: [r[f"q{i}"] for i in range(len(qs))]
           for r in exact_percentiles(df, ["g"], "v", qs, [f"q{i}" for i in range(len(qs))]).collect()}
    groups: dict = {}
    for g, v in rows:
        groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, vals in groups.items():
        want = np.quantile(np.array(vals), qs, method="linear")
        assert np.allclose(got[g], want, rtol=0, atol=1e-9), g


def test_exact_summary_all_null_group_and_stats(spark):
    from statsweep.operators.series import summarize_series

    rows = [("a", float(v)) for v in (3, 1, 2, 10)] + [("b", None), ("b", None), (None, 4.0)]
    df = spark.createDataFrame(rows, "g string, value double")
    got = {r.g: r for r in summarize_series(df, ["g"]).collect()}
    assert got["a"].sample_count == 4 and got["a"].min_value == 1.0 and got["a"].max_value == 10.0
    assert got["a"].avg_value == 4.0 and got["a"].p50 == 2.5
    assert got["b"].sample_count == 0 and got["b"].min_value is None and got["b"].p50 is None
    assert got[None].sample_count == 1 and got[None].p99 == 4.0


@pytest.mark.parametrize("reuse,aqe", [("true", "true"), ("false", "true"), ("false", "false")])
def test_percentiles_do_not_depend_on_the_plan(spark, reuse, aqe):
    """Equal to ``percentile`` with exchange reuse and adaptive execution off; a hot group and a dominant tied value."""
    rows = [("hot", float(i % 7919) if i % 3 else 42.0) for i in range(30_000)] + [("cold", float(i) ** 3) for i in range(50)]
    rows += [("one", 5.0), ("nulls", None), (None, 1.5), (None, 2.5), ("tied", 7.0), ("tied", 7.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    old = {k: spark.conf.get(k) for k in ("spark.sql.exchange.reuse", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    try:
        got = {r.g: (r.sample_count, r.p50, r.p95, r.p99) for r in exact_summary(df, ["g"], "v", [0.5, 0.95, 0.99]).collect()}
        want = {r.g: (r.n, *(r.p or [None] * 3)) for r in df.groupBy("g").agg(
            F.count("v").alias("n"), F.percentile("v", [0.5, 0.95, 0.99]).alias("p")).collect()}
    finally:
        for k, x in old.items():
            spark.conf.set(k, x)
    assert got.keys() == want.keys()
    for g, row in want.items():
        assert [x is None for x in got[g]] == [x is None for x in row], g
        assert [x for x in got[g] if x is not None] == pytest.approx([x for x in row if x is not None], rel=1e-12), g


def _image(v):
    import struct

    if v != v:
        return (1 << 63) - 1
    bits = struct.unpack("<q", struct.pack("<d", abs(v)))[0]
    return -bits if v < 0 else bits


def test_ordered_bits_are_the_ieee_order(spark):
    import struct

    from statsweep.functions.quantiles import ordered_bits

    rnd = random.Random(1)
    vals = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, float("inf"), -float("inf"), float("nan")]
    vals += [s * f(2.0 ** k) for k in range(-1074, 1024) for s in (1, -1) for f in (float, lambda x: float(np.nextafter(x, 0)))]
    vals += [struct.unpack("<d", struct.pack("<Q", rnd.getrandbits(64)))[0] for _ in range(5000)]
    for r in spark.createDataFrame([(v,) for v in vals], "v double").select("v", ordered_bits(F.col("v")).alias("k")).collect():
        assert r.k == _image(r.v), r.v


def test_heavy_tails_leave_no_large_window(spark):
    """Durations below 1,000 with one outlier of 1e18 and one of 1e12, and values that differ in their last bits only:
    equal to ``percentile``, and no bucket of the last round is larger than the bound."""
    from statsweep.functions import quantiles

    rows = [("tail", i / 200) for i in range(20_000)] + [("tail", 1e18), ("tail", 1e12)]
    rows += [("near", 1.0 + i * 2.0 ** -52) for i in range(3000)] + [("near", 1e300), ("near", -1e300)]
    rows += [("spread", s * 10.0 ** (i % 31 - 15)) for i in range(2000) for s in (1, -1)] + [("spread", 0.0), ("inf", float("inf")), ("inf", 1.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    qs = [0.0, 0.25, 0.5, 0.95, 0.99]
    got = {r.g: [r[f"p{int(q * 100)}"] for q in qs] for r in exact_summary(df, ["g"], "v", qs).collect()}
    want = {r.g: list(r.p) for r in df.groupBy("g").agg(F.percentile("v", qs).alias("p")).collect()}
    assert got["tail"] == pytest.approx(want["tail"], rel=1e-12) and got["spread"] == pytest.approx(want["spread"], rel=1e-15)
    assert got["near"] == pytest.approx(want["near"], rel=4e-16)  # a step of the last bit: the two interpolate in another order
    assert got["inf"][0] == 1.0
    k = df.where("g IN ('tail', 'near')").groupBy("g", "v").count().withColumn("_k", quantiles.ordered_bits(F.col("v")))
    at = ["g"]
    for i in range(quantiles.ROUNDS):
        ends = k.groupBy(*at).agg(F.min("_k").alias("_lo"), F.max("_k").alias("_hi"))
        k = k.join(ends, at).withColumn(f"b{i}", quantiles._bucket("_lo", "_hi")).drop("_lo", "_hi")
        assert k.agg(F.min(f"b{i}"), F.max(f"b{i}")).first()[1] <= quantiles.BUCKETS
        at.append(f"b{i}")
    assert k.groupBy(*at).agg((F.max("_k") - F.min("_k")).alias("w")).agg(F.max("w")).first()[0] <= quantiles.BUCKETS
