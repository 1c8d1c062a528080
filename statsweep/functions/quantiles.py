"""Exact continuous percentiles without holding a group in one task.

``percentile`` buffers all of a group's values in one aggregation buffer, so a
group holding a third of a huge table cannot be summarised exactly. Here equal
values collapse into counts, written once, and each rank is found by radix
selection on the order-preserving 64-bit image of a double: a round cuts the
images between the bounds of the bucket that holds the rank into 2^16 buckets,
and running counts per bucket tell which one holds it. Images spread heavy tails
(a few bits per decade), and after three rounds a bucket spans at most 2^16 images
whatever the values, so no window has more rows than ``2^16`` and a few. The bounds
follow from the values alone (no partition ids, no sampled ranges). The definition is
``percentile`` / ``percentile_cont``: ``v[lo] + (pos - lo) * (v[hi] - v[lo])`` with
``pos = q * (n - 1)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statsweep.session import ensure_checkpoint_dir

BUCKETS = 1 << 16
ROUNDS = 3


def ordered_bits(v: Column) -> Column:
    """A bigint that orders like the double ``v``: for numbers the IEEE bits of the magnitude with the sign of ``v``;
    infinities lie beyond all numbers and NaN is the greatest. Zeros are equal. Plain arithmetic, exact at every step."""
    mag = F.abs(v)
    # the exponent by logarithm may be one off; dividing by powers of two is exact
    guess = F.greatest(F.lit(-1022.0), F.least(F.lit(1023.0), F.floor(F.log2(mag)).cast("double")))
    ratio = mag / F.pow(F.lit(2.0), guess)
    exponent = F.greatest(F.lit(-1022.0), guess + F.when(ratio >= 2, 1.0).when(ratio < 1, -1.0).otherwise(0.0))
    part = mag / F.pow(F.lit(2.0), exponent)  # 1 to 2; below 1 for the numbers next to zero
    bits = ((exponent + 1022).cast("bigint") * (1 << 52)) + (part * float(1 << 52)).cast("bigint")
    bits = F.when(mag == 0, F.lit(0)).when(mag == float("inf"), F.lit(2047 << 52)).otherwise(bits)
    return F.when(F.isnan(v), F.lit((1 << 63) - 1)).when(v < 0, -bits).otherwise(bits)


def _bucket(lo: str, hi: str):
    """Bucket of the image ``_k`` between the bounds; halved images keep the differences inside 64 bits."""
    low, width = F.shiftright(lo, 1), F.shiftright(hi, 1) - F.shiftright(lo, 1)
    return _quotient(F.shiftright("_k", 1) - low, _quotient(width, F.lit(BUCKETS)) + 1)


def _quotient(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _locate(ranks: DataFrame, values: DataFrame, at: list[str], by: str) -> DataFrame:
    """``ranks`` (``at`` columns and ``_rank`` inside them) with the bucket ``by`` that holds each rank, the bounds of
    the bucket's values, and ``_rank`` counted from the bucket's first value."""
    sums = values.groupBy(*at, by).agg(F.sum("_n").alias("_c"), F.min("_k").alias("_lo"), F.max("_k").alias("_hi"))
    before = Window.partitionBy(*at).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_off", F.coalesce(F.sum("_c").over(before), F.lit(0)))
    found = ranks.join(sums, at).where((F.col("_rank") >= F.col("_off")) & (F.col("_rank") < F.col("_off") + F.col("_c")))
    return found.withColumn("_rank", F.col("_rank") - F.col("_off")).drop("_c", "_off")


def exact_summary(df: DataFrame, keys: Sequence[str], value: str, qs: Sequence[float],
                  names: Sequence[str] | None = None) -> DataFrame:
    """Per group: ``sample_count``, ``min_value``, ``max_value``, ``sum_value`` and one column per quantile.

    Null values are left out of every statistic; a group whose values are all null still gets a row (count 0,
    nulls). Groups are handled as a struct of ``keys``, so null key values form groups too.
    """
    keys = list(keys)
    names = list(names) if names else [f"p{int(round(q * 100))}" for q in qs]
    v = df.select(F.struct(*[F.col(k) for k in keys]).alias("_g"), F.col(value).cast("double").alias("_v"))
    stats = v.groupBy("_g").agg(F.count("_v").alias("sample_count"), F.min("_v").alias("min_value"),
                                F.max("_v").alias("max_value"), F.sum("_v").alias("sum_value"))
    q_rows = F.explode(F.array(*[F.struct(F.lit(i).alias("qi"), F.lit(float(q)).alias("q"))
                                 for i, q in enumerate(qs)]))
    t = stats.where("sample_count > 0").select("_g", "sample_count", q_rows.alias("_q")).select(
        "_g", F.col("_q.qi").alias("_qi"), (F.col("_q.q") * (F.col("sample_count") - 1)).alias("_at"))
    # at most two ranks per group and quantile
    t = t.select("*", F.explode(F.array(F.floor("_at"), F.ceil("_at"))).alias("_rank")).select(
        "*", F.col("_rank").alias("_whole"))
    ensure_checkpoint_dir(df.sparkSession)
    counts = v.where(F.col("_v").isNotNull()).groupBy("_g", "_v").agg(F.count(F.lit(1)).alias("_n")).select(
        "*", ordered_bits(F.col("_v")).alias("_k")).checkpoint()
    at, x = ["_g"], counts.join(counts.groupBy("_g").agg(F.min("_k").alias("_lo"), F.max("_k").alias("_hi")), "_g")
    for i in range(ROUNDS):
        bucket = f"_b{i}"
        x = x.withColumn(bucket, _bucket("_lo", "_hi")).drop("_lo", "_hi")
        t = _locate(t, x, at, bucket)
        at = [*at, bucket]
        # only the buckets that hold a rank go on, with the bounds of their images
        x = x.join(t.select(*at, "_lo", "_hi").distinct(), at)
        t = t.drop("_lo", "_hi")
    upto = Window.partitionBy(*at).orderBy("_k").rowsBetween(Window.unboundedPreceding, 0)
    small = x.select(*at, "_v", "_n", F.sum("_n").over(upto).alias("_end"))
    picked = t.join(small, at).where((F.col("_rank") < F.col("_end")) & (F.col("_rank") >= F.col("_end") - F.col("_n")))
    per_q = picked.groupBy("_g", "_qi").agg(
        F.first("_at").alias("_at"), F.min_by("_v", "_whole").alias("_lo"), F.max_by("_v", "_whole").alias("_hi"))
    per_q = per_q.select("_g", "_qi", (F.col("_lo") + (F.col("_at") - F.floor("_at"))
                                       * (F.col("_hi") - F.col("_lo"))).alias("_val"))
    wide = per_q.groupBy("_g").pivot("_qi", list(range(len(qs)))).agg(F.first("_val"))
    out = stats.join(wide, "_g", "left")
    return out.select(*[F.col("_g")[k].alias(k) for k in keys], "sample_count", "min_value", "max_value",
                      "sum_value", *[F.col(str(i)).alias(n) for i, n in enumerate(names)])


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, qs: Sequence[float],
                      names: Sequence[str] | None = None) -> DataFrame:
    """One row per group with a non-null value: ``keys`` plus one column per quantile."""
    names = list(names) if names else [f"p{int(round(q * 100))}" for q in qs]
    out = exact_summary(df, keys, value, qs, names)
    return out.where(F.col("sample_count") > 0).select(*keys, *names)
