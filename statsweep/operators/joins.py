"""Join operators: labels, range and as-of joins, before/after pairing (JN-01, JN-14 to JN-17).

Every join here is an equi join, so Spark broadcasts a side only under its own byte
threshold and shuffles by key (with AQE's skew handling) otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statsweep.operators.deltas import DEFAULT_BUCKET_SECONDS, epoch_micros

def label(df: DataFrame, dim: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """JN-01: left equi join to a name table (database, role, nation ...).

    Spark broadcasts the name table when its size in bytes is under
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles both sides otherwise.
    """
    return df.join(dim, on, "left")


def range_join(df: DataFrame, intervals: DataFrame, ts_col: str, start_col: str, end_col: str,
               keys: Sequence[str] = (), how: str = "left",
               bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Half-open containment join ``start <= ts < end`` (null end = open) on optional equal ``keys``.

    One plan for all sizes: each interval is exploded to the time buckets that it shares
    with the data's span, and joined on ``(keys, bucket)`` with the range as a residual
    filter. Intervals outside the span, empty ones (``end <= start``) and ones without a
    start match nothing; rows with a null time match nothing. Overlapping intervals give
    one row each. Spark picks broadcast or shuffle by the interval side's size in bytes.
    """
    keys = list(keys)
    bkt = lambda c: F.floor(epoch_micros(c) / F.lit(bucket_seconds * 1_000_000))
    iv = intervals.select(*[F.col(c).alias(f"_iv_{c}") if c in keys else F.col(c) for c in intervals.columns])
    ts, start, end = F.col(ts_col), F.col(start_col), F.col(end_col)
    span = df.agg(F.min(ts_col).alias("_lo"), F.max(ts_col).alias("_hi")).withColumn("_one", F.lit(1))
    live = iv.withColumn("_one", F.lit(1)).join(F.broadcast(span), "_one").where(
        (start <= F.col("_hi")) & (end.isNull() | ((end > start) & (end > F.col("_lo")))))
    first = F.greatest(bkt(start_col), bkt("_lo"))
    last = F.least(bkt(F.coalesce(end, F.col("_hi"))), bkt("_hi"))
    ivb = live.withColumn("_ivb", F.explode(F.sequence(first, last))).drop("_one", "_lo", "_hi")
    d = df.withColumn("_b", bkt(ts_col))
    cond = (F.col("_b") == F.col("_ivb")) & (ts >= start) & (end.isNull() | (ts < end)) & _and(
        [F.col(k).eqNullSafe(F.col(f"_iv_{k}")) for k in keys])
    return d.join(ivb, cond, how).drop("_b", "_ivb", *[f"_iv_{k}" for k in keys])


def _and(conds: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in conds:
        out = out & c
    return out


def align_asof(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str,
               right_fields: Sequence[str], tolerance_s: float | None = None,
               bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """JN-16: for each left row, the latest right row of the same key at or before it.

    Both sides are unioned and tagged; within each (key, time bucket) a running
    ``last(ignorenulls)`` picks the latest right row. A small per-bucket carry table
    (latest right row of the key's earlier buckets) is unioned in front of each
    bucket, so one shuffle of the data by (key, bucket) and one window do the work:
    no inequality join, no join back, and a hot key is split across buckets.
    Of right rows with equal times the one with the greatest ``right_fields`` matches.
    With ``tolerance_s``, a match older than that is dropped (null).
    """
    keys = list(keys)
    rf = list(right_fields)
    rstruct = F.struct(F.col(right_time).alias("_rt"), *[F.col(f) for f in rf])
    bkt = lambda c: F.floor(epoch_micros(c) / F.lit(bucket_seconds * 1_000_000))
    l2 = left.select("*", F.col(left_time).alias("_t"), F.lit(1).alias("_side"),
                     F.lit(None).cast(right.select(rstruct.alias("x")).schema["x"].dataType).alias("_r"),
                     bkt(left_time).alias("_bkt"))
    r2 = right.select(*keys, F.col(right_time).alias("_t"), F.lit(0).alias("_side"), rstruct.alias("_r"),
                      bkt(right_time).alias("_bkt"))
    # carry: latest right row of each (key, bucket), then the latest from strictly earlier buckets
    last_r = r2.groupBy(*keys, "_bkt").agg(F.max_by("_r", F.struct("_t", "_r")).alias("_last"))
    all_b = l2.select(*keys, "_bkt").distinct().unionByName(last_r.select(*keys, "_bkt")).distinct()
    carry = all_b.join(last_r, [*keys, "_bkt"], "left").select(
        *keys, "_bkt",
        F.last("_last", ignorenulls=True).over(
            Window.partitionBy(*keys).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)).alias("_r"))
    # carry rows go first in their bucket (null time, side -1), so one running last() sees them
    carry_rows = carry.where(F.col("_r").isNotNull()).select(
        *keys, "_bkt", F.lit(None).cast(l2.schema["_t"].dataType).alias("_t"), F.lit(-1).alias("_side"), "_r")
    u = l2.unionByName(r2, allowMissingColumns=True).unionByName(carry_rows, allowMissingColumns=True)
    w = (Window.partitionBy(*keys, "_bkt").orderBy(F.col("_t").asc_nulls_first(), "_side", "_r")
         .rowsBetween(Window.unboundedPreceding, 0))
    u = u.withColumn("_m", F.last("_r", ignorenulls=True).over(w)).where(F.col("_side") == 1)
    if tolerance_s is not None:
        age = (epoch_micros("_t") - epoch_micros(F.col("_m._rt"))) / F.lit(1e6)
        u = u.withColumn("_m", F.when(age <= F.lit(float(tolerance_s)), F.col("_m")))
    out_cols = [F.col("_m._rt").alias(f"matched_{right_time}")] + [F.col(f"_m.{f}").alias(f) for f in rf]
    return u.select(*left.columns, *out_cols)


def assign_capacity(df: DataFrame, history: DataFrame, ts_col: str, keys: Sequence[str] = ("server_id",)
                    ) -> DataFrame:
    """JN-15: capacity in force at sample time: ``effective_from <= ts < effective_to`` (open end)."""
    return range_join(df, history, ts_col, "effective_from", "effective_to", keys, "left")


def compare_runs(baseline: DataFrame, after: DataFrame, keys: Sequence[str], metrics: Sequence[str],
                 scale: int = 2) -> DataFrame:
    """JN-17: before/after pairs at the same keys (phase, load) with percentage change per metric."""
    b = baseline.select(*keys, *[F.col(m).alias(f"baseline_{m}") for m in metrics])
    a = after.select(*keys, *[F.col(m).alias(f"after_{m}") for m in metrics])
    j = b.join(a, list(keys), "inner")
    return j.select("*", *[
        F.round(F.when(F.col(f"baseline_{m}") != 0,
                       F.lit(100.0) * (F.col(f"after_{m}") - F.col(f"baseline_{m}")) / F.abs(F.col(f"baseline_{m}"))),
                scale).alias(f"{m}_change_percent") for m in metrics])
