"""Previous-sample lookups and cumulative counter deltas (WN-01).

A counter series is one ``(key..., time)`` ordered sequence. The naive plan is one
window ``partitionBy(key).orderBy(time)``; it puts the whole history of a key in
one task, so a key that holds a third of all rows becomes a third of the job in
one task. ``with_previous`` instead partitions by ``(key, time bucket)`` and gives
the first row of each bucket the last row of the key's latest earlier bucket,
taken from a small carry table (one row per key and bucket) whose rows are
unioned in front of their bucket, so the big input is shuffled exactly once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET_SECONDS = 86_400


def epoch_micros(c: Column | str) -> Column:
    """Microseconds from 1970-01-01 00:00 to a TIMESTAMP_NTZ, whatever the session zone is.

    A TIMESTAMP is read as its local time.
    """
    origin = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    return F.round(seconds_between(c, origin) * F.lit(1e6)).cast("bigint")


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    """``later - earlier`` in seconds as double, whatever the session zone is.

    The subtraction stays in TIMESTAMP_NTZ: a cast to TIMESTAMP would shift the hour
    that a clock change skips.
    """
    later, earlier = (F.col(x) if isinstance(x, str) else x for x in (later, earlier))
    gap = later.cast("timestamp_ntz") - earlier.cast("timestamp_ntz")
    return gap.cast("interval second").cast("decimal(18,6)").cast("double")


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    fields: Sequence[str],
    time_col: str,
    out: str = "prev",
    bucket_seconds: int | None = DEFAULT_BUCKET_SECONDS,
) -> DataFrame:
    """Add struct column ``out`` holding ``fields`` of the previous row of the same key.

    ``order`` is the total order within a key (time first, then tie-breakers);
    the first row of a key gets ``out = null``. With ``bucket_seconds=None`` this
    is a plain ``lag`` over ``partitionBy(keys)``.

    Bucketed plan (default): the last row of every (key, bucket) comes from a grouped
    ``max_by`` with map-side partial aggregation (a small shuffle); a ``lag`` over that
    per-bucket table (one row per bucket, partitioned by key) gives each bucket the
    last row of the key's previous bucket with data. These carry rows are unioned in
    front of their bucket and a single ``lag`` runs over ``partitionBy(key, bucket)``:
    the big input is shuffled once, and a hot key is spread over its buckets. Null
    keys group together, as in a plain window.
    """
    keys = list(keys)
    order = list(order)
    fields = list(fields)
    payload = F.struct(*[F.col(f).alias(f) for f in fields])
    if bucket_seconds is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(out, F.lag(payload).over(w))

    data = df.withColumn("_bkt", F.floor(epoch_micros(time_col) / F.lit(bucket_seconds * 1_000_000)))
    order_struct = F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)])
    last = data.groupBy(*keys, "_bkt").agg(F.max_by(payload, order_struct).alias("_last"))
    wk = Window.partitionBy(*keys).orderBy("_bkt")
    carry = last.select(*keys, "_bkt", F.lag("_last").over(wk).alias("_carry")).where(F.col("_carry").isNotNull())
    data_side = data.select("*", F.lit(1).alias("_src"), F.lit(None).cast(payload_type(df, fields)).alias("_carry"))
    carry_side = carry.select(*keys, "_bkt", F.lit(0).alias("_src"), "_carry")
    merged = data_side.unionByName(carry_side, allowMissingColumns=True)
    w = Window.partitionBy(*keys, "_bkt").orderBy(F.col("_src"), *order)
    prev_payload = F.when(F.col("_src") == 0, F.col("_carry")).otherwise(payload)
    merged = merged.withColumn(out, F.lag(prev_payload).over(w))
    return merged.where(F.col("_src") == 1).drop("_src", "_carry", "_bkt")


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    time_col: str,
    runs: dict[str, Column] | None = None,
    maxima: dict[str, Column] | None = None,
    position: str | None = None,
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
    starts: dict[str, Column] | None = None,
) -> DataFrame:
    """Running values over a key's whole history, with no more than one time bucket of a key in a window.

    ``runs`` adds, per name, how many rows in a row up to this one meet the condition (null counts as false);
    ``starts`` the time of the first of those rows (null on a row that doesn't meet it); ``maxima`` the largest value
    up to this row; ``position`` the row's number within its key, from 1. ``order`` is the order within a key, time
    first.

    Windows run over (key, bucket). What earlier buckets contribute comes from a table of one row per key and bucket,
    joined on that same partitioning. Null keys and null times form groups of their own.
    """
    runs, maxima, starts = runs or {}, maxima or {}, starts or {}
    bucket = F.floor(epoch_micros(time_col) / F.lit(bucket_seconds * 1_000_000))
    # one struct: its equality holds for null fields too
    data = df.withColumn("_kb", F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], bucket.alias("bkt")))
    w = Window.partitionBy("_kb").orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = {f"_c{i}": F.coalesce(c, F.lit(False)) for i, c in enumerate(starts.values())}
    data = data.withColumns({"_rn": F.row_number().over(w), **met,
                             **{f"_p{i}": F.lag(c).over(w) for i, c in enumerate(met.values())}})
    data = data.withColumns({
        **{f"_z{i}": F.max(F.when(~F.coalesce(c, F.lit(False)), F.col("_rn"))).over(upto)
           for i, c in enumerate(runs.values())},
        **{f"_m{i}": F.max(c).over(upto) for i, c in enumerate(maxima.values())},
        # runs that start inside the bucket; whether one starts with its first row, the bucket before it tells
        **{f"_s{i}": F.max(F.when(F.col(f"_c{i}") & ~F.col(f"_p{i}"), F.col(time_col))).over(upto) for i in range(len(starts))}})
    within = Window.partitionBy(*[F.col("_kb")[f"k{i}"] for i in range(len(keys))]).orderBy(F.col("_kb")["bkt"])
    before = (Window.partitionBy(*[F.col("_kb")[f"k{i}"] for i in range(len(keys))]).orderBy(F.col("_kb")["bkt"])
              .rowsBetween(Window.unboundedPreceding, -1))
    ends = data.groupBy("_kb").agg(
        F.max("_rn").alias("_n"), *[F.max(f"_z{i}").alias(f"_z{i}") for i in range(len(runs))],
        *[F.max(f"_m{i}").alias(f"_m{i}") for i in range(len(maxima))],
        *[x for i in range(len(starts)) for x in (
            F.max(f"_s{i}").alias(f"_s{i}"), F.max_by(f"_c{i}", "_rn").alias(f"_l{i}"),
            F.max(F.when((F.col("_rn") == 1) & F.col(f"_c{i}"), F.col(time_col))).alias(f"_f{i}"))])
    ends = ends.withColumns({"_before": F.coalesce(F.sum("_n").over(before), F.lit(0)), **{
        f"_g{i}": F.when(~F.coalesce(F.lag(f"_l{i}").over(within), F.lit(False)), F.col(f"_f{i}")) for i in range(len(starts))}})
    ends = ends.select("_kb", "_before",
                       *[F.max(F.col("_before") + F.col(f"_z{i}")).over(before).alias(f"_cz{i}") for i in range(len(runs))],
                       *[F.max(f"_m{i}").over(before).alias(f"_cm{i}") for i in range(len(maxima))],
                       *[F.greatest(f"_g{i}", F.max(F.greatest(f"_s{i}", f"_g{i}")).over(before)).alias(f"_cs{i}")
                         for i in range(len(starts))])
    pos = F.col("_before") + F.col("_rn")
    return data.join(ends, "_kb").select(
        *df.columns,
        *[(pos - F.coalesce(F.col("_before") + F.col(f"_z{i}"), F.col(f"_cz{i}"), F.lit(0))).alias(name)
          for i, name in enumerate(runs)],
        *[F.greatest(f"_m{i}", f"_cm{i}").alias(name) for i, name in enumerate(maxima)],
        *[F.when(F.col(f"_c{i}"), F.greatest(f"_s{i}", f"_cs{i}")).alias(name) for i, name in enumerate(starts)],
        *([pos.alias(position)] if position else []))


def payload_type(df: DataFrame, fields: Sequence[str]) -> str:
    """DDL of ``struct<fields>`` with the fields' types in ``df``."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return "struct<" + ",".join(f"`{f}`:{types[f]}" for f in fields) + ">"


def counter_delta(
    df: DataFrame,
    keys: Sequence[str],
    counters: Sequence[str],
    time_col: str = "source_collected_at",
    reset_col: str | None = "stats_reset",
    tiebreak: Sequence[str] = (),
    max_gap_seconds: float | None = None,
    bucket_seconds: int | None = DEFAULT_BUCKET_SECONDS,
) -> DataFrame:
    """WN-01: per-key deltas and rates of cumulative counters with reset detection.

    For each counter ``c`` adds ``c_kind`` ('first' | 'reset' | 'gap' | 'delta'),
    ``c_delta`` and ``c_rate`` (per second), plus one ``elapsed_seconds``.

    * first sample of a key: kind 'first', no delta;
    * ``reset_col`` differs from the previous sample (null-safe) or the counter fell:
      kind 'reset', no delta, the value is the new baseline;
    * otherwise delta = value - previous value (an equal value is a zero delta),
      rate = delta / elapsed seconds, and 0 when no time elapsed;
    * with ``max_gap_seconds``, a longer gap gives kind 'gap' and no delta.
    """
    keys = list(keys)
    counters = list(counters)
    order = [time_col, *tiebreak]
    fields = [time_col, *counters] + ([reset_col] if reset_col else [])
    withp = with_previous(df, keys, order, fields, time_col, "_prev", bucket_seconds)
    prev = F.col("_prev")
    elapsed = seconds_between(F.col(time_col), prev[time_col])
    out = withp.withColumn("elapsed_seconds", F.when(prev.isNotNull(), elapsed))
    reset_changed = (
        ~F.col(reset_col).eqNullSafe(prev[reset_col]) if reset_col else F.lit(False)
    )
    cols = []
    for c in counters:
        kind = (
            F.when(prev.isNull(), F.lit("first"))
            .when(reset_changed | (F.col(c) < prev[c]), F.lit("reset"))
        )
        if max_gap_seconds is not None:
            kind = kind.when(F.col("elapsed_seconds") > F.lit(float(max_gap_seconds)), F.lit("gap"))
        kind = kind.otherwise(F.lit("delta"))
        delta = F.when(kind == "delta", F.col(c) - prev[c])
        rate = F.when(
            kind == "delta",
            F.when(F.col("elapsed_seconds") > 0, delta / F.col("elapsed_seconds")).otherwise(F.lit(0.0)),
        )
        cols += [kind.alias(f"{c}_kind"), delta.alias(f"{c}_delta"), rate.alias(f"{c}_rate")]
    return out.select("*", *cols).drop("_prev")
