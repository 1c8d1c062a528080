"""Time series, phases and sustained rules (WN-04 to WN-10, AG-19 to AG-21, JN-14).

A series is ``keys + time``. Windows hold one time bucket of a series (``deltas.running``,
``deltas.with_previous``), so neither a long history nor a hot series lands in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statsweep.operators.deltas import DEFAULT_BUCKET_SECONDS, epoch_micros, running, seconds_between, with_previous

SERIES = ("resource_id", "metric_id", "dimension_key")


def epoch_seconds(c: str | Column) -> Column:
    return epoch_micros(c) / F.lit(1e6)


def consecutive(df: DataFrame, cond: Column, n: int, keys: Sequence[str] = SERIES, time_col: str = "time_utc",
                out: str = "consecutive") -> DataFrame:
    """WN-04: ``cond`` true on ``n`` samples in a row ending at this one."""
    x = running(df, keys, [time_col], time_col, runs={"_run": cond})
    return x.withColumn(out, F.col("_run") >= n).drop("_run")


def sustained(df: DataFrame, value: str, duration_s: int, cadence_s: int, limit: float,
              keys: Sequence[str] = SERIES, time_col: str = "time_utc", every: bool = False,
              out: str = "sustained") -> DataFrame:
    """WN-05: trailing-range average (or every sample, ``every=True``) at or above ``limit``.

    The range is the ``duration_s / cadence_s`` samples ending here; it passes only with
    full coverage (all of them present), so a series younger than the range never fires.
    Windows hold one time bucket of a series and the rows before it that its ranges reach.
    """
    span = duration_s - cadence_s
    size = max(DEFAULT_BUCKET_SECONDS, 4 * span)
    own = F.floor(F.col("_t") / F.lit(size))
    x = df.withColumn("_t", epoch_seconds(time_col)).withColumn(
        "_bkt", F.explode_outer(F.sequence(own, F.floor((F.col("_t") + F.lit(span)) / F.lit(size)))))
    w = Window.partitionBy(*keys, "_bkt").orderBy("_t").rangeBetween(-span, 0)
    need = duration_s // cadence_s
    stat = F.min(value).over(w) if every else F.avg(value).over(w)
    return x.select("*", stat.alias(f"{out}_value"), F.count(value).over(w).alias(f"{out}_samples")) \
        .where(F.col("_bkt").eqNullSafe(own)).drop("_t", "_bkt") \
        .withColumn(out, (F.col(f"{out}_samples") >= need) & (F.col(f"{out}_value") >= F.lit(limit)))


def trailing_averages(df: DataFrame, averages: dict[str, tuple[str, int]], cadence_s: int,
                      keys: Sequence[str] = SERIES, time_col: str = "time_utc") -> DataFrame:
    """WN-05 for several ranges at once: per name, the average of ``(column, duration_s)`` over the range ending here.

    Time is cut into panes of one cadence. An average is that of all samples in the last ``duration_s / cadence_s``
    panes, this row's included, and null unless each of those panes holds a value. All ranges share one shuffle and
    one sort: windows run over (key, time bucket), with the rows that the longest range reaches copied into the next
    bucket.
    """
    panes = {name: d // cadence_s for name, (_, d) in averages.items()}
    reach = max(panes.values()) - 1
    size = max(DEFAULT_BUCKET_SECONDS // cadence_s, 4 * reach, 1)
    own = F.floor(F.col("_pane") / F.lit(size))
    x = df.withColumn("_pane", F.floor(epoch_micros(time_col) / F.lit(cadence_s * 1_000_000))).withColumn(
        "_bkt", F.explode_outer(F.sequence(own, F.floor((F.col("_pane") + F.lit(reach)) / F.lit(size)))))
    w = Window.partitionBy(*keys, "_bkt").orderBy("_pane")
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    columns = list(dict.fromkeys(c for c, _ in averages.values()))
    # the first value of each pane counts for its coverage
    filled = {c: F.max(F.when(F.col(c).isNotNull(), F.col("_pane"))).over(earlier) for c in columns}
    x = x.withColumns({f"_new{i}": F.when(F.col(c).isNotNull() & (F.coalesce(filled[c], F.col("_pane") - 1) < F.col("_pane")), 1)
                       for i, c in enumerate(columns)})
    span = {name: w.rangeBetween(1 - n, 0) for name, n in panes.items()}
    return x.select("*", *[F.when(F.count(f"_new{columns.index(c)}").over(span[name]) == panes[name],
                                  F.avg(c).over(span[name])).alias(name) for name, (c, _) in averages.items()]) \
        .where(F.col("_bkt").eqNullSafe(own)).drop("_pane", "_bkt", *[f"_new{i}" for i in range(len(columns))])


def breach_runs(df: DataFrame, cond: Column, cadence_s: int, keys: Sequence[str] = SERIES,
                time_col: str = "time_utc") -> DataFrame:
    """WN-06: maximal runs of consecutive breaching samples; a missing sample ends a run.

    Gaps and islands: the cadence slot number minus the row number among breaching
    samples is constant along a run.
    """
    slot = F.floor(epoch_seconds(time_col) / F.lit(cadence_s))
    b = df.where(cond).select(*keys, time_col, slot.alias("_slot"))
    b = running(b, keys, [time_col], time_col, position="_pos").withColumn("_grp", F.col("_slot") - F.col("_pos"))
    return b.groupBy(*keys, "_grp").agg(
        F.min(time_col).alias("run_start"), F.max(time_col).alias("run_end"),
        F.count(F.lit(1)).alias("run_samples")).drop("_grp")


def increasing(df: DataFrame, col: str, n: int, keys: Sequence[str] = SERIES, time_col: str = "time_utc",
               out: str = "increasing") -> DataFrame:
    """WN-07: strictly rising over the last ``n`` samples (n - 1 rises in a row)."""
    tmp = with_previous(df, keys, [time_col], [col], time_col, "_prev")
    tmp = tmp.withColumn("_rise", F.col(col) > F.col("_prev")[col]).drop("_prev")
    return consecutive(tmp, F.col("_rise"), n - 1, keys, time_col, out).drop("_rise")


def vs_baseline(df: DataFrame, baseline: DataFrame, value: str, factor: float, n: int = 2,
                keys: Sequence[str] = SERIES, time_col: str = "time_utc", out: str = "above_baseline") -> DataFrame:
    """WN-08: value above ``factor`` x the same-key baseline for ``n`` samples in a row.

    ``baseline`` has one row per key (``baseline_value``), joined on the key.
    """
    j = df.join(baseline.select(*keys, "baseline_value"), list(keys), "left")
    cond = F.col(value) > F.lit(factor) * F.col("baseline_value")
    return consecutive(j, cond, n, keys, time_col, out)


def stalled(df: DataFrame, progress: str, duration_s: float, keys: Sequence[str], time_col: str,
            active: Column | None = None, out: str = "stalled") -> DataFrame:
    """WN-09: progress unchanged for ``duration_s`` while active.

    The time of the last change is a running max over ``time where changed``; the
    first sample of a key counts as a change.
    """
    tmp = with_previous(df, keys, [time_col], [progress], time_col, "_prev")
    changed = F.col("_prev").isNull() | ~F.col(progress).eqNullSafe(F.col("_prev")[progress])
    tmp = tmp.withColumn("_chg", F.when(changed, F.col(time_col))).drop("_prev")
    tmp = running(tmp, keys, [time_col], time_col, maxima={"last_change_at": F.col("_chg")})
    tmp = tmp.withColumn("unchanged_seconds", seconds_between(time_col, "last_change_at"))
    cond = F.col("unchanged_seconds") >= F.lit(duration_s)
    if active is not None:
        cond = cond & active
    return tmp.withColumn(out, cond).drop("_chg")


def changes(df: DataFrame, col: str, keys: Sequence[str], time_col: str, min_pct: float | None = None,
            out: str = "changed") -> DataFrame:
    """WN-10: value changed against the previous sample (null-safe); numeric form needs ``min_pct`` change."""
    tmp = with_previous(df, keys, [time_col], [col], time_col, "_prev")
    tmp = tmp.select(*df.columns, F.col("_prev")[col].alias("previous_value"), F.col("_prev").isNotNull().alias("_has"))
    has_prev = F.col("_has")
    if min_pct is None:
        cond = has_prev & ~F.col(col).eqNullSafe(F.col("previous_value"))
    else:
        pc = F.when(F.col("previous_value") != 0,
                    F.lit(100.0) * (F.col(col) - F.col("previous_value")) / F.abs(F.col("previous_value")))
        tmp = tmp.withColumn("change_percent", pc)
        cond = has_prev & (F.abs(F.col("change_percent")) >= F.lit(min_pct))
    return tmp.withColumn(out, F.coalesce(cond, F.lit(False))).drop("_has")


def assign_phase(df: DataFrame, phases: DataFrame, ts_col: str, run_cols: Sequence[str] = ()) -> DataFrame:
    """JN-14: attach the phase containing each timestamp, ``start <= ts < end`` (open end = infinity).

    Phases are cut into day buckets and equi-joined on (run keys, bucket), with the range as a filter.
    """
    from statsweep.operators.joins import range_join

    return range_join(df, phases, ts_col, "start_time", "end_time", list(run_cols))


def summarize_series(series: DataFrame, keys: Sequence[str], value: str = "value", exact: bool = True,
                     accuracy: int = 10_000, scale: int = 6) -> DataFrame:
    """AG-19: min, max, avg, P50/P90/P95/P99 and sample count per key (e.g. series and phase).

    ``exact=True``: continuous percentiles (``percentile_cont``) by a distributed sort
    (``functions.quantiles.exact_percentiles``), so no group is buffered in one task.
    ``exact=False``: ``percentile_approx`` in the same aggregation pass, bounded memory per
    group (relative rank error about 1/accuracy).
    """
    qs = [0.5, 0.9, 0.95, 0.99]
    names = [f"p{int(q * 100)}" for q in qs]
    base = [F.min(value).alias("min_value"), F.max(value).alias("max_value"), F.avg(value).alias("_avg"),
            F.count(value).alias("sample_count")]
    if exact:
        from statsweep.functions.quantiles import exact_percentiles

        g = series.groupBy(F.struct(*[F.col(k) for k in keys]).alias("_g")).agg(*base)
        p = exact_percentiles(series, keys, value, qs, names).select(
            F.struct(*[F.col(k) for k in keys]).alias("_g"), *names)
        g = g.join(p, "_g", "left").select(*[F.col("_g")[k].alias(k) for k in keys], "*")
    else:
        pct = F.percentile_approx(value, [*qs], accuracy).cast("array<double>")
        g = series.groupBy(*keys).agg(*base, pct.alias("_p")).select(
            "*", *[F.col("_p")[i].alias(n) for i, n in enumerate(names)])
    return g.select(*keys, "min_value", "max_value", F.round("_avg", scale).alias("avg_value"),
                    *[F.round(n, scale).alias(n) for n in names], "sample_count")


def breach_summary(series: DataFrame, keys: Sequence[str], cadence_s: int, thresholds: Sequence[float] = (70, 80, 90),
                   run_threshold: float = 80, value: str = "value", time_col: str = "time_utc",
                   series_keys: Sequence[str] = SERIES) -> DataFrame:
    """AG-20: minutes at or above each threshold, first and last breach, longest continuous breach.

    ``keys`` are the summary groups (for example series + phase); runs are found on
    ``series_keys`` over time and credited to the group of their first sample.
    """
    minutes = cadence_s / 60.0
    aggs = [(F.count_if(F.col(value) >= F.lit(float(t))) * F.lit(minutes)).alias(f"minutes_at_or_above_{int(t)}")
            for t in thresholds]
    br = F.col(value) >= F.lit(float(run_threshold))
    g = series.groupBy(*keys).agg(*aggs, F.min(F.when(br, F.col(time_col))).alias("first_breach"),
                                  F.max(F.when(br, F.col(time_col))).alias("last_breach"))
    runs = breach_runs(series.select(*set(keys) | set(series_keys) | {time_col, value}), br, cadence_s,
                       list(dict.fromkeys([*series_keys, *[k for k in keys if k not in series_keys]])), time_col)
    longest = runs.groupBy(*keys).agg((F.max("run_samples") * F.lit(minutes)).alias("longest_breach_minutes"))
    return g.join(longest, list(keys), "left").fillna(0.0, subset=["longest_breach_minutes"])


def trend_slope(series: DataFrame, keys: Sequence[str], value: str = "value", time_col: str = "time_utc",
                scale: int = 10) -> DataFrame:
    """AG-21: least-squares slope of value per hour (``regr_slope`` against epoch hours)."""
    hours = epoch_seconds(time_col) / F.lit(3600.0)
    return series.groupBy(*keys).agg(F.round(F.regr_slope(F.col(value), hours), scale).alias("slope_per_hour"),
                                     F.count(value).alias("sample_count"))
