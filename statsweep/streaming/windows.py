"""Event-time streaming operators (SM-03 to SM-09).

Event time is ``cast(ts as timestamp)`` (watermarks need TIMESTAMP, the landed
columns are TIMESTAMP_NTZ); outputs are cast back to TIMESTAMP_NTZ. Windowed
aggregates run in update mode and are written by ``foreachBatch`` with the batch
id, so a replayed batch rewrites the same rows; readers keep the latest batch per
window (``latest_per_key``). Nothing waits for a window to close, so the last
window of a finite run is complete too.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statsweep.sinks.tables import dedupe_natural_key


WORD_BITS = 62  # panes to a bitmap


def event_time(df: DataFrame, time_col: str, watermark: str | None, out: str = "_et") -> DataFrame:
    d = df.withColumn(out, F.col(time_col).cast("timestamp"))
    return d.withWatermark(out, watermark) if watermark else d


def tumbling_summary(stream: DataFrame, time_col: str, keys: Sequence[str], width: str, aggs: Sequence[Column],
                     watermark: str = "10 minutes") -> DataFrame:
    """SM-04: tumbling-window summaries (15 s, 1 min, 5 min, 1 h ...) per key with a watermark."""
    s = event_time(stream, time_col, watermark)
    g = s.groupBy(F.window("_et", width).alias("w"), *keys).agg(*aggs)
    return g.select(*keys, F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), *[c for c in g.columns
                                                                                if c not in ("w", *keys)])


def sliding_threshold(stream: DataFrame, time_col: str, keys: Sequence[str], value: str, width: str, slide: str,
                      limit: float, panes: int, cadence_s: int, watermark: str = "1 hour") -> DataFrame:
    """SM-05: sliding-window average per key and whether it reaches ``limit``.

    A window of ``width`` holds ``panes`` panes of ``cadence_s`` seconds, and ``slide`` is a whole number of them. The
    flag is raised only when every pane holds a value, as in the batch form (WN-05). Coverage is kept in the state as
    bitmaps: pane numbers of one window differ modulo ``panes``, so a pane's bit needs no look at the window's start.
    """
    s = event_time(stream, time_col, watermark)
    bit = F.pmod(F.floor(F.unix_micros("_et") / F.lit(cadence_s * 1_000_000)), F.lit(panes)).cast("int")
    words = [F.bit_or(F.when(F.col(value).isNotNull() & (F.floor(bit / WORD_BITS) == k),
                             F.expr("shiftleft(1L, _bit)") if panes <= WORD_BITS else F.expr(f"shiftleft(1L, _bit % {WORD_BITS})")))
             for k in range(-(-panes // WORD_BITS))]
    g = s.withColumn("_bit", bit).groupBy(F.window("_et", width, slide).alias("w"), *keys).agg(
        F.avg(value).alias("avg_value"), F.count(value).alias("samples"), *[w.alias(f"_w{k}") for k, w in enumerate(words)])
    covered = sum((F.coalesce(F.bit_count(f"_w{k}"), F.lit(0)) for k in range(len(words))), F.lit(0))
    return g.select(*keys, F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), "avg_value", "samples",
                    covered.alias("covered_panes"),
                    ((covered == F.lit(panes)) & F.coalesce(F.col("avg_value") >= F.lit(limit), F.lit(False))).alias("above_limit"))


def blocking_episodes(stream: DataFrame, time_col: str, keys: Sequence[str], wait_col: str, gap: str,
                      watermark: str = "1 hour", session_col: str = "pid") -> DataFrame:
    """SM-06: one episode per blocked session: first/last seen, samples, longest wait; ends after ``gap``.

    Append mode: an episode is emitted once the watermark passes its end. Samples
    with no blocked session (``session_col`` null) still advance the watermark, as
    the collector keeps sampling when nothing is blocked.
    """
    s = event_time(stream, time_col, watermark)
    g = s.groupBy(F.session_window("_et", gap).alias("w"), *keys).agg(
        F.min(F.col(time_col)).alias("first_seen"), F.max(F.col(time_col)).alias("last_seen"),
        F.count(F.lit(1)).alias("samples"), F.max(wait_col).alias("longest_wait"),
        F.max(F.col(session_col).isNotNull()).alias("_blocked"))
    # Quiet samples form their own (null) sessions, dropped after the aggregation. The filter
    # is on an aggregated flag: a filter on the grouping key would be pushed below the
    # watermark into the scan, and the quiet samples would no longer move event time.
    return g.where(F.col("_blocked")).select(
        *keys, F.col("w.start").cast("timestamp_ntz").alias("episode_start"),
        F.col("w.end").cast("timestamp_ntz").alias("episode_end"), "first_seen", "last_seen", "samples",
        "longest_wait")


def stream_dedupe(stream: DataFrame, keys: Sequence[str], time_col: str, watermark: str = "1 hour") -> DataFrame:
    """SM-07: drop repeated natural keys (buffer replay after an outage) within the watermark."""
    s = event_time(stream, time_col, watermark)
    return s.dropDuplicatesWithinWatermark(list(keys)).drop("_et")


def batch_appender(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` sink: each micro-batch written under ``batch_id=N`` (overwrite = idempotent replay)."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(os.path.join(path, f"batch_id={batch_id}"))

    return write


def latest_per_key(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Read an update-mode sink: the row of the latest batch per key."""
    df = spark.read.parquet(path)
    return dedupe_natural_key(df, keys, [F.col("batch_id").desc()]).drop("batch_id")


COMMITS = "commit_log"
# JSON lines keep whole microseconds and null fields
JSON = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}


def _commit(df: DataFrame, targets: dict[str, Callable[[DataFrame], DataFrame]], root: str, batch_id: int) -> None:
    """Write one batch to every dataset, then note it as committed."""
    for name, build in targets.items():
        build(df).write.mode("overwrite").parquet(os.path.join(root, name, f"batch_id={batch_id}"))
    df.sparkSession.range(1).select(F.lit(batch_id).cast("bigint").alias("batch")).write.mode("overwrite").parquet(
        os.path.join(root, COMMITS, f"batch_id={batch_id}"))


def write_multi(targets: dict[str, Callable[[DataFrame], DataFrame]], root: str,
                fallback: str | None = None) -> Callable[[DataFrame, int], None]:
    """SM-09: one micro-batch to several datasets, all or nothing, each under ``batch_id=N`` (idempotent on replay).

    A batch counts once its note in the commit log stands, which is written after all datasets; :func:`read_committed`
    reads only such batches. When writing a dataset fails, the raw batch goes to JSON lines under ``fallback``, the
    stream goes on, and :func:`replay_fallback` writes the batch again later. Without ``fallback`` the failure stops it.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            _commit(df, targets, root, batch_id)
        except Exception:
            if fallback is None:
                raise
            df.write.mode("overwrite").options(**JSON).json(os.path.join(fallback, f"batch_id={batch_id}"))
        finally:
            df.unpersist()

    return write


def _batches(spark: SparkSession, folder: str) -> set[int]:
    """Numbers of the batches wholly written under ``folder``: one small entry per micro-batch, no rows."""
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(folder, "batch_id=*", "_SUCCESS"))
    found = marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(marker)
    return {int(f.getPath().getParent().getName().split("=")[1]) for f in found or []}


def read_committed(spark: SparkSession, root: str, name: str, schema) -> DataFrame:
    """SM-09: the rows of dataset ``name`` of committed batches, with their ``batch_id``."""
    done = sorted(_batches(spark, os.path.join(root, COMMITS)))
    base = os.path.join(root, name)
    if not done:
        return spark.createDataFrame([], schema).withColumn("batch_id", F.lit(None).cast("int"))
    return spark.read.schema(schema).option("basePath", base).parquet(*[os.path.join(base, f"batch_id={n}") for n in done]).select(
        *spark.createDataFrame([], schema).columns, F.col("batch_id").cast("int").alias("batch_id"))


def replay_fallback(spark: SparkSession, targets: dict[str, Callable[[DataFrame], DataFrame]], root: str, fallback: str, schema) -> list[int]:
    """SM-09: write the batches that went to ``fallback`` and aren't committed to every dataset; returns their numbers.

    Running it again does nothing; a batch that fails again stays where it is and its failure is raised.
    """
    todo = sorted(_batches(spark, fallback) - _batches(spark, os.path.join(root, COMMITS)))
    for batch_id in todo:
        _commit(spark.read.schema(schema).options(**JSON).json(os.path.join(fallback, f"batch_id={batch_id}")), targets, root, batch_id)
    return todo


def late_rows(landed: DataFrame, time_col: str, arrived_col: str, delay_s: float) -> DataFrame:
    """SM-08: rows that arrived later than the watermark delay allows (the stream dropped them)."""
    lag = F.timestamp_diff("MICROSECOND", F.col(time_col), F.col(arrived_col)) / F.lit(1e6)
    return landed.where(lag > F.lit(float(delay_s)))


def late_backfill(summary: DataFrame, landed: DataFrame, late: DataFrame, time_col: str,
                  window_of: Callable[[Column], Column], keys: Sequence[str],
                  recompute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """SM-08: recompute only the windows touched by late rows and replace them in the summary.

    ``window_of`` maps the event time to the window start; ``recompute`` is the batch
    form of the streaming aggregate (same output columns as ``summary``).
    """
    touched = late.select(*keys, window_of(F.col(time_col)).alias("window_start")).distinct()
    src = landed.withColumn("window_start", window_of(F.col(time_col)))
    redo = recompute(src.join(touched, [*keys, "window_start"], "left_semi"))
    kept = summary.join(touched, [*keys, "window_start"], "left_anti")
    return kept.unionByName(redo.select(*summary.columns))
