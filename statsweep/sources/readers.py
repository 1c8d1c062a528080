"""Sources (SRC-01 to SRC-08): reading landed samples and shaping them into datasets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_samples(spark: SparkSession, path: str, schema: StructType | str | None = None,
                 fmt: str = "parquet", dates: tuple[str, str] | None = None) -> DataFrame:
    """SRC-01: landed snapshot rows of one dataset with a declared schema.

    ``dates`` (inclusive ISO days) filters the ``date`` partition column so the scan
    prunes partitions; with ``schema`` nothing is inferred and no footer is read for it.
    """
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    elif fmt == "parquet":  # no declared schema: the union of all files' columns, which reads every footer
        r = r.option("mergeSchema", "true")
    df = r.load(path)
    if dates is not None:
        df = df.where(F.col("date").between(F.lit(dates[0]).cast("date"), F.lit(dates[1]).cast("date")))
    return df


def union_databases(frames: Mapping[str, DataFrame], col: str = "database_name") -> DataFrame:
    """SRC-02: one dataset from per-database scans; names trimmed, de-duplicated ignoring case."""
    seen: dict[str, tuple[str, DataFrame]] = {}
    for name, df in frames.items():
        key = name.strip().lower()
        if key and key not in seen:
            seen[key] = (name.strip(), df)
    out = None
    for name, df in seen.values():
        tagged = df.withColumn(col, F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    if out is None:
        raise ValueError("no databases")
    return out


def union_tagged(frames: Mapping[str, DataFrame], tag_col: str) -> DataFrame:
    """SRC-03: differently shaped result sets stacked with a discriminator column."""
    out = None
    for tag, df in frames.items():
        tagged = df.withColumn(tag_col, F.lit(tag))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    if out is None:
        raise ValueError("no inputs")
    return out


BUFFERED_SAMPLE_SCHEMA = (
    "QueryId string, ServerId string, Note string, SourceCollectedAt timestamp, "
    "CollectorReceivedAt timestamp, RowCount int, Rows array<map<string,string>>"
)


def replay_buffer(spark: SparkSession, path: str, stored: DataFrame | None = None) -> DataFrame:
    """SRC-04: spilled JSON-lines samples to rows; ``row_ordinal`` is the position in ``Rows``.

    Samples whose ``(query_id, server_id, source_collected_at)`` is already in ``stored``
    are dropped with an anti join.
    """
    raw = spark.read.schema(BUFFERED_SAMPLE_SCHEMA).json(path)
    rows = raw.select(
        F.col("QueryId").alias("query_id"),
        F.col("ServerId").alias("server_id"),
        F.col("SourceCollectedAt").alias("source_collected_at"),
        F.col("CollectorReceivedAt").alias("collector_received_at"),
        F.col("Note").alias("note"),
        F.posexplode_outer("Rows").alias("row_ordinal", "row"),
    )
    if stored is not None:
        keys = ["query_id", "server_id", "source_collected_at"]
        rows = rows.join(stored.select(*keys).distinct(), keys, "left_anti")
    return rows


def json_field(payload: Column, field: str, dtype: str) -> Column:
    """A typed JSON field; absent or empty gives null, integer fields accept truncated decimals."""
    s = F.nullif(F.get_json_object(payload, f"$.{field}"), F.lit(""))
    if dtype in ("long", "bigint", "int", "integer"):
        return F.coalesce(s.try_cast("long"), s.try_cast("double").try_cast("long")).cast(dtype)
    return s.try_cast(dtype)


def unpack_payload(df: DataFrame, col: str, fields: Mapping[str, str]) -> DataFrame:
    """SRC-05: pull typed fields out of a JSON payload column; absent field -> null."""
    p = F.col(col)
    return df.select("*", *[json_field(p, f, t).alias(f) for f, t in fields.items()])


# Minutes until a closed window is stored, and how far back the first read starts.
LAG_MINUTES = 2
FIRST_LOOKBACK_MINUTES = 17


def read_incremental(df: DataFrame, high_water, now, time_col: str = "end_time",
                     lag_minutes: int = LAG_MINUTES, first_lookback_minutes: int = FIRST_LOOKBACK_MINUTES) -> DataFrame:
    """SRC-06: rows with ``high_water < end_time <= now - lag``; the first read starts 17 min back."""
    now_c = F.lit(now) if not isinstance(now, Column) else now
    upper = now_c - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(lag_minutes))
    if high_water is None:
        lower = now_c - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(first_lookback_minutes))
    else:
        lower = F.lit(high_water) if not isinstance(high_water, Column) else high_water
    t = F.col(time_col)
    return df.where((t > lower) & (t <= upper))


def next_high_water(df: DataFrame, time_col: str = "end_time", keys: Sequence[str] = ()) -> DataFrame:
    """SRC-06: the new mark is the greatest ``end_time`` read, per key (one row without keys)."""
    return df.groupBy(*keys).agg(F.max(time_col).alias("high_water"))


def read_minute_metrics(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """SRC-07: one-minute series keyed (resource_id, metric_id, dimension_key, time_utc); one row per key."""
    from statsweep.sinks.tables import dedupe_natural_key

    df = spark.read.format(fmt).schema(
        "resource_id string, metric_id string, dimension_key string, time_utc timestamp_ntz, "
        "value double, ingested_at timestamp_ntz").load(path)
    return dedupe_natural_key(df, ["resource_id", "metric_id", "dimension_key", "time_utc"],
                              [F.col("ingested_at").desc_nulls_last()])


def phase_intervals(markers: DataFrame, run_col: str = "test_run_id", start_col: str = "start_time",
                    end_col: str = "end_time") -> DataFrame:
    """SRC-08: point markers to half-open phases ``[start, next start)``; the last phase stays open."""
    w = Window.partitionBy(run_col).orderBy(start_col)
    return markers.withColumn(end_col, F.lead(start_col).over(w))
