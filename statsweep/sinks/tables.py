"""Sinks and table maintenance (SNK-01 to SNK-06).

Writes are columnar appends partitioned by date; re-reads merge schemas so a
dataset can gain columns. De-duplication and the query dictionary are grouped
operations keyed by natural keys.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, TimestampNTZType, TimestampType

# Envelope columns every dataset carries; a dataset column with one of
# these names (ignoring case) is renamed with a suffix instead of replacing it.
ENVELOPE_COLUMNS = ("server_id", "source_collected_at", "collector_received_at", "run_id", "row_ordinal")


def append_dataset(df: DataFrame, path: str, date_col: str = "source_collected_at",
                   partition_col: str = "date") -> None:
    """SNK-01: append rows to a dataset directory partitioned by day; new columns just appear.

    Re-read with ``read_samples`` (``mergeSchema``) to see old and new columns together.
    """
    out = df if partition_col in df.columns else df.withColumn(partition_col, F.to_date(F.col(date_col)))
    out.write.mode("append").partitionBy(partition_col).parquet(path)


def _safe(name: str) -> str:
    s = re.sub(r"[^0-9a-z_]+", "_", name.strip().lower()).strip("_") or "col"
    return f"f_{s}" if s[0].isdigit() else s


def normalized_names(columns: Sequence[str], reserved: Sequence[str] = ENVELOPE_COLUMNS) -> list[str]:
    """SNK-03 naming rule: lower-case safe names, leading digit prefixed ``f_``,
    case-insensitive clashes (and clashes with reserved envelope names) suffixed ``_2``, ``_3`` ..."""
    taken = {r.lower() for r in reserved}
    out = []
    for c in columns:
        base = _safe(c)
        name, i = base, 1
        while name in taken:
            i += 1
            name = f"{base}_{i}"
        taken.add(name)
        out.append(name)
    return out


def normalize_columns(df: DataFrame, reserved: Sequence[str] = ENVELOPE_COLUMNS) -> DataFrame:
    """SNK-03: rename a dataset's own columns by the naming rule (a metadata-only ``toDF``)."""
    return df.toDF(*normalized_names(df.columns, reserved))


def flatten_to_text(df: DataFrame) -> DataFrame:
    """SNK-03 export form: every column as text; timestamps ISO-8601, nested values as JSON."""
    cols: list[Column] = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, (StructType, ArrayType, MapType)):
            c = F.to_json(c)
        else:
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def spill_jsonl(samples: DataFrame, root: str, day_col: str = "SourceCollectedAt") -> None:
    """SNK-04: nested samples (one row per sample, ``Rows`` array) as JSON lines by query id and UTC day."""
    (samples.withColumn("query_id", F.col("QueryId")).withColumn("day", F.to_date(F.col(day_col)))
     .write.mode("append").partitionBy("query_id", "day").json(root))


def nest_samples(rows: DataFrame, sample_keys: dict[str, str], order_col: str, row_cols: Sequence[str]) -> DataFrame:
    """Group flat rows into buffered samples: one row per sample with an ordered ``Rows`` list.

    ``sample_keys`` maps buffered field names (QueryId, ServerId, SourceCollectedAt ...)
    to row columns. Rows are ordered by ``order_col`` so ``row_ordinal`` is stable.
    A sample is one collection result, so its list is bounded by the collector's top-k.
    """
    entry = F.create_map(*[x for c in row_cols for x in (F.lit(c), F.col(c).cast("string"))])
    keys = [F.col(v).alias(k) for k, v in sample_keys.items()]
    lst = F.collect_list(F.struct(F.col(order_col).alias("_o"), entry.alias("_m")))
    by_order = F.array_sort(lst, lambda a, b: F.when(a["_o"] < b["_o"], -1).when(a["_o"] > b["_o"], 1).otherwise(0))
    g = rows.groupBy(*keys).agg(by_order.alias("_rows"))
    return g.select(*sample_keys.keys(), F.transform("_rows", lambda x: x["_m"]).alias("Rows"),
                    F.size("_rows").alias("RowCount"))


def dedupe_natural_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """SNK-05: one row per natural key, the first in ``order`` (e.g. latest received)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def upsert_dictionary(seen: DataFrame, current: DataFrame, keys: Sequence[str], text_col: str, ts_col: str
                      ) -> DataFrame:
    """SNK-06: query/plan dictionary: latest text per key with first and last seen times.

    ``seen`` has ``keys, text, first_seen, last_seen``; ``current`` has ``keys, text, ts``.
    """
    cur = current.select(*keys, F.col(text_col).alias(text_col), F.col(ts_col).alias("first_seen"),
                         F.col(ts_col).alias("last_seen"))
    u = seen.select(*keys, text_col, "first_seen", "last_seen").unionByName(cur)
    return u.groupBy(*keys).agg(F.max_by(text_col, "last_seen").alias(text_col),
                                F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
