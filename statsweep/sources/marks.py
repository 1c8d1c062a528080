"""Durable high-water marks of incremental reads (SRC-06, SM-03).

A store is a folder on shared storage with the rows of each numbered read (``rows/read_id=N``) and, written after them, the
marks it left (``marks/read_id=N``: one row per key, and one with the place where the first read began). A read counts once its marks stand.
A read that failed halfway is simply run again: it overwrites what it left. A read that stands is not run again but
returned, so a retry adds no row and moves no mark.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statsweep.sources.readers import FIRST_LOOKBACK_MINUTES, LAG_MINUTES, next_high_water, read_incremental


class StaleRead(ValueError):
    """A read whose number is neither the last one's nor the next."""


class MarkStore:
    """Rows read so far and the mark of each key. ``keys`` name the series that advance by themselves."""

    def __init__(self, spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str] = ("server_id",), time_col: str = "end_time"):
        self.spark, self.path, self.schema, self.keys, self.time_col = spark, path, source.schema, list(keys), time_col
        types = {f.name: f.dataType.simpleString() for f in source.schema.fields}
        self.mark_schema = ", ".join([*(f"`{k}` {types[k]}" for k in self.keys), f"high_water {types[time_col]}, is_floor boolean, read_id bigint"])

    def _part(self, kind: str, read_id: int) -> str:
        return os.path.join(self.path, kind, f"read_id={read_id}")

    def marks(self) -> DataFrame:
        """All marks of the reads that stand; the row with ``is_floor`` is where the first read began."""
        empty = self.spark.createDataFrame([], self.mark_schema)
        folder = os.path.join(self.path, "marks")
        jpath = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        if not jpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath):
            return empty
        # a marks folder without its success file is one whose write broke off
        done = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(folder, "read_id=*", "_SUCCESS"))
        found = done.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(done)
        paths = [str(f.getPath().getParent().toString()) for f in found]
        return self.spark.read.schema(self.mark_schema).option("basePath", folder).parquet(*paths) if paths else empty

    def last_read(self) -> int:
        """Number of the last read that stands, 0 without any."""
        return self.marks().agg(F.max("read_id")).first()[0] or 0

    def rows(self) -> DataFrame:
        """The rows of all reads that stand."""
        last = self.last_read()
        if not last:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[self._part("rows", n) for n in range(1, last + 1)])

    def read(self, read_id: int, source: DataFrame, now, lag_minutes: int = LAG_MINUTES, first_lookback_minutes: int = FIRST_LOOKBACK_MINUTES) -> DataFrame:
        """Rows of ``source`` past each key's mark, up to ``lag_minutes`` before ``now``; their marks are kept with them.

        Compare and advance: ``read_id`` must be the next number, or the last one for a retry, which returns the rows
        that it read first. A key without a mark starts where the first read did, so nothing of it is missed. Marks never
        fall: a key's mark is the greatest time read. The marks of a read are a row per key; the rows aren't collected.
        """
        last = self.last_read()
        if read_id == last:
            return self.spark.read.schema(self.schema).parquet(self._part("rows", read_id))
        if read_id != last + 1:
            raise StaleRead(f"read {read_id} after read {last}")
        now = F.lit(now).cast(self.schema[self.time_col].dataType)
        held = self.marks()
        floor = self.spark.range(1).select((now - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(first_lookback_minutes))).alias("_floor"))
        if last:
            floor = held.where("is_floor").agg(F.min("high_water").alias("_floor"))
        marks = held.where("NOT is_floor").groupBy(*[F.col(k).alias(f"_k_{k}") for k in self.keys]).agg(F.max("high_water").alias("_mark"))
        same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in self.keys]
        on = same[0]
        for more in same[1:]:
            on = on & more
        past = source.join(marks, on, "left").crossJoin(F.broadcast(floor)).withColumn("_mark", F.coalesce("_mark", "_floor"))  # one row
        new = read_incremental(past, F.col("_mark"), now, self.time_col, lag_minutes).select(*source.columns)
        new.write.mode("overwrite").parquet(self._part("rows", read_id))
        new = self.spark.read.schema(self.schema).parquet(self._part("rows", read_id))
        ahead = next_high_water(new, self.time_col, self.keys).withColumn("is_floor", F.lit(False))
        begin = floor.select(*[F.lit(None).cast(self.schema[k].dataType).alias(k) for k in self.keys], F.col("_floor").alias("high_water"), F.lit(True).alias("is_floor"))
        ahead.unionByName(begin).write.mode("overwrite").parquet(self._part("marks", read_id))
        return new
