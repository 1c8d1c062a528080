"""Running file-sourced streams to completion (``availableNow``) with a checkpoint.

Landed samples are the stream: a query reads a landing folder with the file source
and writes to a sink folder; its checkpoint (under the session's
``spark.checkpoint.dir``) records which files were processed and the operator
state, so a rerun after more files land, or after a failure, continues exactly
where it stopped.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from statsweep.session import scratch_path

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class StreamJob:
    """A landing folder, a checkpoint and a sink folder for one stream."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        base = scratch_path(spark, f"stream-{name}")
        self.landing = os.path.join(base, "landing")
        self.checkpoint = os.path.join(base, "checkpoint")
        self.sink = os.path.join(base, "sink")
        self._n = 0

    def land(self, df: DataFrame, fmt: str = "parquet") -> None:
        """Append one landed slice (a new set of files) to the landing folder."""
        self._n += 1
        df.write.mode("append").format(fmt).save(os.path.join(self.landing, f"slice={self._n:05d}"))

    def source(self, schema, fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
        r = self.spark.readStream.format(fmt).schema(schema).option("recursiveFileLookup", "true")
        if max_files:
            r = r.option("maxFilesPerTrigger", max_files)
        return r.load(self.landing)

    def run(self, stream: DataFrame, output_mode: str = "append",
            foreach_batch: Callable[[DataFrame, int], None] | None = None, rocksdb: bool = False) -> None:
        """Process everything landed so far, then stop (trigger ``availableNow``).

        ``rocksdb`` keeps this query's state in the RocksDB store, which ``transformWithState`` needs; the session's
        own setting is left as it was.
        """
        w: DataStreamWriter = stream.writeStream.option("checkpointLocation", self.checkpoint).outputMode(output_mode)
        if foreach_batch is not None:
            w = w.foreachBatch(foreach_batch)
        else:
            w = w.format("parquet").option("path", self.sink)
        before = self.spark.conf.get(STATE_STORE, None)
        if rocksdb:
            self.spark.conf.set(STATE_STORE, ROCKSDB)
        try:
            q = w.trigger(availableNow=True).start()  # the query keeps the settings of its start
        finally:
            if rocksdb and before is None:
                self.spark.conf.unset(STATE_STORE)
            elif rocksdb:
                self.spark.conf.set(STATE_STORE, before)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))

    def result(self, schema=None) -> DataFrame:
        r = self.spark.read
        if schema is not None:
            r = r.schema(schema)
        return r.parquet(self.sink)
