"""Windows per country in processing time whose rows go to the trainer once.

A country's first row opens a window that ends ``delay_ms`` later; rows join the open
window; the first batch at or after its end hands its rows over and rows that come then
open the next one. Rows wait as files of their batch, partitioned by the end of their
window, so a country that holds a third of all rows waits in as many files as the batch
has tasks, in no task's memory and in no keyed state. What is kept per batch is small:
its time and the open window of each country.

Everything is named by the batch id and replaced by a replay, and the time of a batch is
written before it is used, so a replayed batch opens, fills and fires the same windows.
``train`` must replace its own output per batch id. Rows of fired windows are removed when
the next batch shows that their batch was committed.

Spark calls a batch only when rows arrive; ``with_heartbeat`` adds rows without a country
so that windows fire on time when nothing else comes.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartstreak.session import remove_path, shared_path
from chartstreak.streaming import stream as st

DELAY_MS = 30_000
FOREVER = 1 << 62
OPEN_SCHEMA = "country string, windowEnd long, firstBatch long"


def wall_clock(batch: DataFrame, batch_id: int) -> int:
    return int(time.time() * 1000)


class TrainingWindows:
    """The batch function: (country, windowEnd) windows over labelled rows; ``train(rows, batch_id)`` gets fired ones."""

    def __init__(self, spark: SparkSession, root: str, train: Callable[[DataFrame, int], None],
                 delay_ms: int = DELAY_MS, clock: Callable[[DataFrame, int], int] = wall_clock):
        self.spark, self.root, self.train, self.delay_ms, self.clock = spark, root, train, delay_ms, clock

    def _small(self, name: str, batch_id: int, make=None):
        """A small document of a batch, written once: what a replay finds is what the first attempt saw."""
        sc = self.spark.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}/{batch_id}.json")
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        if not fs.exists(path):
            if make is None:
                return None
            part = sc._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}/_{batch_id}.part")
            out = fs.create(part, True)
            out.write(bytearray(json.dumps(make()).encode()))
            out.close()
            fs.rename(part, path)
        with_in = fs.open(path)
        text = sc._jvm.org.apache.commons.io.IOUtils.toString(with_in, "UTF-8")
        with_in.close()
        return json.loads(text)

    def _open(self, batch_id: int) -> DataFrame:
        if batch_id < 0:
            return self.spark.createDataFrame([], OPEN_SCHEMA)
        return self.spark.read.schema(OPEN_SCHEMA).parquet(f"{self.root}/open/batchId={batch_id}")

    def on_batch(self, batch: DataFrame, batch_id: int, now: int | None = None) -> None:
        now = self._small("clock", batch_id, lambda: self.clock(batch, batch_id) if now is None else now)
        for end, first in self._small("fired", batch_id - 1) or []:
            for earlier in range(first, batch_id):
                remove_path(self.spark, f"{self.root}/rows/batchId={earlier}/windowEnd={end}")
        before = self._open(batch_id - 1)
        due, still = before.where(F.col("windowEnd") <= now), before.where(F.col("windowEnd") > now)
        rows = batch.where(F.col("country").isNotNull())
        new = rows.select("country").distinct().join(still, "country", "left_anti").select(
            "country", F.lit(now + self.delay_ms).alias("windowEnd"), F.lit(batch_id).cast("long").alias("firstBatch"))
        still.union(new).write.mode("overwrite").parquet(f"{self.root}/open/batchId={batch_id}")
        rows.join(self._open(batch_id).drop("firstBatch"), "country").write.mode("overwrite").partitionBy(
            "windowEnd").parquet(f"{self.root}/rows/batchId={batch_id}")
        # windows of one end were opened by one batch; at most one end per batch of the delay
        ends = sorted(tuple(r) for r in due.select("windowEnd", "firstBatch").distinct().collect())
        if ends:
            self.train(self._rows(batch.columns, batch.schema, ends, batch_id), batch_id)
        self._small("fired", batch_id, lambda: ends)

    def _rows(self, columns: list, schema, ends: list, batch_id: int) -> DataFrame:
        schema = T.StructType([*schema.fields, T.StructField("windowEnd", T.LongType())])
        paths = [f"{self.root}/rows/batchId={n}" for n in range(min(first for _, first in ends), batch_id)]
        rows = self.spark.read.option("basePath", f"{self.root}/rows").schema(schema).parquet(*paths)
        return rows.where(F.col("windowEnd").isin([end for end, _ in ends])).select(*columns, "windowEnd")

    def finish(self, schema) -> None:
        """Hand over the windows still open, when a drained stream will bring no more rows."""
        done = 0
        while self._small("fired", done) is not None:
            done += 1
        self.on_batch(self.spark.createDataFrame([], schema), done, now=FOREVER)


def with_heartbeat(stream: DataFrame, per_second: int = 1) -> DataFrame:
    """``stream`` with rows of nulls at a steady rate."""
    beat = stream.sparkSession.readStream.format("rate").option("rowsPerSecond", per_second).load()
    return stream.unionByName(beat.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in stream.schema.fields]))


def training_windows(spark: SparkSession, stream: DataFrame, train, delay_ms: int = DELAY_MS, available_now: bool = False,
                     root: str | None = None, clock=wall_clock, poll: str = "1 second") -> tuple[TrainingWindows, object]:
    """Start the windows over labelled rows below ``root``; with a steady trigger also between arrivals."""
    windows = TrainingWindows(spark, root or shared_path(spark, "training-windows"), train, delay_ms, clock)
    stream = stream if available_now else with_heartbeat(stream)
    writer = stream.writeStream.foreachBatch(windows.on_batch).option(
        "checkpointLocation", f"{windows.root}/checkpoint")
    return windows, st._start(writer, available_now, poll)
