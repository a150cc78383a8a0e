"""Detector and labeller in one stream, over a hits table that grows batch by batch.

The keyed detector passes every chart row on and marks the row that makes its key
a hit. Each micro-batch writes its hits as a version of the hits table named by the
batch id, and labels its rows with the versions committed before it: what a row is
labelled with hangs on the batch it came in, never on timing. Spark starts a batch
only when the one before it is committed, and a replayed batch gets the same rows
and the same keyed state, replaces its own version and output, and reads the same
earlier versions, so it labels alike.

Every ``compact_every`` batches the versions so far become one snapshot, so a long
stream does not read more and more files. The hits are broadcast only under a byte
bound; above it the join shuffles.

Where a key has one row a day, only top rows can change its state: a row behind
``top_n`` would take out its day, which no other row has put in. Such rows go to the
batch beside the detector, so that its work grows with the top rows, not with all.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartstreak.operators.label import BROADCAST_MAX_BYTES, label
from chartstreak.schemas import CHART_FIELDS, CHART_SCHEMA, KEY, LABELLED_SCHEMA, RUN_DAYS, TOP_N
from chartstreak.session import remove_path, shared_path, workers_import_package
from chartstreak.streaming import stream as st

COUNT, LIST = "consecutiveHitDaysCount", "consecutiveHitDaysList"
MARKED_SCHEMA = T.StructType([*CHART_SCHEMA.fields, *[f for f in LABELLED_SCHEMA.fields if f.name in (COUNT, LIST)]])


class RowsAndHits(st.HitStreaks):
    """The detector, passing on every row; the trigger row carries its count and list, other rows null."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = list(rows)
        found = self.detect(frames)
        for f, frame in enumerate(frames):
            counts, lists = [None] * len(frame), [None] * len(frame)
            if found and found[0] == f:
                counts[found[1]], lists[found[1]] = found[2:]
            yield frame[CHART_FIELDS].assign(**{COUNT: pd.array(counts, "Int32"), LIST: pd.Series(
                lists, index=frame.index, dtype=object)})


def marked_stream(stream: DataFrame, top_n: int = TOP_N, run: int = RUN_DAYS, one_row_a_day: bool = False) -> DataFrame:
    """Every chart row; a key's trigger row with its count and list (append mode, needs the RocksDB provider).

    ``one_row_a_day``: the stream holds at most one row of a key and day, so that only
    top rows need the keyed state; without it every row passes the detector.
    """
    workers_import_package(stream.sparkSession)
    rows = stream.select(*CHART_FIELDS)
    behind = F.coalesce(F.col("dailyRank") > top_n, F.lit(False))
    marked = (rows.where(~behind) if one_row_a_day else rows).groupBy(*KEY).transformWithStateInPandas(
        statefulProcessor=RowsAndHits(top_n, run), outputStructType=MARKED_SCHEMA, outputMode="Append", timeMode="None")
    if not one_row_a_day:
        return marked
    return marked.unionByName(rows.where(behind).select(
        "*", *[F.lit(None).cast(MARKED_SCHEMA[c].dataType).alias(c) for c in (COUNT, LIST)]))


class GrowingLabels:
    """The batch function: hits become versions, rows are labelled with the versions before their batch."""

    def __init__(self, spark: SparkSession, root: str, emit: str = "annotate", compact_every: int = 100,
                 broadcast_max_bytes: int = BROADCAST_MAX_BYTES):
        self.spark, self.root, self.emit, self.compact_every = spark, root, emit, compact_every
        self.broadcast_max_bytes = broadcast_max_bytes
        self.hits, self.out = f"{root}/hits", f"{root}/labelled"

    def _numbers(self, kind: str, complete: bool = False) -> list[int]:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.hits)
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        found = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith(f"{kind}=")]
        if complete:
            found = [p for p in found if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(int(p.getName().split("=")[1]) for p in found)

    def known_before(self, batch_id: int) -> DataFrame:
        """Hits of the batches before ``batch_id``: the latest snapshot and the versions behind it."""
        upto = max((n for n in self._numbers("upto", complete=True) if n < batch_id), default=-1)
        paths = [f"{self.hits}/upto={upto}"] if upto >= 0 else []
        paths += [f"{self.hits}/version={n}" for n in self._numbers("version") if upto < n < batch_id]
        if not paths:
            return self.spark.createDataFrame([], LABELLED_SCHEMA)
        return self.spark.read.schema(LABELLED_SCHEMA).parquet(*paths)

    def _compact(self, batch_id: int) -> None:
        """One snapshot for all versions before ``batch_id``; a batch replayed from here on finds it instead of them."""
        done = batch_id - 1
        if done not in self._numbers("upto", complete=True):
            self.known_before(batch_id).write.mode("overwrite").parquet(f"{self.hits}/upto={done}")
        for kind, last in (("version", done), ("upto", done - 1)):
            for n in self._numbers(kind):
                if n <= last:
                    remove_path(self.spark, f"{self.hits}/{kind}={n}")

    def on_batch(self, batch: DataFrame, batch_id: int) -> None:
        staged = f"{self.root}/staged/batchId={batch_id}"
        batch.write.mode("overwrite").parquet(staged)      # the keyed state runs once
        rows = self.spark.read.schema(MARKED_SCHEMA).parquet(staged)
        if batch_id and batch_id % self.compact_every == 0:
            self._compact(batch_id)
        known = self.known_before(batch_id).select(*CHART_FIELDS, COUNT, LIST, "hit")
        size = known.agg(F.sum(F.octet_length(F.to_json(F.struct(*KEY, COUNT, LIST))))).first()[0] or 0
        known = F.broadcast(known) if size <= self.broadcast_max_bytes else known
        label(rows.select(*CHART_FIELDS), known, emit=self.emit, check_size=False).write.mode(
            "overwrite").parquet(f"{self.out}/batchId={batch_id}")
        rows.where(F.col(COUNT).isNotNull()).withColumn("hit", F.lit(True)).write.mode(
            "overwrite").parquet(f"{self.hits}/version={batch_id}")
        remove_path(self.spark, staged)

    def labelled(self) -> DataFrame:
        return self.spark.read.schema(LABELLED_SCHEMA).parquet(f"{self.out}/batchId=*")


def growing_label_stream(spark: SparkSession, stream: DataFrame, top_n: int = TOP_N, run: int = RUN_DAYS,
                         available_now: bool = True, root: str | None = None, one_row_a_day: bool = False,
                         **how) -> tuple[GrowingLabels, object]:
    """Start the stream below ``root`` (outputs and checkpoint; the same root goes on where it stopped)."""
    labels = GrowingLabels(spark, root or shared_path(spark, "growing-labels"), **how)
    writer = marked_stream(stream, top_n, run, one_row_a_day).writeStream.foreachBatch(labels.on_batch).option(
        "checkpointLocation", f"{labels.root}/checkpoint")
    return labels, st._start(writer, available_now)
