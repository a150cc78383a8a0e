"""The chart operators over JSON files arriving in a directory.

* ``file_stream``: text lines decoded strictly with a fixed schema (no
  inference; a bad line fails the query); a processing-time trigger polls the
  directory (30 s in production), ``availableNow`` drains what is there
  (tests, registered queries).
* T1 ``country_batches``: ``foreachBatch`` runs ordinary batch operators per
  micro-batch and country (counts, gates, optionally the ML of ``train``).
  ``CountryWindows`` is the exact processing-time-timer variant.
* T2 ``hit_stream``: ``transformWithStateInPandas`` keyed by (country,
  spotifyId); state = the first and last days of the key's runs of top days and
  a reported flag. Emits each hit once, at its first crossing.
* T3 ``label_stream``: each micro-batch is joined to the hits table as it
  stands (size-checked broadcast).
* T5: no watermark, as in the reference.

A ``foreachBatch`` writes to a folder of its batch id and replaces it, so a
replayed batch leaves no duplicates.

Sinks and checkpoints live below the shared checkpoint folder.
"""

from __future__ import annotations

import bisect
import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from chartstreak.operators import classify
from chartstreak.operators.label import label
from chartstreak.schemas import CHART_FIELDS, CHART_SCHEMA, LABELLED_SCHEMA, RUN_DAYS, TOP_N
from chartstreak.session import materialise, shared_path, workers_import_package
from chartstreak.sources.json_io import JSON_OPTIONS, from_json_lines

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
POLL = "30 seconds"
DAY = dt.timedelta(days=1)


def write_daily_files(spark: SparkSession, rows: DataFrame, path: str | None = None) -> str:
    """Write rows as JSON files in one folder per day, oldest day first.

    One distributed write, partitioned by a copy of ``snapshotDate``. File-stream
    sources take files oldest first by modification time, so each day's
    files are then stamped one second after the previous day's (file
    metadata only, no data passes the driver). A stream over this folder
    thus sees each key's days in order (within a day a key has one row).
    """
    path = path or shared_path(spark, "stream-in")
    (rows.withColumn("day", F.col("snapshotDate")).write.mode("overwrite").partitionBy("day")
     .options(**JSON_OPTIONS).json(path))
    _stamp_days_in_order(spark, path)
    return path


def _stamp_days_in_order(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    day_dirs = sorted((st.getPath() for st in fs.listStatus(root)
                       if st.isDirectory() and st.getPath().getName().startswith("day=")),
                      key=lambda p: p.getName())
    base = int(dt.datetime.now().timestamp() * 1000) - 1000 * (len(day_dirs) + 1)
    for i, d in enumerate(day_dirs):
        for st in fs.listStatus(d):
            name = st.getPath().getName()
            if st.isFile() and not name.startswith((".", "_")):
                fs.setTimes(st.getPath(), base + 1000 * i, -1)


def file_stream(spark: SparkSession, path: str, schema: T.StructType = CHART_SCHEMA,
                max_files_per_trigger: int | None = 200, archive: str | None = None,
                max_file_age: str | None = None) -> DataFrame:
    """New JSON files in ``path`` as a streaming DataFrame, decoded strictly.

    ``archive``: a folder (not below ``path``) to which files go once their batch
    is committed, so that the folder that is listed stays small. ``max_file_age``
    (such as "7d"): how far a file may lie behind the newest one; files that
    come with an older time are left unread, and the source need not remember
    older ones.
    """
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_file_age:
        r = r.option("maxFileAge", max_file_age)
    return from_json_lines(r.text(path).select("value"), schema)


def _start(writer, available_now: bool, poll: str = POLL):
    return (writer.trigger(availableNow=True) if available_now
            else writer.trigger(processingTime=poll)).start()


def drain(query) -> None:
    """Wait for an ``availableNow`` query to finish; raise its error if any."""
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def stream_to_parquet(spark: SparkSession, stream: DataFrame, name: str,
                      available_now: bool = True) -> tuple[str, object]:
    """File sink (append) + checkpoint in the shared folder."""
    out, ckpt = shared_path(spark, f"{name}-out"), shared_path(spark, f"{name}-ckpt")
    q = _start(stream.writeStream.format("parquet").option("path", out)
               .option("checkpointLocation", ckpt).outputMode("append"), available_now)
    return out, q


# --- T1: per-country micro-batches -----------------------------------------

def country_batches(spark: SparkSession, stream: DataFrame, available_now: bool = True,
                    train=None) -> tuple[str, object]:
    """T1 with ``foreachBatch``: each micro-batch is split by country and gated.

    Writes (batchId, country, records, hits, nonHits, gate) per batch;
    ``train(batch_df, batch_id)`` (optional) runs the per-country ML on the
    batch, which is staged once.
    """
    out, ckpt = shared_path(spark, "country-batches-out"), shared_path(spark, "country-batches-ckpt")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        if train is not None:
            batch = materialise(batch, f"batch-{batch_id}")
        classify.training_gate(batch).write.mode("overwrite").parquet(f"{out}/batchId={batch_id}")
        if train is not None:
            train(batch, batch_id)

    q = _start(stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", ckpt), available_now)
    return out, q


class CountryWindows(StatefulProcessor):
    """T1 exact: windows of ``delay_ms`` that open with a country's first row.

    State is a map from a window's end to its two counters (records, hits), so
    a country holding a third of all rows has constant-size state. Spark hands
    a batch's rows over before it fires due timers: rows that come at or after
    the end of the open window open the next one, and each window is emitted
    when its own end fires. Windows of fewer than two rows emit nothing.
    """

    def __init__(self, delay_ms: int = 30_000):
        self.delay_ms = delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getMapState("windows", "end long", "records long, hits long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        flags = [bool(h) for frame in rows for h in frame["hit"]]
        open_ends = [end for (end,) in self.windows.keys() if end > now]
        if open_ends:
            end = open_ends[0]
            records, hits = self.windows.getValue((end,))
        else:
            end, records, hits = now + self.delay_ms, 0, 0
            self.handle.registerTimer(end)
        self.windows.updateValue((end,), (records + len(flags), hits + sum(flags)))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs()
        records, hits = self.windows.getValue((end,))
        self.windows.removeKey((end,))
        if records >= classify.MIN_BATCH:
            gate = classify.TRAIN if 0 < hits < records else classify.SKIPPED_ONE_CLASS
            yield pd.DataFrame({"country": [key[0]], "windowEnd": [end], "records": [records], "hits": [hits],
                                "nonHits": [records - hits], "gate": [gate]})

    def close(self) -> None:
        pass


COUNTRY_WINDOW_SCHEMA = "country string, windowEnd long, records long, hits long, nonHits long, gate string"


def country_windows(stream: DataFrame, delay_ms: int = 30_000) -> DataFrame:
    """T1 exact variant as a streaming DataFrame (needs the RocksDB provider)."""
    workers_import_package(stream.sparkSession)
    return stream.select("country", "hit").groupBy("country").transformWithStateInPandas(
        statefulProcessor=CountryWindows(delay_ms), outputStructType=COUNTRY_WINDOW_SCHEMA,
        outputMode="Append", timeMode="ProcessingTime")


# --- T2: stateful streak detection ------------------------------------------

class Runs:
    """A set of days kept as its runs of consecutive days: sorted first days and their last days."""

    def __init__(self, firsts=(), lasts=()):
        self.firsts, self.lasts = list(firsts), list(lasts)

    def _holder(self, day: dt.date) -> int:
        """Index of the run that holds ``day``, or -1."""
        i = bisect.bisect_right(self.firsts, day) - 1
        return i if i >= 0 and day <= self.lasts[i] else -1

    def add(self, day: dt.date) -> int:
        """Add a day; length of the run that now holds it."""
        i = self._holder(day)
        if i < 0:
            i = bisect.bisect_right(self.firsts, day)
            self.firsts.insert(i, day)
            self.lasts.insert(i, day)
            for left in (i, i - 1):   # join with the run behind, then with the one before
                if 0 <= left < len(self.firsts) - 1 and self.lasts[left] + DAY == self.firsts[left + 1]:
                    self.lasts[left] = self.lasts.pop(left + 1)
                    del self.firsts[left + 1]
            i = self._holder(day)
        return (self.lasts[i] - self.firsts[i]).days + 1

    def remove(self, day: dt.date) -> None:
        i = self._holder(day)
        if i >= 0:
            parts = [(a, z) for a, z in ((self.firsts[i], day - DAY), (day + DAY, self.lasts[i])) if a <= z]
            self.firsts[i:i + 1] = [a for a, _ in parts]
            self.lasts[i:i + 1] = [z for _, z in parts]

    def days(self) -> list[dt.date]:
        return [a + DAY * n for a, z in zip(self.firsts, self.lasts) for n in range((z - a).days + 1)]


class HitStreaks(StatefulProcessor):
    """The streak detector as keyed state (one key = country, spotifyId).

    State is the key's runs of top days. Rows of a key within one micro-batch
    are taken by (day, rank, name): a top row joins its day to the runs beside
    it, any other row takes its day out. The first row whose run reaches
    ``run`` is emitted with that run's length and all top days; afterwards the
    key keeps only its reported flag and skips its rows unread.

    With ``ttl_ms`` a key that got no rows for that long is forgotten, its days
    and its mark alike: within it a hit is emitted once, behind it the key starts anew.
    """

    def __init__(self, top_n: int = TOP_N, run: int = RUN_DAYS, ttl_ms: int | None = None):
        self.top_n, self.run, self.ttl_ms = top_n, run, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("runs", "firsts array<date>, lasts array<date>, reported boolean",
                                          self.ttl_ms)

    def detect(self, frames: list) -> tuple | None:
        """Take the rows in order; (frame, row, run length, top days) of the row that makes the key a hit."""
        firsts, lasts, reported = self.state.get() if self.state.exists() else ([], [], False)
        if reported:
            if self.ttl_ms:      # the mark lives on while rows come
                self.state.update(([], [], True))
            return None
        runs = Runs(firsts or [], lasts or [])
        order = sorted((day, rank, name, f, i) for f, frame in enumerate(frames) for i, (day, rank, name) in enumerate(
            zip(frame["snapshotDate"], frame["dailyRank"], frame["name"])))
        for day, rank, _, f, i in order:
            if rank > self.top_n:
                runs.remove(day)
                continue
            length = runs.add(day)
            if length >= self.run:
                self.state.update(([], [], True))
                return f, i, length, [d.isoformat() for d in runs.days()]
        self.state.update((runs.firsts, runs.lasts, False))
        return None

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = list(rows)
        found = self.detect(frames)
        if found:
            f, i, length, days = found
            hit = frames[f].iloc[[i]].copy()
            hit["consecutiveHitDaysCount"] = length
            hit["consecutiveHitDaysList"] = [days]
            hit["hit"] = True
            yield hit[LABELLED_SCHEMA.fieldNames()]

    def close(self) -> None:
        pass


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def hit_stream(stream: DataFrame, top_n: int = TOP_N, run: int = RUN_DAYS, ttl_ms: int | None = None) -> DataFrame:
    """Hits as a streaming DataFrame (append mode, no watermark; ``ttl_ms``: forget keys without rows, T5)."""
    workers_import_package(stream.sparkSession)
    return stream.groupBy("country", "spotifyId").transformWithStateInPandas(
        statefulProcessor=HitStreaks(top_n, run, ttl_ms), outputStructType=LABELLED_SCHEMA,
        outputMode="Append", timeMode="ProcessingTime" if ttl_ms else "None")


# --- T3: labelling against the hits known so far ----------------------------

def hits_so_far(spark: SparkSession, hits_path: str) -> DataFrame:
    """The hits written so far; none if nothing was written yet. Any other failure is raised."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(hits_path)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return spark.createDataFrame([], LABELLED_SCHEMA)
    return spark.read.schema(LABELLED_SCHEMA).parquet(hits_path)


def label_stream(spark: SparkSession, stream: DataFrame, hits_path: str,
                 available_now: bool = True) -> tuple[str, object]:
    """Label each micro-batch against the hits table at that moment."""
    out, ckpt = shared_path(spark, "label-out"), shared_path(spark, "label-ckpt")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        labelled = label(batch.select(*CHART_FIELDS), hits_so_far(spark, hits_path))
        labelled.write.mode("overwrite").parquet(f"{out}/batchId={batch_id}")

    q = _start(stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", ckpt), available_now)
    return out, q
