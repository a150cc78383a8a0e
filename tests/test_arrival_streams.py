"""T1-T5 as rows arrive: growing labels, windows that train, reordered days, expiry, archived sources."""

import datetime as dt
import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from chartstreak.operators import classify, streaks
from chartstreak.operators.label import label
from chartstreak.plans.queries import labelled
from chartstreak.plans.stream_queries import arrive
from chartstreak.schemas import CHART_FIELDS, CHART_SCHEMA, LABELLED_SCHEMA
from chartstreak.session import shared_path
from chartstreak.sources.chart import load_chart
from chartstreak.sources.json_io import JSON_OPTIONS
from chartstreak.streaming import growing, reorder, windows
from chartstreak.streaming import stream as st
from test_streaming import Clock, Handle

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def chart(spark):
    st.use_rocksdb(spark)
    return load_chart(spark, SF001).checkpoint(eager=True)


def as_set(df):
    return sorted((r["country"], r["spotifyId"], r["snapshotDate"], r["consecutiveHitDaysCount"],
                   tuple(r["consecutiveHitDaysList"]), r["hit"]) for r in df.collect())


# --- T3 -----------------------------------------------------------------------

def marked(chart, hits):
    """What the keyed detector hands to a batch: every row, trigger rows with count and list."""
    keys = ["country", "spotifyId", "snapshotDate"]
    found = hits.select(*keys, growing.COUNT, growing.LIST)
    return chart.join(found, keys, "left").select(*CHART_FIELDS, growing.COUNT, growing.LIST)


def parts_of(chart):
    days = sorted(r[0] for r in chart.select("snapshotDate").distinct().collect())
    return [chart.where(F.col("snapshotDate").isin(days[i::1][:6])) for i in range(0, len(days), 6)]


@pytest.mark.parametrize("compact_every", [100, 2])
def test_batches_know_the_hits_before_them_and_replays_label_alike(spark, chart, compact_every):
    hits = streaks.detect_hits(chart, 10, 2).checkpoint(eager=True)
    labels = growing.GrowingLabels(spark, shared_path(spark, "growing-test"), compact_every=compact_every)
    parts, want = parts_of(chart), []
    for n, part in enumerate(parts):
        labels.on_batch(marked(part, hits), n)
        first = as_set(spark.read.schema(LABELLED_SCHEMA).parquet(f"{labels.out}/batchId={n}"))
        labels.on_batch(marked(part, hits), n)       # the batch again, after all it wrote
        assert as_set(spark.read.schema(LABELLED_SCHEMA).parquet(f"{labels.out}/batchId={n}")) == first
        before = parts[0].select("snapshotDate").limit(0)
        for earlier in parts[:n]:
            before = before.union(earlier.select("snapshotDate"))
        want += as_set(label(part, hits.join(before.distinct(), "snapshotDate", "left_semi")))
        assert first == sorted(want[len(want) - len(first):])
    assert as_set(labels.labelled()) == sorted(want)
    assert any(r[-1] for r in want) and not all(r[-1] for r in want)
    if compact_every == 2:
        assert len(labels._numbers("version")) <= 3 and len(labels._numbers("upto")) == 1


def test_a_snapshot_cut_short_is_not_read(spark, chart):
    hits = streaks.detect_hits(chart, 10, 2)
    labels = growing.GrowingLabels(spark, shared_path(spark, "growing-cut"))
    labels.on_batch(marked(chart, hits), 0)
    known = labels.known_before(1).count()
    hits.limit(1).write.parquet(f"{labels.hits}/upto=0")
    sc = spark.sparkContext
    success = sc._jvm.org.apache.hadoop.fs.Path(f"{labels.hits}/upto=0/_SUCCESS")
    success.getFileSystem(sc._jsc.hadoopConfiguration()).delete(success, False)
    assert labels.known_before(1).count() == known == hits.count()


def test_growing_labels_go_on_after_a_restart(spark, chart):
    src, root = shared_path(spark, "growing-in"), shared_path(spark, "growing-run")

    def step():
        _, q = growing.growing_label_stream(spark, st.file_stream(spark, src, max_files_per_trigger=None), 10, 2,
                                            root=root)
        st.drain(q)
    week = F.floor(F.datediff("snapshotDate", F.lit("2000-01-01")) / 14).cast("int")
    arrive(chart, week, src, step)
    hits = streaks.detect_hits(chart, 10, 2).withColumn("week", week).select(
        "country", "spotifyId", F.col("week").alias("hitWeek"))
    want = {tuple(r) for r in chart.withColumn("week", week).join(hits, ["country", "spotifyId"]).where(
        "week > hitWeek").select("country", "spotifyId", "snapshotDate").collect()}
    got = growing.GrowingLabels(spark, root).labelled()
    assert got.count() == chart.count()
    assert {(r.country, r.spotifyId, r.snapshotDate) for r in got.where("hit").collect()} == want and want


def test_only_top_rows_take_state_where_a_key_has_one_row_a_day(spark):
    st.use_rocksdb(spark)
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / 60).cast("int"))
    song = F.col("id") % 60
    rank = ((song + F.col("id") / 60 * 3).cast("int") % 60 + 1).cast("int")      # songs fall three ranks a day
    made = {"spotifyId": F.concat(F.lit("S"), song), "name": F.lit("n"), "country": F.lit("c"), "dailyRank": rank,
            "snapshotDate": day}
    chart = spark.range(60 * 8).select(*[made.get(f.name, F.lit(1)).cast(f.dataType).alias(f.name)
                                         for f in CHART_SCHEMA]).checkpoint(eager=True)
    part, labels, state = F.datediff("snapshotDate", F.lit("2024-01-01")), {}, {}
    for one in (False, True):
        src, root = shared_path(spark, "one-in"), shared_path(spark, "one-run")

        def step():
            run, q = growing.growing_label_stream(spark, st.file_stream(spark, src, max_files_per_trigger=None), 10, 2,
                                                  root=root, one_row_a_day=one)
            st.drain(q)
            labels[one], state[one] = run.labelled(), q.lastProgress["stateOperators"][0]["numRowsTotal"]
        arrive(chart, (part / 4).cast("int"), src, step)
    assert as_set(labels[True]) == as_set(labels[False])
    assert labels[True].count() == 480 and 0 < labels[True].where("hit").count() < 480
    top = chart.where("dailyRank <= 10").select("spotifyId").distinct().count()
    assert state[True] == top < state[False] == 60


# --- T1 -----------------------------------------------------------------------

def test_two_windows_of_a_country_train_twice(spark):
    lab = labelled(spark, SF001, top_n=10, run=2).checkpoint(eager=True)
    root, times, seen = shared_path(spark, "windows-test"), [0, 10, 30, 45, 70], []

    def train(rows, batch_id):
        seen.append((batch_id, rows.rdd.getNumPartitions(), sorted(
            (r.country, r.windowEnd, r.records) for r in rows.groupBy("country", "windowEnd").agg(
                F.count("*").alias("records")).collect())))
    w = windows.TrainingWindows(spark, root, train, 30, clock=lambda batch, n: times[n])
    click, view = lab.where("country = 'click'"), lab.where("country = 'view'")
    n_click, n_view = click.count(), view.count()
    w.on_batch(click.repartition(6), 0)              # click until 30
    w.on_batch(lab.where("country in ('click', 'view')"), 1)      # view until 40
    w.on_batch(click, 2)                             # 30: click's first window; these rows open the next, until 60
    w.on_batch(click, 2, now=999)                    # a replay has the time of the first attempt
    w.on_batch(lab.limit(0), 3)                      # 45: view's window, without any row
    w.on_batch(lab.limit(0), 4)                      # 70: click's second window
    assert [s[0] for s in seen] == [2, 2, 3, 4]
    assert seen[0][2] == seen[1][2] == [("click", 30, 2 * n_click)]
    assert seen[2][2] == [("view", 40, n_view)] and seen[3][2] == [("click", 60, n_click)]
    assert seen[0][1] > 1                            # a country's rows are not gathered
    w.finish(LABELLED_SCHEMA)
    assert len(seen) == 4
    rows = spark.read.schema(LABELLED_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{root}/rows")
    assert rows.count() == 0                         # rows of fired windows are gone


def test_windows_fire_without_arrivals(spark):
    """The heartbeat brings a batch when a window ends, though no row comes."""
    src, fired = shared_path(spark, "beat-in"), []
    labelled(spark, SF001, top_n=10, run=2).write.options(**JSON_OPTIONS).json(src)
    _, q = windows.training_windows(
        spark, st.file_stream(spark, src, LABELLED_SCHEMA, None),
        lambda rows, n: fired.extend(r.country for r in classify.training_gate(rows).collect()), delay_ms=2000)
    try:
        deadline = time.time() + 90
        while time.time() < deadline and not fired:
            time.sleep(1)
    finally:
        q.stop()
    assert len(fired) == len(set(fired)) > 1


# --- T2 -----------------------------------------------------------------------

class ListState:
    def __init__(self, data):
        self.data = data

    def exists(self):
        return bool(self.data)

    def get(self):
        return iter(self.data)

    def appendList(self, rows):
        self.data.extend(rows)

    def put(self, rows):
        self.data[:] = rows

    def clear(self):
        self.data.clear()


class ListHandle(Handle):
    def __init__(self):
        super().__init__()
        self.lists = {}

    def getListState(self, name, *_):
        return ListState(self.lists.setdefault(name, []))


def row(day, rank):
    values = {"spotifyId": "s", "name": "n", "dailyRank": rank, "country": "c", "snapshotDate": day, "explicit": False}
    return {f: values.get(f, 0) for f in CHART_FIELDS}


def test_any_file_order_gives_the_hits_of_date_order():
    rng, base = random.Random(2), dt.date(2024, 1, 1)
    for _ in range(60):
        rows = [row(base + dt.timedelta(days=d), rng.randint(1, 14)) for d in range(12) if rng.random() < 0.9]

        def hits(batches, ends):
            processor, handle, out = reorder.ReorderedStreaks(10, 4), ListHandle(), []
            processor.init(handle)
            for batch, watermark in zip(batches, ends):
                if batch:
                    list(processor.handleInputRows(("c", "s"), iter([pd.DataFrame(batch)]), None))
                due = sorted(t for t in set(handle.timers) if t <= (watermark - reorder.EPOCH).days * reorder.DAY_MS)
                handle.timers = [t for t in handle.timers if t not in due]
                rng.shuffle(due)
                for t in due:
                    for frame in processor.handleExpiredTimer(("c", "s"), None, Clock(t)):
                        out += [(r.snapshotDate, r.consecutiveHitDaysCount, tuple(r.consecutiveHitDaysList))
                                for r in frame.itertuples()]
            return out, handle.lists["waiting"]
        mixed = rows[:]
        rng.shuffle(mixed)
        end = base + dt.timedelta(days=40)
        got, left = hits([mixed[:4], mixed[4:8], mixed[8:], []], [base - st.DAY] * 3 + [end])
        assert got == hits([rows, []], [base - st.DAY, end])[0] and left == []
        assert len(got) <= 1


def drain_reordered(spark, src, root, lateness):
    hits = reorder.reordered_hit_stream(st.file_stream(spark, src, max_files_per_trigger=None), lateness, 10, 2)
    st.drain(st._start(hits.writeStream.format("parquet").option("path", f"{root}/out").option(
        "checkpointLocation", f"{root}/checkpoint").outputMode("append"), True))


def test_rows_behind_the_watermark_are_left_out(spark, chart):
    """Days 1-5 come after day 20 with a lateness of 3 days: as if they had never come."""
    src, root = shared_path(spark, "late-in"), shared_path(spark, "late-run")
    first = chart.agg(F.min("snapshotDate")).first()[0]
    day = F.datediff("snapshotDate", F.lit(first))
    part = F.when((day > 5) & (day <= 20), 0).when(day <= 5, 1).otherwise(2)
    arrive(chart.unionByName(reorder.end_of_days(chart, 3)), part, src,
           lambda: drain_reordered(spark, src, root, "3 days"))
    got = as_set(spark.read.schema(LABELLED_SCHEMA).parquet(f"{root}/out"))
    assert got == as_set(streaks.detect_hits(chart.where(day > 5), 10, 2)) and got


# --- T5, S2 ---------------------------------------------------------------------

def test_expired_keys_start_anew_and_marks_live_on_while_rows_come():
    base = dt.date(2024, 1, 1)
    processor, handle = st.HitStreaks(10, 2, ttl_ms=1000), Handle()
    asked = []
    handle.getValueState = lambda name, schema, ttl=None: asked.append(ttl) or Handle.getValueState(handle, name)
    processor.init(handle)
    assert asked == [1000]
    updates = []
    processor.state.update = lambda value: (updates.append(value), handle.values.update(runs=value))

    def take(*days):
        frame = pd.DataFrame([row(base + dt.timedelta(days=d), 1) for d in days])
        return len(list(processor.handleInputRows(("c", "s"), iter([frame]), None)))
    assert [take(0), take(1), take(2), take(3)] == [0, 1, 0, 0]
    assert updates[-2:] == [([], [], True)] * 2      # each row renews the mark's time to live
    handle.values.clear()                            # what the store does when it has passed
    assert [take(10), take(11)] == [0, 1]


def test_state_rows_shrink_after_the_time_to_live(spark, chart):
    src, most, last = shared_path(spark, "ttl-in"), 0, None
    chart.limit(200).coalesce(1).write.options(**JSON_OPTIONS).json(f"{src}/n=0")
    hits = st.hit_stream(st.file_stream(spark, src), 10, 2, ttl_ms=1000)
    q = hits.writeStream.format("noop").option("checkpointLocation", shared_path(spark, "ttl-run")).trigger(
        processingTime="1 second").start()
    try:
        deadline = time.time() + 60
        while time.time() < deadline and not (most and last < most):
            time.sleep(1)
            states = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
            most, last = max([0, *states]), states[-1] if states else None
    finally:
        q.stop()
    assert most and last < most


def test_archived_files_are_neither_lost_nor_read_twice(spark, chart):
    src, done, root = (shared_path(spark, n) for n in ("archive-in", "archive-done", "archive-run"))

    def drain():
        stream = st.file_stream(spark, src, max_files_per_trigger=1, archive=done, max_file_age="7d")
        st.drain(st._start(stream.writeStream.format("parquet").option("path", f"{root}/out").option(
            "checkpointLocation", f"{root}/checkpoint").outputMode("append"), True))

    def files(path):
        sc = spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
        found, names = fs.listFiles(p, True), []
        while found.hasNext():
            name = found.next().getPath().getName()
            names += [name] if name.endswith(".json") else []
        return names
    third = F.pmod(F.xxhash64("spotifyId", "snapshotDate"), F.lit(3))
    for n in range(3):
        chart.where(third == n).repartition(2).write.mode("append").options(**JSON_OPTIONS).json(src)
        drain()
    drain()      # a restart over archived files alone
    out = spark.read.schema(chart.schema).parquet(f"{root}/out")
    assert out.count() == chart.count() == out.distinct().count()
    assert files(done) and len(files(src)) < 6
