"""Streaming: timer windows, sinks, streaming equals batch."""

import datetime as dt
import time

import pandas as pd
import pytest
from hypothesis import given, settings, strategies
from pyspark.sql import functions as F

from chartstreak.operators import streaks
from chartstreak.plans.queries import labelled
from chartstreak.schemas import LABELLED_SCHEMA
from chartstreak.sources.chart import load_chart
from chartstreak.streaming import stream as st

SF001 = "/root/testdata/sf0.001"


class Handle:
    """Stand-in for a processor's handle: state in dictionaries, timers in a list."""

    def __init__(self):
        self.timers, self.maps, self.values = [], {}, {}

    def registerTimer(self, ts):
        self.timers.append(ts)

    def getMapState(self, name, *_):
        return MapState(self.maps.setdefault(name, {}))

    def getValueState(self, name, *_):
        return ValueState(self.values, name)


class MapState:
    def __init__(self, data):
        self.data = data

    def keys(self):
        return list(self.data)

    def getValue(self, key):
        return self.data[key]

    def updateValue(self, key, value):
        self.data[key] = value

    def removeKey(self, key):
        del self.data[key]


class ValueState:
    def __init__(self, data, name):
        self.data, self.name = data, name

    def exists(self):
        return self.name in self.data

    def get(self):
        return self.data[self.name]

    def update(self, value):
        self.data[self.name] = value


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentProcessingTimeInMs(self):
        return self.ms

    def getExpiryTimeInMs(self):
        return self.ms


def drive(arrivals, delay=30_000, until=200_000):
    """Windows that come out when rows arrive as given and every batch hands over rows before timers."""
    processor, handle, out = st.CountryWindows(delay), Handle(), []
    processor.init(handle)
    for now in range(0, until, 1000):
        if now in arrivals:
            frame = pd.DataFrame({"hit": arrivals[now]})
            assert list(processor.handleInputRows(("XX",), iter([frame]), Clock(now))) == []
        for ts in [t for t in handle.timers if t <= now]:
            handle.timers.remove(ts)
            for frame in processor.handleExpiredTimer(("XX",), Clock(now), Clock(ts)):
                out += [tuple(r) for r in frame[["windowEnd", "records", "hits", "gate"]].itertuples(index=False)]
    assert not handle.timers and not any(handle.maps.values())
    return out


def test_windows_follow_the_rows():
    got = drive({0: [True, False], 31_000: [True, True], 40_000: [True]})
    assert got == [(30_000, 2, 1, "TRAIN"), (61_000, 3, 3, "SKIPPED_ONE_CLASS")]


def test_rows_at_the_end_open_the_next_window():
    got = drive({0: [True, False], 30_000: [False, False, True], 90_000: [True]})
    assert got == [(30_000, 2, 1, "TRAIN"), (60_000, 3, 1, "TRAIN")]   # a window of one row emits nothing


def test_timer_windows(spark):
    """T1 exact: per-country processing-time windows, summed, equal the batch counts."""
    st.use_rocksdb(spark)
    lab = labelled(spark, SF001, top_n=10, run=2)
    src = st.write_daily_files(spark, lab)
    windows = st.country_windows(st.file_stream(spark, src, LABELLED_SCHEMA, None), delay_ms=1000)
    q = (windows.writeStream.format("memory").queryName("tw").outputMode("append")
         .trigger(processingTime="1 second").start())
    try:
        expect = {r["country"]: r["records"] for r in lab.groupBy("country")
                  .agg(F.count(F.lit(1)).alias("records")).collect()}
        deadline = time.time() + 120
        got = {}
        while time.time() < deadline:
            time.sleep(2)
            got = {r["country"]: r["n"] for r in spark.sql(
                "select country, sum(records) as n from tw group by country").collect()}
            if got == expect:
                break
        assert got == expect
    finally:
        q.stop()


@settings(max_examples=200, deadline=None)
@given(strategies.lists(strategies.tuples(strategies.integers(0, 12), strategies.booleans()), max_size=40))
def test_runs_are_a_set_of_days(changes):
    day = dt.date(2024, 2, 25)
    runs, days = st.Runs(), set()
    for n, add in changes:
        d = day + dt.timedelta(days=n)
        if add:
            days.add(d)
            a = z = d
            while a - st.DAY in days:
                a -= st.DAY
            while z + st.DAY in days:
                z += st.DAY
            assert runs.add(d) == (z - a).days + 1
        else:
            days.discard(d)
            runs.remove(d)
        assert runs.days() == sorted(days)
        assert all(z + st.DAY < a for z, a in zip(runs.lasts, runs.firsts[1:]))


def test_a_bad_line_fails_the_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for bad in ("not json at all", '{"dailyRank":"abc"}', '{"unknown":1}'):
        (tmp_path / "in" / "x.json").write_text(bad + "\n")
        q = st.file_stream(spark, str(tmp_path / "in")).writeStream.format("noop").trigger(availableNow=True).start()
        with pytest.raises(Exception):
            st.drain(q)


def test_a_replayed_batch_leaves_no_duplicates(spark, tmp_path):
    lab = labelled(spark, SF001, top_n=10, run=2).limit(50)
    seen = []

    class Stream:
        """Captures the batch function instead of running a query."""
        @property
        def writeStream(self):
            return self

        def foreachBatch(self, fn):
            seen.append(fn)
            return self

        def option(self, *_):
            return self

        def trigger(self, **_):
            return self

        def start(self):
            return None
    out, _ = st.country_batches(spark, Stream())
    out2, _ = st.label_stream(spark, Stream(), str(tmp_path / "no-hits-yet"))
    for fn in seen:
        for batch in (0, 1, 1):
            fn(lab, batch)
    assert spark.read.parquet(out).agg(F.sum("records")).first()[0] == 100
    assert spark.read.parquet(out2).count() == 100


def test_hits_that_arrive_between_batches_label_later_rows(spark, tmp_path):
    lab = labelled(spark, SF001, top_n=10, run=2)
    hits = lab.where("hit")
    path = str(tmp_path / "hits")
    assert st.hits_so_far(spark, path).count() == 0
    hits.limit(3).write.parquet(path)
    assert st.hits_so_far(spark, path).count() == 3
    (tmp_path / "broken").write_text("x")
    with pytest.raises(Exception):
        st.hits_so_far(spark, str(tmp_path / "broken")).count()


def test_noop_and_console_sinks(spark):
    """S6 + S7: a discarding sink forces evaluation; console prints a micro-batch."""
    chart = load_chart(spark, SF001)
    streaks.detect_hits(chart, 10, 2).write.format("noop").mode("overwrite").save()
    src = st.write_daily_files(spark, chart)
    q = st.file_stream(spark, src).writeStream.format("console").trigger(availableNow=True).start()
    st.drain(q)


def test_stream_hits_equal_batch(spark):
    st.use_rocksdb(spark)
    chart = load_chart(spark, SF001)
    src = st.write_daily_files(spark, chart)
    out, q = st.stream_to_parquet(spark, st.hit_stream(st.file_stream(spark, src), 10, 2), "t-hits")
    st.drain(q)
    got = sorted((r["country"], r["spotifyId"], list(r["consecutiveHitDaysList"]))
                 for r in spark.read.schema(LABELLED_SCHEMA).parquet(out).collect())
    want = sorted((r["country"], r["spotifyId"], list(r["consecutiveHitDaysList"]))
                  for r in streaks.detect_hits(chart, 10, 2).collect())
    assert got == want and got


def test_stream_hits_one_day_per_batch(spark):
    """Files are taken oldest day first: one file per micro-batch still gives the batch hits."""
    st.use_rocksdb(spark)
    chart = load_chart(spark, SF001)
    src = st.write_daily_files(spark, chart.coalesce(1))
    stream = st.file_stream(spark, src, max_files_per_trigger=1)
    out, q = st.stream_to_parquet(spark, st.hit_stream(stream, 10, 2), "t-hits-1")
    st.drain(q)
    assert len(q.recentProgress) > 1
    cols = ("country", "spotifyId", "snapshotDate", "consecutiveHitDaysCount")
    got = sorted(tuple(r[c] for c in cols) + (list(r["consecutiveHitDaysList"]),)
                 for r in spark.read.schema(LABELLED_SCHEMA).parquet(out).collect())
    want = sorted(tuple(r[c] for c in cols) + (list(r["consecutiveHitDaysList"]),)
                  for r in streaks.detect_hits(chart, 10, 2).collect())
    assert got == want and got
