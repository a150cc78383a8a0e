"""T2 for files in any order: the detector behind an event-time reorder buffer.

Rows wait in their key's state until the watermark (the newest day seen less
``lateness``) has passed their day; a timer per (key, day) then hands them to the
detector, which takes a key's rows by day whatever order the files came in. The
buffer of a key holds the rows of at most ``lateness`` days, and of a reported key none.

Late rows: a row whose day the watermark has passed is left out by Spark, as if it had
never come; neither it adds its day nor does it take it out. With a ``lateness`` as long
as files can be late nothing is lost, and the hits are those of the batch detector. The
days behind the last watermark wait for newer rows; ``end_of_days`` gives a row of a song
of its own that releases all of them when an input ends.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessorHandle

from chartstreak.schemas import CHART_FIELDS, CHART_SCHEMA, KEY, LABELLED_SCHEMA, RUN_DAYS, TOP_N
from chartstreak.session import workers_import_package
from chartstreak.streaming import stream as st

EPOCH = dt.date(1970, 1, 1)
DAY_MS = 86_400_000
END = "end of days"
RANK, DAY = CHART_FIELDS.index("dailyRank"), CHART_FIELDS.index("snapshotDate")


class ReorderedStreaks(st.HitStreaks):
    """HitStreaks over rows that wait for the watermark."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.handle = handle
        self.waiting = handle.getListState("waiting", CHART_SCHEMA)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if self.state.exists() and self.state.get()[2]:
            return iter([])
        days = set()
        for frame in rows:
            fresh = list(frame[CHART_FIELDS].astype(object).itertuples(index=False, name=None))
            days.update(r[DAY] for r in fresh)
            self.waiting.appendList(fresh)
        for day in days:
            self.handle.registerTimer((day - EPOCH).days * DAY_MS)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = EPOCH + dt.timedelta(days=expiredTimerInfo.getExpiryTimeInMs() // DAY_MS)
        held = [tuple(r) for r in self.waiting.get()] if self.waiting.exists() else []
        due = [r for r in held if r[DAY] <= passed]
        if not due:
            return
        yield from super().handleInputRows(key, iter([pd.DataFrame(due, columns=CHART_FIELDS)]), timerValues)
        later = [r for r in held if r[DAY] > passed]
        if later and not self.state.get()[2]:
            self.waiting.put(later)
        else:
            self.waiting.clear()


def reordered_hit_stream(stream: DataFrame, lateness: str, top_n: int = TOP_N, run: int = RUN_DAYS) -> DataFrame:
    """T2 whatever order files come in, if none is later than ``lateness`` (such as "3 days")."""
    workers_import_package(stream.sparkSession)
    timed = stream.select(*CHART_FIELDS, F.col("snapshotDate").cast("timestamp").alias("eventTime"))
    return timed.withWatermark("eventTime", lateness).groupBy(*KEY).transformWithStateInPandas(
        statefulProcessor=ReorderedStreaks(top_n, run), outputStructType=LABELLED_SCHEMA,
        outputMode="Append", timeMode="EventTime")


def end_of_days(chart: DataFrame, lateness_days: int) -> DataFrame:
    """One row, far enough behind the newest day that the watermark passes it; its own song never is a hit."""
    last = chart.agg(F.date_add(F.max("snapshotDate"), lateness_days + 1).alias("day"))
    fields = {"country": F.lit(""), "spotifyId": F.lit(END), "name": F.lit(END), "dailyRank": F.lit(2 ** 31 - 1),
              "snapshotDate": F.col("day")}
    zero = {T.StringType(): F.lit(""), T.BooleanType(): F.lit(False)}
    return last.select(*[fields.get(f.name, zero.get(f.dataType, F.lit(0))).cast(f.dataType).alias(f.name)
                         for f in CHART_SCHEMA.fields])
