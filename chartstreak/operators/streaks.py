"""Top-N streaks per (country, song): gaps-and-islands on Spark windows.

Scale notes
-----------
Every operator here first keeps only top rows (rank <= top_n, pushed to the
scan) and collapses them to one row per (key, day) with a partial
aggregation, so a key's window partition is bounded by the number of
distinct days in the data, however many raw rows that key has. All windows
afterwards share the hash partitioning on the key: one exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartstreak.schemas import CHART_FIELDS, KEY, RUN_DAYS, TOP_N
from chartstreak.session import materialise

DATE = "snapshotDate"


def top_rows(chart: DataFrame, top_n: int = TOP_N) -> DataFrame:
    """P5: rows ranked within the top N."""
    return chart.where(F.col("dailyRank") <= top_n)


def _iso(c: str | Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def top_day_rows(chart: DataFrame, top_n: int = TOP_N, keys=KEY,
                 tiebreak: list[str] | None = None) -> DataFrame:
    """One row per (key, day) among top rows: the representative ``rep``
    struct is the row first by ``tiebreak`` (default rank, then name)."""
    tiebreak = tiebreak or ["dailyRank", "name"]
    others = [c for c in CHART_FIELDS if c not in tiebreak]
    rep = F.min(F.struct(*[F.col(c) for c in tiebreak], *[F.col(c) for c in others]))
    return (top_rows(chart, top_n)
            .groupBy(*keys, DATE)
            .agg(rep.alias("rep")))


def top_days(chart: DataFrame, top_n: int = TOP_N, keys=KEY) -> DataFrame:
    """A2 + O1: per key, the sorted distinct set of top-rank days."""
    return (top_rows(chart, top_n)
            .groupBy(*keys)
            .agg(F.array_sort(F.collect_set(DATE)).alias("topDays")))


def islands(days: DataFrame, keys=KEY) -> DataFrame:
    """W5 on one-row-per-(key, day) input: island id and running length.

    ``island = day - row_number()`` is constant along a run of consecutive
    days; ``runLength`` counts days within the island up to the row.
    """
    by_day = Window.partitionBy(*keys).orderBy(DATE)
    in_island = Window.partitionBy(*keys, "island").orderBy(DATE)
    return (days
            .withColumn("island", F.date_sub(F.col(DATE), F.row_number().over(by_day)))
            .withColumn("runLength", F.row_number().over(in_island).cast("int")))


def distinct_top_days(chart: DataFrame, top_n: int = TOP_N, keys=KEY) -> DataFrame:
    return top_rows(chart, top_n).select(*keys, DATE).distinct()


def running_streak(chart: DataFrame, top_n: int = TOP_N, keys=KEY) -> DataFrame:
    """Per (key, top day), the length of the current run ending that day."""
    return islands(distinct_top_days(chart, top_n, keys), keys).drop("island")


def day_gaps(chart: DataFrame, top_n: int = TOP_N, keys=KEY) -> DataFrame:
    """Days between consecutive top days of a key (NULL for the first)."""
    w = Window.partitionBy(*keys).orderBy(DATE)
    return (distinct_top_days(chart, top_n, keys)
            .withColumn("dayGap", F.datediff(F.col(DATE), F.lag(DATE).over(w))))


def longest_streak(chart: DataFrame, top_n: int = TOP_N, keys=KEY) -> DataFrame:
    """A3: per key, the longest run of consecutive top days."""
    return (islands(distinct_top_days(chart, top_n, keys), keys)
            .groupBy(*keys)
            .agg(F.max("runLength").alias("longestStreak"),
                 F.count(F.lit(1)).alias("topDayCount")))


def has_repeated_days(chart: DataFrame, keys=KEY) -> bool:
    """Whether any (key, day) has more than one row (one partial aggregation)."""
    repeated = chart.groupBy(*keys, DATE).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return not repeated.isEmpty()


def detect_hits(chart: DataFrame, top_n: int = TOP_N, run: int = RUN_DAYS, keys=KEY,
                repeated_dates: str | bool = False, order_col: str = DATE) -> DataFrame:
    """W1 + W2 (date order): one row per key whose top-N streak reaches ``run``.

    Rows are taken in date order. The trigger is the top row on the first day
    whose run reaches ``run``; at that moment the longest run is exactly
    ``run``. The row carries all top days up to and including the trigger day.
    Output: the 19 chart fields of the trigger row + consecutiveHitDaysCount,
    consecutiveHitDaysList (ISO strings), hit = true.

    A day that comes twice can retract (W3), which the date-order windows do
    not see: ``repeated_dates=True`` takes ``detect_hits_ordered`` in the order
    of ``order_col``, ``"auto"`` decides by one aggregation. Days that come once
    but in another order than by date go to ``detect_hits_arrival``.
    """
    if repeated_dates is True or (repeated_dates == "auto" and has_repeated_days(chart, keys)):
        return detect_hits_ordered(chart, order_col, top_n, run, keys)
    if order_col != DATE:
        return detect_hits_arrival(chart, order_col, top_n, run, keys)
    days = islands(top_day_rows(chart, top_n, keys), keys)
    whole_key = Window.partitionBy(*keys)
    trigger_day = F.min(F.when(F.col("runLength") == run, F.col(DATE))).over(whole_key)
    upto = (days.withColumn("triggerDay", trigger_day)
            .where(F.col(DATE) <= F.col("triggerDay")))
    hits = (upto.groupBy(*keys)
            .agg(F.max_by("rep", DATE).alias("rep"),
                 F.array_sort(F.collect_list(_iso(DATE))).alias("consecutiveHitDaysList")))
    return hits.select(
        *[F.col(f"rep.{c}").alias(c) if c not in keys else F.col(c) for c in CHART_FIELDS],
        F.lit(run).cast("int").alias("consecutiveHitDaysCount"),
        F.col("consecutiveHitDaysList"),
        F.lit(True).alias("hit"),
    )


# --- arrival order, each day once (W1) ------------------------------------------

def _arrival(order_col: str) -> list[str]:
    """Rows of equal ``order_col`` are taken by (day, rank, name)."""
    return [order_col, *[c for c in (DATE, "dailyRank", "name") if c != order_col]]


def detect_hits_arrival(chart: DataFrame, order_col: str, top_n: int = TOP_N, run: int = RUN_DAYS,
                        keys=KEY) -> DataFrame:
    """W1 + W2 for rows that arrive in the order of ``order_col``, each (key, day) once.

    A stretch is ``run`` consecutive days in a frame of ``run`` rows by date; it is
    complete when the last of its rows has arrived, the largest arrival in the
    frame. The key's trigger is the earliest completion. At that moment the
    longest run may exceed ``run`` (the trigger row can close a gap): it is the
    longest island among the days that had arrived, and all of those are the
    list. Windows share the hash partitioning on the key; nothing is collected
    before the trigger is known. A day that comes twice counts from its first
    top row on; days that can be retracted need ``detect_hits_ordered``.
    """
    order = _arrival(order_col)
    rest = [c for c in CHART_FIELDS if c not in order and c not in keys]
    days = (top_rows(chart, top_n).groupBy(*keys, F.col(DATE).alias("day"))
            .agg(F.min(F.struct(F.struct(*order).alias("at"), F.struct(*rest).alias("rest"))).alias("row")))
    frame = Window.partitionBy(*keys).orderBy("day").rowsBetween(1 - run, 0)
    closed = (F.count(F.lit(1)).over(frame) == run) & (F.datediff("day", F.min("day").over(frame)) == run - 1)
    complete = F.when(closed, F.max("row.at").over(frame))
    # a frame of the whole key in the order of the other windows, so that their sort serves it too
    whole_key = Window.partitionBy(*keys).orderBy("day").rowsBetween(Window.unboundedPreceding,
                                                                     Window.unboundedFollowing)
    arrived = (days.withColumn("complete", complete).withColumn("trigger", F.min("complete").over(whole_key))
               .where(F.col("row.at") <= F.col("trigger")))
    by_day = Window.partitionBy(*keys).orderBy("day")
    runs = (arrived.withColumn("island", F.date_sub("day", F.row_number().over(by_day)))
            .groupBy(*keys, "island")
            .agg(F.count(F.lit(1)).alias("n"), F.collect_list(_iso("day")).alias("days"),
                 F.max_by("row", "row.at").alias("row")))
    hits = runs.groupBy(*keys).agg(F.max("n").alias("n"), F.max_by("row", "row.at").alias("row"),
                                   F.array_sort(F.flatten(F.collect_list("days"))).alias("days"))
    fields = [F.col(c) if c in keys else F.col(f"row.at.{c}").alias(c) if c in order
              else F.col(f"row.rest.{c}").alias(c) for c in CHART_FIELDS]
    return hits.select(*fields, F.col("n").cast("int").alias("consecutiveHitDaysCount"),
                       F.col("days").alias("consecutiveHitDaysList"), F.lit(True).alias("hit"))


# --- general order: repeated days and retraction (W3, O3) ------------------

def _run_around(days: Column, d: Column, run: int) -> Column:
    """Length of the run of consecutive days in ``days`` that holds ``d``.

    No run reached ``run`` before ``d`` came, so only days closer than ``run``
    on either side can belong to it.
    """
    ahead = F.transform(F.filter(days, lambda x: (x > d) & (F.datediff(x, d) < run)), lambda x: F.datediff(x, d))
    behind = F.transform(F.filter(days, lambda x: (x < d) & (F.datediff(d, x) < run)), lambda x: F.datediff(d, x))

    def reach(distances):
        ordered = F.array_sort(distances)
        steps = F.transform(ordered, lambda v, i: v == i + 1)
        return F.coalesce(F.nullif(F.array_position(steps, F.lit(False)), F.lit(0)) - 1, F.size(ordered))
    return (reach(ahead) + reach(behind) + 1).cast("int")


MOST_CHANGES = 10_000


def detect_hits_ordered(chart: DataFrame, order_col: str, top_n: int = TOP_N,
                        run: int = RUN_DAYS, keys=KEY, most_changes: int = MOST_CHANGES) -> DataFrame:
    """W1 + W3 for an arbitrary row order ``order_col`` (days may repeat).

    State per key is the set of top days: a top row adds its day, any other
    row removes its day. The trigger is the first top row after which the
    longest run in the set is >= ``run``; count is that longest run, the list
    is the whole set at that moment. Rows of equal ``order_col`` are taken by
    (day, rank, name); the order column may have any sortable type.

    Only *effective* changes of a (key, day)'s membership can move the
    result (a repeated add finds a set already examined, a removal only
    shrinks it), so rows are first reduced to those changes, each top one
    carrying its row. A key of at most ``most_changes`` changes is folded in one
    row (``_folded``); the changes of any other key stay rows that are spread
    by day (``_spread``). Both give the same hits.
    """
    order = _arrival(order_col)
    rest = [c for c in CHART_FIELDS if c not in order and c not in keys]
    per_day = Window.partitionBy(*keys, DATE).orderBy(*order)
    changes = (chart.withColumn("isTop", F.col("dailyRank") <= top_n)
               .withColumn("prevTop", F.lag("isTop").over(per_day))
               .where(F.when(F.col("prevTop").isNull(), F.col("isTop"))
                      .otherwise(F.col("isTop") != F.col("prevTop"))))
    changes = changes.select(*keys, F.struct(*order).alias("at"), F.col("isTop").alias("top"),
                             F.struct(*rest).alias("rest"))
    # the changes are read twice from here on
    changes = materialise(changes, "changes")
    many = changes.groupBy(*keys).count().where(F.col("count") > most_changes).select(*keys)
    hits = _folded(changes.join(many, keys, "left_anti"), run, keys)
    if not many.isEmpty():
        hits = hits.union(_spread(changes.join(many, keys, "left_semi"), run, keys))
    fields = [F.col(c) if c in keys else F.col(f"at.{c}").alias(c) if c in order
              else F.col(f"rest.{c}").alias(c) for c in CHART_FIELDS]
    return hits.select(*fields, F.col("n").cast("int").alias("consecutiveHitDaysCount"),
                       F.transform(F.array_sort("days"), lambda d: _iso(d)).alias("consecutiveHitDaysList"),
                       F.lit(True).alias("hit"))


def _folded(changes: DataFrame, run: int, keys) -> DataFrame:
    """(keys, at, rest, n, days) of each hit: a fold over the key's changes that looks only at days near the new one."""
    folded = changes.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("at", "top", "rest"))).alias("events"))
    element = folded.schema["events"].dataType.elementType
    init = F.struct(F.array().cast("array<date>").alias("days"), F.lit(None).cast(element).alias("hit"),
                    F.lit(0).alias("count"))

    def step(acc, e):
        day = e["at"][DATE]
        days = F.when(e["top"], F.array_union(acc["days"], F.array(day))).otherwise(F.array_remove(acc["days"], day))
        length = F.when(e["top"], _run_around(days, day, run)).otherwise(F.lit(0))
        fire = length >= run
        return F.when(acc["hit"].isNotNull(), acc).otherwise(F.struct(
            days.alias("days"), F.when(fire, e).alias("hit"), F.when(fire, length).otherwise(F.lit(0)).alias("count")))

    state = folded.select(*keys, F.aggregate("events", init, step).alias("s")).where("s.hit is not null")
    return state.select(*keys, "s.hit.at", "s.hit.rest", F.col("s.count").alias("n"), "s.days")


def _spread(changes: DataFrame, run: int, keys) -> DataFrame:
    """The same without a list per key: each added day asks the days near it for their state at that moment.

    An addition sends a question to each of the ``run - 1`` days on either side;
    a window per (key, day) in arrival order answers with the last change before
    it. The nearest days that answer "not in" bound the run, by partial minima.
    Windows are per (key, day), so one key's changes spread over its days, and
    only additions before the answers are multiplied.
    """
    marks = changes.select(*keys, F.col(f"at.{DATE}").alias("day"), "at", F.lit(None).cast("int").alias("offset"), "top")
    near = F.array(*[F.lit(k) for k in range(1 - run, run) if k])
    asks = marks.where("top").withColumn("offset", F.explode(near)).select(
        *keys, F.date_add("day", F.col("offset")).alias("day"), "at", "offset", F.lit(None).cast("boolean").alias("top"))
    so_far = Window.partitionBy(*keys, "day").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    answers = (marks.union(asks).withColumn("within", F.coalesce(F.last("top", ignorenulls=True).over(so_far), F.lit(False)))
               .where("offset is not null"))
    out = ~F.col("within")
    reach = answers.groupBy(*keys, "at").agg(
        F.coalesce(F.min(F.when(out & (F.col("offset") > 0), F.col("offset"))), F.lit(run)).alias("ahead"),
        F.coalesce(F.min(F.when(out & (F.col("offset") < 0), -F.col("offset"))), F.lit(run)).alias("behind"))
    fired = reach.withColumn("n", F.col("ahead") + F.col("behind") - 1).where(F.col("n") >= run)
    trigger = materialise(fired.groupBy(*keys).agg(F.min(F.struct("at", "n")).alias("trigger")), "triggers")
    upto = changes.join(trigger, keys).where(F.col("at") <= F.col("trigger.at"))
    days = (upto.groupBy(*keys, F.col(f"at.{DATE}").alias("day")).agg(F.max_by("top", "at").alias("top")).where("top")
            .groupBy(*keys).agg(F.collect_list("day").alias("days")))
    rows = upto.where(F.col("at") == F.col("trigger.at")).select(*keys, "at", "rest", F.col("trigger.n").alias("n"))
    return rows.join(days, keys)
