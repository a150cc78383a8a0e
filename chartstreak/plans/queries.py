"""Registered queries: one per operator of the inventory, each with its SQL oracle.

Every query reads the driver tables (the chart is derived from ``events``)
and runs over them whole. ``REGISTRY[name] = (build(spark, sf_dir), sql|None)``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartstreak.operators import label as lab
from chartstreak.operators import streaks
from chartstreak.plans.common import chart_cols_sql, flat, hits_sql, with_chart
from chartstreak.schemas import KEY, RUN_DAYS, TOP_N
from chartstreak.sources.chart import NARROW_SONGS, load_chart

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


LABELLED_SQL = chart_cols_sql() + ", consecutiveHitDaysCount, consecutiveHitDaysList, hit"


# --- streaks --------------------------------------------------------------

@register("top_rank_filter", with_chart(f"select {chart_cols_sql()} from chart where dailyRank <= {TOP_N}"))
def q_top_rank_filter(spark, sf_dir):
    return flat(streaks.top_rows(load_chart(spark, sf_dir)))


@register("top_days_per_key", with_chart(
    f"""select country, spotifyId,
          string_agg(distinct cast(snapshotDate as varchar), ',' order by cast(snapshotDate as varchar)) as topDays
        from chart where dailyRank <= {TOP_N} group by country, spotifyId"""))
def q_top_days_per_key(spark, sf_dir):
    days = streaks.top_days(load_chart(spark, sf_dir))
    return days.select(*KEY, F.array_join(F.transform("topDays", lambda d: F.date_format(d, "yyyy-MM-dd")),
                                          ",").alias("topDays"))


_ISLANDS_SQL = f"""
    d_top as (select distinct country, spotifyId, snapshotDate from chart where dailyRank <= {TOP_N}),
    d_isl as (select *, snapshotDate - cast(row_number() over (
                partition by country, spotifyId order by snapshotDate) as integer) as island from d_top),
    d_runs as (select country, spotifyId, snapshotDate, cast(row_number() over (
                 partition by country, spotifyId, island order by snapshotDate) as integer) as runLength
               from d_isl)"""


@register("longest_streak", with_chart(
    """select country, spotifyId, max(runLength) as longestStreak, count(*) as topDayCount
       from d_runs group by country, spotifyId""", extra=_ISLANDS_SQL))
def q_longest_streak(spark, sf_dir):
    return streaks.longest_streak(load_chart(spark, sf_dir))


@register("running_streak", with_chart(
    "select country, spotifyId, cast(snapshotDate as varchar) as snapshotDate, runLength from d_runs",
    extra=_ISLANDS_SQL))
def q_running_streak(spark, sf_dir):
    return flat(streaks.running_streak(load_chart(spark, sf_dir)))


@register("day_gaps", with_chart(
    """select country, spotifyId, cast(snapshotDate as varchar) as snapshotDate,
         cast(snapshotDate - lag(snapshotDate) over (partition by country, spotifyId order by snapshotDate)
              as integer) as dayGap
       from d_top""", extra=_ISLANDS_SQL))
def q_day_gaps(spark, sf_dir):
    return flat(streaks.day_gaps(load_chart(spark, sf_dir)))


@register("hit_detect", with_chart(
    f"select {chart_cols_sql()}, consecutiveHitDaysCount, consecutiveHitDaysList, hit from hits",
    extra=hits_sql(TOP_N, RUN_DAYS)))
def q_hit_detect(spark, sf_dir):
    return flat(streaks.detect_hits(load_chart(spark, sf_dir)))


# --- labelling ------------------------------------------------------------

def _label_sql(mode: str, emit: str, wide: bool = False, top_n: int = TOP_N, run: int = RUN_DAYS) -> str:
    match = "h.country is not null"
    if mode == "causal":
        match += " and c.snapshotDate > h.snapshotDate"
    cols = []
    for n in ["spotifyId", "name", "dailyRank", "country", "snapshotDate", "explicit", "durationMs",
              "danceability", "energy", "key", "loudness", "mode", "speechiness", "acousticness",
              "instrumentalness", "liveness", "valence", "tempo", "timeSignature"]:
        if emit == "replace" and n not in ("country", "spotifyId"):
            expr = f"case when {match} then h.{n} else c.{n} end"
        else:
            expr = f"c.{n}"
        if n == "snapshotDate":
            expr = f"cast({expr} as varchar)"
        cols.append(f"{expr} as {n}")
    cols += [f"cast(case when {match} then h.consecutiveHitDaysCount else 0 end as integer) as consecutiveHitDaysCount",
             f"case when {match} then h.consecutiveHitDaysList else '' end as consecutiveHitDaysList",
             f"coalesce({match}, false) as hit"]
    return with_chart(f"select {', '.join(cols)} from chart c left join hits h using (country, spotifyId)",
                      wide=wide, extra=hits_sql(top_n, run))


def labelled(spark, sf_dir, mode="final", emit="annotate", wide=False, top_n=TOP_N, run=RUN_DAYS):
    chart = load_chart(spark, sf_dir, wide=wide)
    hits = streaks.detect_hits(chart, top_n, run)
    return lab.label(chart, hits, mode=mode, emit=emit)


@register("label_final", _label_sql("final", "annotate"))
def q_label_final(spark, sf_dir):
    return flat(labelled(spark, sf_dir, "final", "annotate"))


@register("label_causal", _label_sql("causal", "annotate"))
def q_label_causal(spark, sf_dir):
    return flat(labelled(spark, sf_dir, "causal", "annotate"))


@register("label_replace", _label_sql("final", "replace"))
def q_label_replace(spark, sf_dir):
    return flat(labelled(spark, sf_dir, "final", "replace"))


# --- general order with restatements (W3) -----------------------------------

def restated_chart(spark, sf_dir):
    """The chart plus a restatement of every row ranked by event count.

    ``seq`` orders arrival: day d's original rows at 2*d, its restatement at
    2*d + 3 (after day d+1's originals), so dates repeat per key and a
    restated rank outside the top N retracts an earlier top day.
    """
    from chartstreak.sources.chart import load_table
    from pyspark.sql import Window

    chart = load_chart(spark, sf_dir)
    ev = load_table(spark, sf_dir, "events")
    counts = (ev.groupBy(F.col("event_type").alias("country"),
                         F.concat(F.lit("S"), (F.col("user_id") % NARROW_SONGS).cast("string")).alias("spotifyId"),
                         F.to_date("ts").alias("snapshotDate"))
              .agg(F.count(F.lit(1)).alias("n")))
    day = Window.partitionBy("country", "snapshotDate").orderBy(F.desc("n"), F.asc("spotifyId"))
    rerank = counts.withColumn("newRank", F.row_number().over(day)).drop("n")
    base = F.datediff("snapshotDate", F.lit("2000-01-01"))
    restated = (chart.join(rerank, ["country", "spotifyId", "snapshotDate"])
                .withColumn("dailyRank", F.col("newRank").cast("int")).drop("newRank")
                .withColumn("seq", base * 2 + 3))
    return chart.withColumn("seq", base * 2).unionByName(restated)


RESTATED_SQL = f"""
    re_counts as (select event_type as country, concat('S', cast(user_id % {NARROW_SONGS} as varchar)) as spotifyId,
                    cast(ts as date) as snapshotDate, count(*) as n
                  from events group by all),
    re_ranks as (select *, cast(row_number() over (partition by country, snapshotDate order by n desc, spotifyId)
                   as integer) as newRank from re_counts),
    restated as (
      select *, 2 * (snapshotDate - date '2000-01-01') as seq from chart
      union all by name
      select c.* replace (r.newRank as dailyRank), 2 * (c.snapshotDate - date '2000-01-01') + 3 as seq
      from chart c join re_ranks r using (country, spotifyId, snapshotDate))"""


def retract_sql(order: str, top_n: int, run: int, rows: str = RESTATED_SQL) -> str:
    """CTEs ``hits``: the fold over ``restated`` one row at a time, as a recursion per key."""
    gap = f"list_min([j for j in range(1, {10 * run}) if not list_contains(days, d {{}} cast(j as integer))]) - 1"
    return rows + f""",
    re_rows as (select *, row_number() over (partition by country, spotifyId order by {order}, snapshotDate,
                  dailyRank, name) as i from restated),
    re_state as (
      select country, spotifyId, 0 as i, cast([] as date[]) as days, cast(null as date) as d, false as top,
        false as fired from re_rows group by all
      union all
      select s.country, s.spotifyId, s.i + 1,
        case when r.dailyRank <= {top_n} then list_distinct(list_append(s.days, r.snapshotDate))
             else list_filter(s.days, lambda x: x <> r.snapshotDate) end,
        r.snapshotDate, r.dailyRank <= {top_n},
        s.fired or (s.top and {gap.format('+').replace('days', 's.days').replace(' d ', ' s.d ')}
                    + {gap.format('-').replace('days', 's.days').replace(' d ', ' s.d ')} + 1 >= {run})
      from re_state s join re_rows r on r.country = s.country and r.spotifyId = s.spotifyId and r.i = s.i + 1
      where not s.fired),
    re_hit as (
      select *, {gap.format('+')} + {gap.format('-')} + 1 as runLength from re_state
      where top and not fired and {gap.format('+')} + {gap.format('-')} + 1 >= {run}),
    hits as (
      select r.*, cast(h.runLength as integer) as consecutiveHitDaysCount,
        array_to_string(list_transform(list_sort(h.days), lambda x: cast(x as varchar)), ',') as consecutiveHitDaysList,
        true as hit
      from re_hit h join re_rows r using (country, spotifyId, i))"""


def _retract(order: str, top_n: int, run: int, rows: str = RESTATED_SQL, wide: bool = False) -> str:
    sql = with_chart(f"select {chart_cols_sql()}, consecutiveHitDaysCount, consecutiveHitDaysList, hit from hits",
                     wide=wide, extra=retract_sql(order, top_n, run, rows))
    return sql.replace("with ", "with recursive ", 1)


@register("hit_detect_retract", _retract("seq", TOP_N, RUN_DAYS))
def q_hit_detect_retract(spark, sf_dir):
    """W1 + W3 + O3 in arrival order with repeated days."""
    return flat(streaks.detect_hits_ordered(restated_chart(spark, sf_dir), "seq"))


@register("hit_detect_retract_spread", _retract("seq", TOP_N, RUN_DAYS))
def q_hit_detect_retract_spread(spark, sf_dir):
    """W1 + W3 + O3 for keys of many changes: the changes stay rows, spread by day."""
    return flat(streaks.detect_hits_ordered(restated_chart(spark, sf_dir), "seq", most_changes=0))


@register("hit_detect_auto", _retract("snapshotDate", TOP_N, 5))
def q_hit_detect_auto(spark, sf_dir):
    """W1 + W3 chosen by the repeated-day check, in date order, runs of 5 days."""
    return flat(streaks.detect_hits(restated_chart(spark, sf_dir), TOP_N, 5, repeated_dates="auto"))


# --- arrival order, each day once (W1) ------------------------------------------

def arriving(chart):
    """The chart with an arrival number ``seq`` that mixes its days; ties are taken by (day, rank, name)."""
    day = F.datediff("snapshotDate", F.lit("2000-01-01"))
    return chart.withColumn("seq", (day * 37 + F.col("dailyRank") * 11) % 101)


ARRIVING_SQL = """
    restated as (select *, ((snapshotDate - date '2000-01-01') * 37 + dailyRank * 11) % 101 as seq from chart)"""


@register("hit_detect_arrival", _retract("seq", TOP_N, RUN_DAYS, ARRIVING_SQL))
def q_hit_detect_arrival(spark, sf_dir):
    """W1 for rows in arrival order: windows over completed stretches, no list per key."""
    return flat(streaks.detect_hits(arriving(load_chart(spark, sf_dir)), order_col="seq"))


@register("hit_detect_arrival_wide", _retract("seq", TOP_N, 2, ARRIVING_SQL, wide=True))
def q_hit_detect_arrival_wide(spark, sf_dir):
    return flat(streaks.detect_hits(arriving(load_chart(spark, sf_dir, wide=True)), TOP_N, 2, order_col="seq"))
