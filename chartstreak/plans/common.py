"""Helpers shared by the registered queries and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartstreak.sources.chart import chart_sql


def flat(df: DataFrame) -> DataFrame:
    """Comparable output: DATE -> ISO text, ARRAY<STRING> -> ','-joined text.

    Both sides of the oracle check use the same convention, so values hash
    the same in Spark and DuckDB.
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DateType):
            cols.append(F.date_format(f.name, "yyyy-MM-dd").alias(f.name))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            cols.append(F.array_join(f.name, ",").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def with_chart(body: str, wide: bool = False, extra: str = "") -> str:
    """``WITH <chart CTEs>[, extra] <body>`` for DuckDB."""
    ctes = chart_sql(wide)
    if extra:
        ctes += ",\n" + extra
    return f"with {ctes}\n{body}"


def chart_cols_sql(alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    names = ["spotifyId", "name", "dailyRank", "country", "snapshotDate", "explicit", "durationMs",
             "danceability", "energy", "key", "loudness", "mode", "speechiness", "acousticness",
             "instrumentalness", "liveness", "valence", "tempo", "timeSignature"]
    return ", ".join(f"cast({p}{n} as varchar) as {n}" if n == "snapshotDate" else f"{p}{n}"
                     for n in names)


def hits_sql(top_n: int, run: int, source: str = "chart") -> str:
    """CTEs ``hits`` (date-order streak detector) over the CTE ``source``."""
    return f"""
    st_top as (select * from {source} where dailyRank <= {top_n}),
    st_isl as (select *, snapshotDate - cast(row_number() over (
                 partition by country, spotifyId order by snapshotDate) as integer) as island
               from st_top),
    st_runs as (select *, row_number() over (
                  partition by country, spotifyId, island order by snapshotDate) as runLength
                from st_isl),
    st_trig as (select *, min(case when runLength = {run} then snapshotDate end) over (
                  partition by country, spotifyId) as triggerDay
                from st_runs),
    st_days as (select country, spotifyId,
                  string_agg(cast(snapshotDate as varchar), ',' order by snapshotDate) as dayList
                from st_trig where snapshotDate <= triggerDay group by country, spotifyId),
    hits as (select t.*, cast({run} as integer) as consecutiveHitDaysCount,
                    d.dayList as consecutiveHitDaysList, true as hit
             from st_trig t join st_days d using (country, spotifyId)
             where t.snapshotDate = t.triggerDay)"""


def labelled_sql(top_n: int, run: int, source: str = "chart") -> str:
    """CTEs ``hits`` and ``labelled`` (final mode, annotate) over ``source``."""
    return hits_sql(top_n, run, source) + f""",
    labelled as (
      select c.*, h.country is not null as hit,
             cast(coalesce(h.consecutiveHitDaysCount, 0) as integer) as consecutiveHitDaysCount,
             coalesce(h.consecutiveHitDaysList, '') as consecutiveHitDaysList
      from {source} c left join (select country, spotifyId, consecutiveHitDaysCount, consecutiveHitDaysList
                                  from hits) h using (country, spotifyId))"""
