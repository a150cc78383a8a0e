"""Daily chart derived from the driver's ``events`` table.

The given tables hold no songs, so a chart is derived deterministically:
country = event_type, song = user_id % songs (or user_id for the wide
chart), day = ts::date, daily rank by the day's summed value (ties by song),
and 14 audio features computed from a per-(song, country) code ``x``.
Everything is DataFrame code: one partial aggregation (map-side combine)
and one rank per (country, day).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartstreak.schemas import CHART_FIELDS
from chartstreak.session import shared_path

# --- fixed values: fixture rules (shared with the SQL oracles) -------------
NARROW_SONGS = 12                      # song = user_id % 12
COUNTRY_CODE = {"click": 0, "error": 1, "purchase": 2, "signup": 3}  # else 4
# ---------------------------------------------------------------------------


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def daily_song_totals(events: DataFrame, songs: int | None = NARROW_SONGS) -> DataFrame:
    """(country, song, snapshotDate, s): the day's rounded value sum per song."""
    song = (F.col("user_id") % songs) if songs else F.col("user_id")
    return (events
            .groupBy(F.col("event_type").alias("country"), song.alias("song"),
                     F.to_date("ts").alias("snapshotDate"))
            .agg(F.round(F.sum("value"), 2).alias("s")))


GROUP = ["country", "snapshotDate"]
BROADCAST_MAX_PIECES = 1_000_000


def window_rank(totals: DataFrame) -> DataFrame:
    """dailyRank by a window per (country, day): for small, bounded groups."""
    day = Window.partitionBy(*GROUP).orderBy(F.desc("s"), F.asc("song"))
    return totals.withColumn("dailyRank", F.row_number().over(day).cast("int"))


def distributed_rank(totals: DataFrame, broadcast_max_pieces: int = BROADCAST_MAX_PIECES) -> DataFrame:
    """dailyRank without putting a (country, day) group into one task.

    A global sort range-partitions the rows (Spark samples the keys, so one
    huge day is spread over many tasks) and numbers them in order. The
    numbered rows are written once to the shared folder: ``_id`` and
    ``_pid`` are then plain columns, fixed even if executors are lost. A
    rank is the row's offset inside its partition plus the rows of its group
    in earlier partitions. That offset table has one row per (group,
    partition) piece, at most groups + partitions rows; it is written,
    counted and broadcast only under ``broadcast_max_pieces``.
    """
    spark = totals.sparkSession
    numbered_path = shared_path(spark, "chart-numbered")
    (totals.orderBy(F.asc("country"), F.asc("snapshotDate"), F.desc("s"), F.asc("song"))
     .withColumn("_id", F.monotonically_increasing_id())
     .withColumn("_pid", F.spark_partition_id())
     .write.parquet(numbered_path))
    numbered = spark.read.parquet(numbered_path)
    earlier = Window.partitionBy(*GROUP).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    pieces_path = shared_path(spark, "chart-rank-pieces")
    (numbered.groupBy(*GROUP, "_pid")
     .agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
     .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
     .drop("_n")
     .write.parquet(pieces_path))
    pieces = spark.read.parquet(pieces_path)
    if pieces.count() <= broadcast_max_pieces:
        pieces = F.broadcast(pieces)
    return (numbered.join(pieces, [*GROUP, "_pid"])
            .withColumn("dailyRank", (F.col("_before") + F.col("_id") - F.col("_first") + 1).cast("int"))
            .drop("_id", "_pid", "_first", "_before"))


def chart_from_events(events: DataFrame, songs: int | None = NARROW_SONGS) -> DataFrame:
    """The 19-field chart (``schemas.CHART_SCHEMA``) derived from events."""
    totals = daily_song_totals(events, songs)
    # A (country, day) group holds one row per song that day: at most `songs`
    # rows for the narrow chart (a window is fine); for the wide chart, the
    # day's active users, so it is ranked without a per-group window.
    ranked = window_rank(totals) if songs else distributed_rank(totals)
    code = F.lit(4)
    for name, c in sorted(COUNTRY_CODE.items(), key=lambda kv: -kv[1]):
        code = F.when(F.col("country") == name, F.lit(c)).otherwise(code)
    x = F.col("song") * 5 + code
    ranked = ranked.withColumn("x", x)

    def pct(mult):
        return ((x * mult) % 101).cast("double") / 100

    return ranked.select(
        F.concat(F.lit("S"), F.col("song").cast("string")).alias("spotifyId"),
        F.concat(F.lit("Song "), F.col("song").cast("string")).alias("name"),
        F.col("dailyRank"),
        F.col("country"),
        F.col("snapshotDate"),
        (x % 5 == 0).alias("explicit"),
        (F.lit(120000) + (x * 7919) % 180000).cast("bigint").alias("durationMs"),
        pct(37).alias("danceability"),
        pct(53).alias("energy"),
        (x % 12).cast("int").alias("key"),
        (-((x * 31) % 200).cast("double") / 10).alias("loudness"),
        (x % 2).cast("int").alias("mode"),
        pct(29).alias("speechiness"),
        pct(61).alias("acousticness"),
        pct(71).alias("instrumentalness"),
        pct(83).alias("liveness"),
        pct(43).alias("valence"),
        ((F.lit(500) + (x * 97) % 1300).cast("double") / 10).alias("tempo"),
        (F.lit(3) + x % 3).cast("int").alias("timeSignature"),
    ).select(*CHART_FIELDS)


def load_chart(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    events = load_table(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value")
    return chart_from_events(events, None if wide else NARROW_SONGS)


# SQL text of the same fixture, used by the DuckDB oracles.
def chart_sql(wide: bool = False) -> str:
    song = "user_id" if wide else f"user_id % {NARROW_SONGS}"
    cases = " ".join(f"when '{k}' then {v}" for k, v in COUNTRY_CODE.items())
    return f"""
    chart_base as (
      select event_type as country, {song} as song, cast(ts as date) as snapshotDate,
             round(sum(value), 2) as s
      from events group by event_type, {song}, cast(ts as date)),
    chart_ranked as (
      select country, song, snapshotDate,
             row_number() over (partition by country, snapshotDate order by s desc, song) as dailyRank,
             song*5 + case country {cases} else 4 end as x
      from chart_base),
    chart as (
      select concat('S', cast(song as varchar)) as spotifyId,
        concat('Song ', cast(song as varchar)) as name,
        cast(dailyRank as int) as dailyRank, country, snapshotDate,
        x % 5 = 0 as explicit, cast(120000 + (x*7919) % 180000 as bigint) as durationMs,
        cast((x*37) % 101 as double)/100 as danceability, cast((x*53) % 101 as double)/100 as energy,
        cast(x % 12 as int) as key, -cast((x*31) % 200 as double)/10 as loudness, cast(x % 2 as int) as mode,
        cast((x*29) % 101 as double)/100 as speechiness, cast((x*61) % 101 as double)/100 as acousticness,
        cast((x*71) % 101 as double)/100 as instrumentalness, cast((x*83) % 101 as double)/100 as liveness,
        cast((x*43) % 101 as double)/100 as valence, cast(500 + (x*97) % 1300 as double)/10 as tempo,
        cast(3 + x % 3 as int) as timeSignature
      from chart_ranked)"""
