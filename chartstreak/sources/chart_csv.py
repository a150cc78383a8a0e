"""Write the derived chart as position-addressed CSV (ingest fixture).

``chart_csv_lines(chart, corrupt=False)`` renders each chart row as one CSV
line with 25 columns (the six unread columns carry derived text). With
``corrupt=True`` each row gets one deterministic defect chosen by
``defect_code`` (a function of its rank and day), covering the malformed
corpus: blanks, short/long rows, broken quotes, bad numbers and dates,
Java-style booleans, NaN/inf, padding that trim removes, and empty lines.
The SQL oracles restate the expected outcome per code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartstreak.session import shared_path

# --- fixed values: corpus layout --------------------------------------------
N_CODES = 20
HEADER = ("spotify_id,name,artists,daily_rank,daily_movement,weekly_movement,country,"
          "snapshot_date,popularity,is_explicit,duration_ms,album_name,album_release_date,"
          "danceability,energy,key,loudness,mode,speechiness,acousticness,instrumentalness,"
          "liveness,valence,tempo,time_signature")
# code -> (what the line gets, counted valid, parsed)
DEFECTS = {
    0: ("name with a comma, quoted", True, True),
    1: ("name with doubled quotes, quoted", True, True),
    2: ("unread column 2 empty", False, False),
    3: ("unread column 4 is a quoted blank", False, False),
    4: ("unread column 5 is a tab", False, False),
    5: ("24 columns", True, False),
    6: ("26 columns", True, True),
    7: ("26 columns, the last blank", False, False),
    8: ("unterminated quote in column 8", False, False),
    9: ("dailyRank '<n>.0' (odd rank) or 2147483648 (even rank)", True, False),
    10: ("dailyRank ' +<n> '", True, True),
    11: ("date without zero padding", True, False),
    12: ("isExplicit 'TRUE' / 'yes'", True, True),
    13: ("danceability 'inf'", True, False),
    14: ("danceability 'NaN'", True, True),
    15: ("empty line", False, False),
    16: ("name padded with a tab and blanks", True, True),
    17: ("unterminated quote in the last column", False, False),
    18: ("clean", True, True),
    19: ("clean", True, True),
}
# ---------------------------------------------------------------------------


def defect_code(rank: Column, day: Column) -> Column:
    return (rank * 7 + F.dayofmonth(day)) % N_CODES


def defect_code_sql() -> str:
    return f"((dailyRank * 7 + dayofmonth(snapshotDate)) % {N_CODES})"


def _s(c) -> Column:
    return c.cast("string")


def chart_csv_lines(chart: DataFrame, corrupt: bool = False) -> DataFrame:
    """One ``value`` line per chart row (plus nothing else)."""
    code = defect_code(F.col("dailyRank"), F.col("snapshotDate")) if corrupt else F.lit(-1)

    def pick(default: Column, *cases: tuple[int, Column]) -> Column:
        out = default
        for k, v in cases:
            out = F.when(code == k, v).otherwise(out)
        return out

    q = F.lit('"')
    name = pick(F.col("name"),
                (0, F.concat(q, F.col("name"), F.lit(', Live'), q)),
                (1, F.concat(q, F.col("name"), F.lit(' ""x""'), q)),
                (16, F.concat(F.lit("\t"), F.col("name"), F.lit("  "))))
    rank = pick(_s(F.col("dailyRank")),
                (9, F.when(F.col("dailyRank") % 2 == 1, F.concat(_s(F.col("dailyRank")), F.lit(".0")))
                 .otherwise(F.lit("2147483648"))),
                (10, F.concat(F.lit(" +"), _s(F.col("dailyRank")), F.lit(" "))))
    date = pick(F.date_format("snapshotDate", "yyyy-MM-dd"),
                (11, F.date_format("snapshotDate", "yyyy-M-d")))
    explicit = pick(F.when(F.col("explicit"), "true").otherwise("false"),
                    (12, F.when(F.col("explicit"), "TRUE").otherwise("yes")))
    dance = pick(_s(F.col("danceability")), (13, F.lit("inf")), (14, F.lit("NaN")))
    artists = pick(F.concat(F.lit("Artist "), F.col("spotifyId")), (2, F.lit("")))
    movement = pick(_s(F.col("dailyRank") % 3 - 1), (3, F.lit('" "')))
    weekly = pick(_s(F.col("dailyRank") % 5 - 2), (4, F.lit("\t")))
    popularity = pick(_s(F.lit(100) - F.col("dailyRank")), (8, F.lit('"open')))
    tsig = pick(_s(F.col("timeSignature")), (17, F.concat(q, _s(F.col("timeSignature")))))
    cols = [F.col("spotifyId"), name, artists, rank, movement, weekly, F.col("country"), date,
            popularity, explicit, _s(F.col("durationMs")),
            F.concat(F.lit("Album "), F.col("spotifyId")), F.lit("2023-06-01"),
            dance, _s(F.col("energy")), _s(F.col("key")), _s(F.col("loudness")), _s(F.col("mode")),
            _s(F.col("speechiness")), _s(F.col("acousticness")), _s(F.col("instrumentalness")),
            _s(F.col("liveness")), _s(F.col("valence")), _s(F.col("tempo")), tsig]
    line = F.concat_ws(",", *cols)
    line = pick(line,
                (5, F.concat_ws(",", *cols[:24])),
                (6, F.concat(line, F.lit(",extra"))),
                (7, F.concat(line, F.lit(","))),
                (15, F.lit("")))
    return chart.select(line.alias("value"))


def write_chart_csv(spark: SparkSession, chart: DataFrame, corrupt: bool = False,
                    path: str | None = None) -> str:
    """Write the lines as text under the shared folder; return the path.

    Every task writes its own lines as one file, with no shuffle or sort: files
    grow in number with the chart's partitions, and a task holds one row at a
    time. The first line of each file is the header, set before the line that is
    the first of its partition.
    """
    path = path or shared_path(spark, "chart-csv")
    row_of_partition = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    (chart_csv_lines(chart, corrupt)
     .select(F.when(row_of_partition == 0, F.concat_ws("\n", F.lit(HEADER), "value")).otherwise(F.col("value"))
             .alias("value"))
     .write.mode("overwrite").option("maxRecordsPerFile", 0).text(path))
    return path
