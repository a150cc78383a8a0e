"""Row types and fixed values of the chart data model."""

from pyspark.sql import types as T

# --- fixed values (must equal the reference for identical results) -------
# Hit rule: a song is a hit when it stays at daily rank <= 10 for 14
# consecutive days.
TOP_N = 10
RUN_DAYS = 14
# Minimum number of CSV columns a line needs to be parsed.
MIN_CSV_COLUMNS = 25
# Feature vector order (also the key order of importance documents).
FEATURE_NAMES = [
    "explicit", "durationSeconds", "danceability", "energy", "key", "loudness", "mode",
    "speechiness", "acousticness", "instrumentalness", "liveness", "valence", "tempo",
    "timeSignature",
]
# K-Means cluster count.
N_CLUSTERS = 4
# CSV positions of the 19 read fields: (position, field, kind).
CSV_POSITIONS = [
    (0, "spotifyId", "string"), (1, "name", "string"), (3, "dailyRank", "int"),
    (6, "country", "string"), (7, "snapshotDate", "date"), (9, "explicit", "bool"),
    (10, "durationMs", "int"), (13, "danceability", "float"), (14, "energy", "float"),
    (15, "key", "int"), (16, "loudness", "float"), (17, "mode", "int"),
    (18, "speechiness", "float"), (19, "acousticness", "float"),
    (20, "instrumentalness", "float"), (21, "liveness", "float"), (22, "valence", "float"),
    (23, "tempo", "float"), (24, "timeSignature", "int"),
]
# ---------------------------------------------------------------------------

KEY = ["country", "spotifyId"]

# --- fixed values: the chart row (field names, order and types are the data contract)
CHART_SCHEMA = T.StructType([
    T.StructField("spotifyId", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("dailyRank", T.IntegerType()),
    T.StructField("country", T.StringType()),
    T.StructField("snapshotDate", T.DateType()),
    T.StructField("explicit", T.BooleanType()),
    T.StructField("durationMs", T.LongType()),
    T.StructField("danceability", T.DoubleType()),
    T.StructField("energy", T.DoubleType()),
    T.StructField("key", T.IntegerType()),
    T.StructField("loudness", T.DoubleType()),
    T.StructField("mode", T.IntegerType()),
    T.StructField("speechiness", T.DoubleType()),
    T.StructField("acousticness", T.DoubleType()),
    T.StructField("instrumentalness", T.DoubleType()),
    T.StructField("liveness", T.DoubleType()),
    T.StructField("valence", T.DoubleType()),
    T.StructField("tempo", T.DoubleType()),
    T.StructField("timeSignature", T.IntegerType()),
])
CHART_FIELDS = [f.name for f in CHART_SCHEMA.fields]

LABELLED_SCHEMA = T.StructType(CHART_SCHEMA.fields + [
    T.StructField("consecutiveHitDaysCount", T.IntegerType()),
    T.StructField("consecutiveHitDaysList", T.ArrayType(T.StringType())),
    T.StructField("hit", T.BooleanType()),
])
LABELLED_FIELDS = [f.name for f in LABELLED_SCHEMA.fields]

IMPORTANCE_SCHEMA = T.StructType([
    T.StructField("country", T.StringType()),
    T.StructField("featureImportances", T.MapType(T.StringType(), T.DoubleType())),
])
