"""Registered queries for features, bands, summaries and per-country gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartstreak.functions import profile as pf
from chartstreak.functions.features import feature_array, feature_columns, label_column
from chartstreak.operators import classify
from chartstreak.plans.common import flat, labelled_sql, with_chart
from chartstreak.plans.queries import labelled, register
from chartstreak.schemas import FEATURE_NAMES, RUN_DAYS, TOP_N
from chartstreak.sources.chart import load_chart

LAB = labelled_sql(TOP_N, RUN_DAYS)
ROW_ID = ["country", "spotifyId", "snapshotDate"]
ROW_ID_SQL = "country, spotifyId, cast(snapshotDate as varchar) as snapshotDate"

# Feature expressions in SQL (same order as FEATURE_NAMES).
FEATURE_SQL = {
    "explicit": "case when explicit then 1.0 else 0.0 end",
    "durationSeconds": "durationMs / 1000.0",
}


def fsql(n: str, src: str = "") -> str:
    p = f"{src}." if src else ""
    return FEATURE_SQL.get(n, f"cast({p}{n} as double)").replace("explicit then", f"{p}explicit then") \
        .replace("durationMs", f"{p}durationMs")


def gt(x, t):
    return f"(not isnan({x}) and {x} > {t})"


def lt(x, t):
    return f"(not isnan({x}) and {x} < {t})"


def chain_sql(x, rule, cmp):
    steps, last = rule
    return "case " + " ".join(f"when {cmp(x, t)} then '{w}'" for t, w in steps) + f" else '{last}' end"


def scale_sql(x, low, high):
    return f"case when {lt(x, 0.3)} then '{low}' when {gt(x, 0.7)} then '{high}' else 'moderate' end"


def bands_sql(f) -> dict[str, str]:
    """Band words in DuckDB SQL from a feature accessor ``f(name) -> sql``; words and thresholds stated here anew."""
    out = {
        "danceabilityBand": scale_sql(f("danceability"), "undanceable", "highly danceable"),
        "energyBand": scale_sql(f("energy"), "low energy", "high energy"),
        "acousticnessBand": scale_sql(f("acousticness"), "electronic", "acoustic"),
        "loudnessBand": chain_sql(f("loudness"), ([(-5, "very loud"), (-10, "moderately loud")], "quiet"), gt),
        "speechinessBand": chain_sql(f("speechiness"), ([(0.66, "talk-like (e.g., podcast)"), (0.33, "some speech")],
                                                        "musical"), gt),
        "instrumentalnessBand": chain_sql(f("instrumentalness"), (
            [(0.7, "mostly instrumental"), (0.3, "partly instrumental")], "mostly vocal"), gt),
        "livenessBand": chain_sql(f("liveness"), ([(0.8, "live performance"), (0.3, "live-like ambiance")],
                                                  "studio recording"), gt),
        "valenceBand": chain_sql(f("valence"), ([(0.75, "happy"), (0.4, "positive")], "serious"), gt),
        "tempoBand": chain_sql(f("tempo"), ([(60, "very slow"), (90, "slow"), (120, "moderate"), (150, "fast")],
                                            "very fast"), lt),
    }
    k = f"(case when isnan({f('key')}) then 0 else floor({f('key')} + 0.5) end)"
    names = ", ".join(f"'{p}'" for p in "C C#/Db D D#/Eb E F F#/Gb G G#/Ab A A#/Bb B".split())
    out["pitchClass"] = f"case when {k} >= 0 then ([{names}])[cast({k} % 12 + 1 as integer)] end"
    out["meter"] = f"case when {f('timeSignature')} = 4.0 then 'common time' else 'unusual meter' end"
    return out


def summary_sql(f) -> str:
    mood = chain_sql(f("valence"), ([(0.75, "upbeat"), (0.5, "bright"), (0.3, "moody")], "dark"), gt)
    tempo = (f"case when {lt(f('tempo'), 70)} then 'slow' when {lt(f('tempo'), 110)} then "
             f"(case when {gt(f('energy'), 0.6)} then 'steady' else 'calm' end) "
             f"when {lt(f('tempo'), 140)} then 'energetic' else 'fast' end")
    dance = chain_sql(f("danceability"), ([(0.7, "danceable"), (0.4, "groovy")], ""), gt)
    genre = (f"case when {gt(f('acousticness'), 0.7)} then (case when {lt(f('energy'), 0.4)} then 'jazz song' "
             f"else 'folk song' end) when {gt(f('energy'), 0.7)} then 'pop song' "
             f"when {gt(f('energy'), 0.4)} then 'rock song' else 'electronic song' end")
    return f"concat_ws(' ', {mood}, {tempo}, nullif({dance}, ''), {genre})"


def rnd(x, d):
    return f"floor({x} * {10.0 ** d} + 0.5) / {10.0 ** d}"


def rnd_p(x, d):
    """Half-up rounded value for printing; a zero keeps its sign (Java prints -0.00)."""
    return f"(case when {x} = 0 then {x} else {rnd(x, d)} end)"


def profile_text_sql(f) -> str:
    b = bands_sql(f)
    parts = [
        f"printf('Explicit: ~%.0f%% of song marked explicit' || chr(10), {rnd_p(f('explicit') + ' * 100', 0)})",
        f"printf('Duration: %.1fs (~%.1f min)' || chr(10), {rnd_p(f('durationSeconds'), 1)}, "
        f"{rnd_p(f('durationSeconds') + ' / 60', 1)})",
        f"printf('Danceability: %.2f (%s)' || chr(10), {rnd_p(f('danceability'), 2)}, {b['danceabilityBand']})",
        f"printf('Energy: %.2f (%s).' || chr(10), {rnd_p(f('energy'), 2)}, {b['energyBand']})",
        f"printf('Key: %s' || chr(10), {b['pitchClass']})",
        f"printf('Loudness: %.2f dB (%s)' || chr(10), {rnd_p(f('loudness'), 2)}, {b['loudnessBand']})",
        f"printf('Mode: ~%.0f%% major' || chr(10), {rnd_p(f('mode') + ' * 100', 0)})",
        f"printf('Speechiness: %.3f (%s)' || chr(10), {rnd_p(f('speechiness'), 3)}, {b['speechinessBand']})",
        f"printf('Acousticness: %.2f (%s)' || chr(10), {rnd_p(f('acousticness'), 2)}, {b['acousticnessBand']})",
        f"printf('Instrumentalness: %.3f (%s)' || chr(10), {rnd_p(f('instrumentalness'), 3)}, "
        f"{b['instrumentalnessBand']})",
        f"printf('Liveness: %.2f (%s)' || chr(10), {rnd_p(f('liveness'), 2)}, {b['livenessBand']})",
        f"printf('Valence: %.2f (%s mood)' || chr(10), {rnd_p(f('valence'), 2)}, {b['valenceBand']})",
        f"printf('Tempo: %.1f BPM (%s)' || chr(10), {rnd_p(f('tempo'), 1)}, {b['tempoBand']})",
        f"printf('Time Signature: %.1f (%s)' || chr(10), {rnd_p(f('timeSignature'), 1)}, {b['meter']})",
    ]
    return "concat(" + ", ".join(parts) + ")"


def _fa(n):
    return f"({fsql(n)})"


@register("song_key", with_chart(
    "select country || '|' || spotifyId as songKey, cast(snapshotDate as varchar) as snapshotDate, dailyRank "
    "from chart"))
def q_song_key(spark, sf_dir):
    """composite key text."""
    return flat(load_chart(spark, sf_dir).select(pf.song_key().alias("songKey"), "snapshotDate", "dailyRank"))


@register("feature_vector", with_chart(
    f"select {ROW_ID_SQL}, " + ", ".join(f"{_fa(n)} as {n}" for n in FEATURE_NAMES)
    + ", cast(hit as integer) as label from labelled", extra=LAB))
def q_feature_vector(spark, sf_dir):
    """F8 + F9 over every labelled row."""
    return flat(labelled(spark, sf_dir).select(*ROW_ID, *feature_columns(), label_column().alias("label")))


@register("describe_bands", with_chart(
    f"select {ROW_ID_SQL}, " + ", ".join(f"{v} as {k}" for k, v in bands_sql(_fa).items()) + " from chart"))
def q_describe_bands(spark, sf_dir, wide=False):
    """F11-F19 on every chart row."""
    chart = load_chart(spark, sf_dir, wide=wide).withColumn("_f", feature_array())
    return flat(chart.select(*ROW_ID, *[c.alias(k) for k, c in pf.band_columns(F.col("_f")).items()]))


@register("short_summary", with_chart(
    f"select {ROW_ID_SQL}, {summary_sql(_fa)} as summary from chart"))
def q_short_summary(spark, sf_dir, wide=False):
    """F22-F26 on every chart row."""
    chart = load_chart(spark, sf_dir, wide=wide)
    return flat(chart.select(*ROW_ID, pf.short_summary(feature_array()).alias("summary")))


@register("song_profile", with_chart(
    f"""select {ROW_ID_SQL}, {rnd(_fa('explicit') + ' * 100', 0)} as explicitPct,
          {rnd(_fa('durationSeconds'), 1)} as durationSec, {rnd(_fa('durationSeconds') + ' / 60', 1)} as durationMin,
          {rnd(_fa('mode') + ' * 100', 0)} as majorPct, {profile_text_sql(_fa)} as profile
        from chart"""))
def q_song_profile(spark, sf_dir, wide=False):
    """F20 + F21: printed numbers and the full 14-line profile of every row."""
    chart = load_chart(spark, sf_dir, wide=wide).withColumn("_f", feature_array())
    nums = [c.alias(k) for k, c in pf.profile_numbers(F.col("_f")).items()]
    return flat(chart.select(*ROW_ID, *nums, pf.profile_text(F.col("_f")).alias("profile")))


@register("row_summary", with_chart(
    """select country, spotifyId, cast(snapshotDate as varchar) as snapshotDate,
         printf('%s | Daily position: %d | %s (%s)', name, dailyRank, country, cast(snapshotDate as varchar))
           as rowSummary,
         printf('%s | %s | %d days: [%s]', country, name, consecutiveHitDaysCount,
                replace(consecutiveHitDaysList, ',', ', ')) as hitSummary
       from labelled""", extra=LAB))
def q_row_summary(spark, sf_dir):
    """both summary lines of every labelled row."""
    return flat(labelled(spark, sf_dir).select(*ROW_ID, pf.row_summary().alias("rowSummary"),
                                               pf.hit_summary().alias("hitSummary")))


@register("hits_only", with_chart(
    f"select {ROW_ID_SQL}, name, dailyRank, consecutiveHitDaysCount from labelled where hit", extra=LAB))
def q_hits_only(spark, sf_dir):
    """Labelled rows of hit songs."""
    return flat(classify.hits_only(labelled(spark, sf_dir))
                .select(*ROW_ID, "name", "dailyRank", "consecutiveHitDaysCount"))


@register("class_balance", with_chart(
    """select country, count(*) as records, count_if(hit) as hits, count_if(not hit) as nonHits
       from labelled group by country""", extra=LAB))
def q_class_balance(spark, sf_dir):
    """A4: per-country record, hit and non-hit counts."""
    return classify.class_balance(labelled(spark, sf_dir))


@register("training_gate", with_chart(
    """select country, count(*) as records, count_if(hit) as hits, count_if(not hit) as nonHits,
         case when count(*) < 2 then 'TOO_FEW_ROWS'
              when count_if(hit) = 0 or count_if(not hit) = 0 then 'SKIPPED_ONE_CLASS'
              else 'TRAIN' end as gate
       from labelled group by country""", extra=LAB))
def q_training_gate(spark, sf_dir):
    """A6 + A7: minimum batch size and two-class gates per country."""
    return classify.training_gate(labelled(spark, sf_dir))


@register("first_of_group", with_chart(
    """select country, 'hit' as sample, arg_min(spotifyId, (snapshotDate, spotifyId)) as spotifyId,
         cast(min(snapshotDate) as varchar) as snapshotDate
       from labelled where hit group by country
       union all
       select country, 'any' as sample, arg_min(spotifyId, (snapshotDate, spotifyId)) as spotifyId,
         cast(min(snapshotDate) as varchar) as snapshotDate
       from labelled group by country""", extra=LAB))
def q_first_of_group(spark, sf_dir):
    """W6 + O2: the first hit row and the first row of each country."""
    s = classify.first_of_group(labelled(spark, sf_dir))
    return flat(s.select("country", "sample", "spotifyId", "snapshotDate"))
