"""Describe songs and cluster centres in words (Column -> Column).

All rules are ``when`` chains on a 14-feature array (``features.features_of``),
so they run JVM-side on rows and on centroids alike. Comparisons follow
Java: any comparison with NaN is false, so a NaN falls to the last branch.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartstreak.functions.features import features_of

# --- fixed values (words, thresholds and text formats) ----------------------
PITCH_CLASSES = ["C", "C#/Db", "D", "D#/Eb", "E", "F", "F#/Gb", "G", "G#/Ab", "A", "A#/Bb", "B"]
SCALE_WORDS = {  # feature: (low word, high word); below 0.3 low, above 0.7 high, else "moderate"
    "danceability": ("undanceable", "highly danceable"),
    "energy": ("low energy", "high energy"),
    "acousticness": ("electronic", "acoustic"),
}
SCALE_LOW, SCALE_HIGH, SCALE_BETWEEN = 0.3, 0.7, "moderate"
LOUDNESS = [(-5, "very loud"), (-10, "moderately loud")], "quiet"                     # value > t
SPEECHINESS = [(0.66, "talk-like (e.g., podcast)"), (0.33, "some speech")], "musical"  # value > t
INSTRUMENTALNESS = [(0.7, "mostly instrumental"), (0.3, "partly instrumental")], "mostly vocal"
LIVENESS = [(0.8, "live performance"), (0.3, "live-like ambiance")], "studio recording"
VALENCE = [(0.75, "happy"), (0.4, "positive")], "serious"
TEMPO = [(60, "very slow"), (90, "slow"), (120, "moderate"), (150, "fast")], "very fast"  # value < t
METER = (4.0, "common time", "unusual meter")
MOOD = [(0.75, "upbeat"), (0.5, "bright"), (0.3, "moody")], "dark"                  # valence > t
DANCE = [(0.7, "danceable"), (0.4, "groovy")], ""                                   # danceability > t
# tempo < t: word; a second word stands for energy > TEMPO_ENERGY
TEMPO_WORDS = [(70, "slow", None), (110, "calm", "steady"), (140, "energetic", None)], "fast"
TEMPO_ENERGY = 0.6
ACOUSTIC = (0.7, 0.4, "jazz song", "folk song")     # acousticness > t: by energy < e
ELECTRIC = [(0.7, "pop song"), (0.4, "rock song")], "electronic song"   # energy > t
UNKNOWN_SONG = "unknown song"
PROFILE_LINES = [
    "Explicit: ~%.0f%% of song marked explicit",
    "Duration: %.1fs (~%.1f min)",
    "Danceability: %.2f (%s)",
    "Energy: %.2f (%s).",
    "Key: %s",
    "Loudness: %.2f dB (%s)",
    "Mode: ~%.0f%% major",
    "Speechiness: %.3f (%s)",
    "Acousticness: %.2f (%s)",
    "Instrumentalness: %.3f (%s)",
    "Liveness: %.2f (%s)",
    "Valence: %.2f (%s mood)",
    "Tempo: %.1f BPM (%s)",
    "Time Signature: %.1f (%s)",
]
ROW_SUMMARY = "%s | Daily position: %d | %s (%s)"
HIT_SUMMARY = "%s | %s | %d days: [%s]"
PREDICTION = ("a HIT.", "not a HIT.")
# ---------------------------------------------------------------------------


def _ok(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x)


def gt(x: Column, t) -> Column:
    """Java ``x > t`` (false for NaN)."""
    return _ok(x) & (x > F.lit(t))


def lt(x: Column, t) -> Column:
    """Java ``x < t`` (false for NaN)."""
    return _ok(x) & (x < F.lit(t))


def _chain(x: Column, rule, cmp) -> Column:
    steps, last = rule
    out = None
    for t, word in steps:
        out = (F.when(cmp(x, t), F.lit(word)) if out is None
               else out.when(cmp(x, t), F.lit(word)))
    return out.otherwise(F.lit(last))


def scale_band(x: Column, low: str, high: str) -> Column:
    """below 0.3 -> low, above 0.7 -> high, else moderate."""
    return (F.when(lt(x, SCALE_LOW), F.lit(low)).when(gt(x, SCALE_HIGH), F.lit(high))
            .otherwise(F.lit(SCALE_BETWEEN)))


def loudness_band(x: Column) -> Column:        # F12
    return _chain(x, LOUDNESS, gt)


def speechiness_band(x: Column) -> Column:     # F13
    return _chain(x, SPEECHINESS, gt)


def instrumentalness_band(x: Column) -> Column:  # F14
    return _chain(x, INSTRUMENTALNESS, gt)


def liveness_band(x: Column) -> Column:        # F15
    return _chain(x, LIVENESS, gt)


def valence_band(x: Column) -> Column:         # F16
    return _chain(x, VALENCE, gt)


def tempo_band(x: Column) -> Column:           # F17
    return _chain(x, TEMPO, lt)


def java_round(x: Column) -> Column:
    """Math.round: floor(x + 0.5); NaN -> 0."""
    return F.when(F.isnan(x), F.lit(0)).otherwise(F.floor(x + F.lit(0.5)))


def pitch_class(x: Column) -> Column:
    """rounded key mod 12 -> pitch name; a negative key gives NULL."""
    k = java_round(x)
    names = F.array(*[F.lit(p) for p in PITCH_CLASSES])
    return F.when(k >= 0, F.element_at(names, (k % 12 + 1).cast("int")))


def meter(x: Column) -> Column:
    """exactly 4.0 -> common time."""
    value, yes, no = METER
    return F.when(_ok(x) & (x == F.lit(value)), F.lit(yes)).otherwise(F.lit(no))


def band_columns(arr: Column) -> dict[str, Column]:
    """All band words of a feature array, by output column name."""
    f = features_of(arr)
    out = {f"{n}Band": scale_band(f[n], *SCALE_WORDS[n]) for n in SCALE_WORDS}
    out.update({
        "loudnessBand": loudness_band(f["loudness"]),
        "speechinessBand": speechiness_band(f["speechiness"]),
        "instrumentalnessBand": instrumentalness_band(f["instrumentalness"]),
        "livenessBand": liveness_band(f["liveness"]),
        "valenceBand": valence_band(f["valence"]),
        "tempoBand": tempo_band(f["tempo"]),
        "pitchClass": pitch_class(f["key"]),
        "meter": meter(f["timeSignature"]),
    })
    return out


def profile_numbers(arr: Column) -> dict[str, Column]:
    """the numbers printed in the profile, rounded half-up as printed."""
    f = features_of(arr)

    def r(x, d):
        return F.floor(x * F.lit(10.0 ** d) + F.lit(0.5)) / F.lit(10.0 ** d)

    return {
        "explicitPct": r(f["explicit"] * 100, 0),
        "durationSec": r(f["durationSeconds"], 1),
        "durationMin": r(f["durationSeconds"] / 60, 1),
        "majorPct": r(f["mode"] * 100, 0),
    }


def profile_text(arr: Column) -> Column:
    """the 14-line profile (Java formatter, half-up), newline-terminated."""
    f = features_of(arr)
    b = band_columns(arr)
    args = [
        [f["explicit"] * 100],
        [f["durationSeconds"], f["durationSeconds"] / 60],
        [f["danceability"], b["danceabilityBand"]],
        [f["energy"], b["energyBand"]],
        [F.coalesce(b["pitchClass"], F.lit("?"))],
        [f["loudness"], b["loudnessBand"]],
        [f["mode"] * 100],
        [f["speechiness"], b["speechinessBand"]],
        [f["acousticness"], b["acousticnessBand"]],
        [f["instrumentalness"], b["instrumentalnessBand"]],
        [f["liveness"], b["livenessBand"]],
        [f["valence"], b["valenceBand"]],
        [f["tempo"], b["tempoBand"]],
        [f["timeSignature"], b["meter"]],
    ]
    lines = [F.format_string(fmt + "\n", *a) for fmt, a in zip(PROFILE_LINES, args)]
    return F.concat(*lines)


def mood_word(valence: Column) -> Column:      # F22
    return _chain(valence, MOOD, gt)


def tempo_word(tempo: Column, energy: Column) -> Column:  # F23
    steps, last = TEMPO_WORDS
    words = [(t, w if lively is None else F.when(gt(energy, TEMPO_ENERGY), lively).otherwise(w))
             for t, w, lively in steps]
    out = F.when(lt(tempo, words[0][0]), words[0][1])
    for t, word in words[1:]:
        out = out.when(lt(tempo, t), word)
    return out.otherwise(last)


def dance_word(danceability: Column) -> Column:  # F24
    return _chain(danceability, DANCE, gt)


def genre_word(acousticness: Column, energy: Column) -> Column:  # F25
    above, below, quiet, loud = ACOUSTIC
    return F.when(gt(acousticness, above), F.when(lt(energy, below), quiet).otherwise(loud)).otherwise(
        _chain(energy, ELECTRIC, gt))


def short_summary(arr: Column) -> Column:
    """non-empty words joined by a blank; missing or short vector -> unknown."""
    f = features_of(arr)
    words = [mood_word(f["valence"]), tempo_word(f["tempo"], f["energy"]),
             dance_word(f["danceability"]), genre_word(f["acousticness"], f["energy"])]
    joined = F.concat_ws(" ", *[F.nullif(w, F.lit("")) for w in words])
    return F.when(arr.isNull() | (F.size(arr) < 14), F.lit(UNKNOWN_SONG)).otherwise(joined)


def row_summary() -> Column:
    """``name | Daily position: n | country (date)``."""
    return F.format_string(ROW_SUMMARY, F.col("name"), F.col("dailyRank"), F.col("country"),
                           F.date_format("snapshotDate", "yyyy-MM-dd"))


def hit_summary() -> Column:
    """``country | name | n days: [d1, d2, ...]``."""
    return F.format_string(HIT_SUMMARY, F.col("country"), F.col("name"),
                           F.col("consecutiveHitDaysCount"),
                           F.array_join("consecutiveHitDaysList", ", "))


def song_key() -> Column:
    """the composite key ``country|spotifyId``."""
    return F.concat_ws("|", F.col("country"), F.col("spotifyId"))


def prediction_text(pred: Column) -> Column:
    """1 -> "a HIT.", else "not a HIT."."""
    return F.when(pred == 1, F.lit(PREDICTION[0])).otherwise(F.lit(PREDICTION[1]))
