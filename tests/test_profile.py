"""Band words at exact thresholds, NaN, pitch classes and the sample song."""

import math

import pytest
from pyspark.sql import functions as F

from chartstreak.functions import profile as pf

NAN = float("nan")


def run(spark, fn, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_scale_band(spark):
    got = run(spark, lambda x: pf.scale_band(x, "low", "high"), [0.29, 0.3, 0.7, 0.71, NAN])
    assert got == ["low", "moderate", "moderate", "high", "moderate"]


def test_loudness_speech_instr_live_valence(spark):
    assert run(spark, pf.loudness_band, [-4.99, -5, -9.99, -10, NAN]) == [
        "very loud", "moderately loud", "moderately loud", "quiet", "quiet"]
    assert run(spark, pf.speechiness_band, [0.67, 0.66, 0.34, 0.33, NAN]) == [
        "talk-like (e.g., podcast)", "some speech", "some speech", "musical", "musical"]
    assert run(spark, pf.instrumentalness_band, [0.71, 0.7, 0.31, 0.3]) == [
        "mostly instrumental", "partly instrumental", "partly instrumental", "mostly vocal"]
    assert run(spark, pf.liveness_band, [0.81, 0.8, 0.31, 0.3]) == [
        "live performance", "live-like ambiance", "live-like ambiance", "studio recording"]
    assert run(spark, pf.valence_band, [0.76, 0.75, 0.41, 0.4]) == ["happy", "positive", "positive", "serious"]


def test_tempo_pitch_meter(spark):
    assert run(spark, pf.tempo_band, [59.9, 60, 89.9, 90, 119.9, 120, 149.9, 150, NAN]) == [
        "very slow", "slow", "slow", "moderate", "moderate", "fast", "fast", "very fast", "very fast"]
    assert run(spark, pf.pitch_class, [-1, 0, 4.5, 11, 12, NAN]) == [None, "C", "F", "B", "C", "C"]
    assert run(spark, pf.meter, [4.0, 3.0, 4.000001, NAN]) == [
        "common time", "unusual meter", "unusual meter", "unusual meter"]


def test_sample_song(spark):
    # explicit false, 210000 ms, dance 0.8, energy 0.75, key 5, loudness -5, mode 1, speech 0.05,
    # acoustic 0.1, instrumental 0.0, liveness 0.12, valence 0.65, tempo 120, time signature 4
    f = [0.0, 210.0, 0.8, 0.75, 5.0, -5.0, 1.0, 0.05, 0.1, 0.0, 0.12, 0.65, 120.0, 4.0]
    df = spark.createDataFrame([(f,)], "f array<double>")
    r = df.select(pf.short_summary(F.col("f")).alias("s"), pf.profile_text(F.col("f")).alias("p"),
                  *[c.alias(k) for k, c in pf.band_columns(F.col("f")).items()]).first()
    assert r["s"] == "bright energetic danceable pop song"
    assert r["danceabilityBand"] == "highly danceable"
    assert r["energyBand"] == "high energy"
    assert r["loudnessBand"] == "moderately loud"
    assert r["tempoBand"] == "fast"
    assert r["livenessBand"] == "studio recording"
    assert r["valenceBand"] == "positive"
    assert r["pitchClass"] == "F"
    assert r["meter"] == "common time"
    lines = r["p"].split("\n")
    assert lines[0] == "Explicit: ~0% of song marked explicit"
    assert lines[1] == "Duration: 210.0s (~3.5 min)"
    assert lines[3] == "Energy: 0.75 (high energy)."
    assert lines[13] == "Time Signature: 4.0 (common time)"
    assert len(lines) == 15 and lines[14] == ""


def test_summary_words_and_unknown(spark):
    rows = [([0.0, 200.0, 0.3, 0.3, 0, -8, 0, 0.1, 0.8, 0, 0.1, 0.2, 65.0, 4.0],),
            ([0.0, 200.0, 0.5, 0.65, 0, -8, 0, 0.1, 0.2, 0, 0.1, 0.6, 100.0, 4.0],),
            ([0.0, 200.0, 0.5, 0.5, 0, -8, 0, 0.1, 0.8, 0, 0.1, 0.8, 150.0, 4.0],),
            ([1.0, 2.0],), (None,)]
    rows = [([float(v) for v in r[0]],) if r[0] is not None else r for r in rows]
    df = spark.createDataFrame(rows, "f array<double>")
    got = [r[0] for r in df.select(pf.short_summary(F.col("f"))).collect()]
    assert got == ["dark slow jazz song", "bright steady groovy rock song", "upbeat fast groovy folk song",
                   "unknown song", "unknown song"]


def test_half_up_text(spark):
    df = spark.createDataFrame([(0.125, 2.5)], "a double, b double")
    r = df.select(F.format_string("%.2f", "a"), F.format_string("%.0f", "b")).first()
    assert (r[0], r[1]) == ("0.13", "3")
    assert not math.isnan(0.125)
