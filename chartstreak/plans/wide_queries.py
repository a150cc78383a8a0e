"""The headline queries over the wide chart (song = user_id), rule: top 10 on 2 consecutive days.

The wide chart grows with ``events``: one row per user, event type and day.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from chartstreak.functions.features import feature_columns, label_column
from chartstreak.operators import classify, streaks
from chartstreak.operators import importance as imp
from chartstreak.plans.common import chart_cols_sql, flat, hits_sql, labelled_sql, with_chart
from chartstreak.plans import profile_queries as prof
from chartstreak.plans.ingest_queries import PARSED_CHART_SQL, _CLEAN_SQL, LINES_SQL, counted, counters_sql
from chartstreak.plans.json_queries import _raw_sql
from chartstreak.plans.profile_queries import ROW_ID_SQL, _fa
from chartstreak.plans.queries import REGISTRY, _label_sql, labelled, register
from chartstreak.schemas import FEATURE_NAMES, LABELLED_SCHEMA
from chartstreak.session import shared_path
from chartstreak.sources import json_io
from chartstreak.sources.chart import NARROW_SONGS, load_chart
from chartstreak.sources.chart_csv import write_chart_csv
from chartstreak.sources.csv_ingest import ingest_chart_csv
from chartstreak.streaming import stream as st

TOP, RUN = 10, 2
HITS, LAB = hits_sql(TOP, RUN), labelled_sql(TOP, RUN)
ROW_ID = ["country", "spotifyId", "snapshotDate"]


def _wide(sql: str) -> str:
    """A query over the narrow chart, over the wide one."""
    return sql.replace(f"user_id % {NARROW_SONGS}", "user_id")


def _labelled(spark, sf_dir, mode="final", emit="annotate"):
    return labelled(spark, sf_dir, mode, emit, wide=True, top_n=TOP, run=RUN)


def _ingest(spark, sf_dir, corrupt):
    return ingest_chart_csv(spark, write_chart_csv(spark, load_chart(spark, sf_dir, wide=True), corrupt=corrupt))


@register("csv_ingest_wide", _wide(_CLEAN_SQL))
def q_csv_ingest_wide(spark, sf_dir):
    return flat(_ingest(spark, sf_dir, corrupt=False).rows)


@register("strict_parse_wide", with_chart(
    "select * replace (cast(snapshotDate as varchar) as snapshotDate) from parsed_chart", wide=True,
    extra=PARSED_CHART_SQL))
def q_strict_parse_wide(spark, sf_dir):
    return flat(_ingest(spark, sf_dir, corrupt=True).rows)


@register("pipeline_counters_wide", counters_sql(TOP, RUN, wide=True))
def q_pipeline_counters_wide(spark, sf_dir):
    return counted(_ingest(spark, sf_dir, corrupt=True), TOP, RUN)


@register("reject_rows_wide", with_chart(
    """select lineCountry, reason, count(*) as lines from line_outcome
       where reason is not null group by lineCountry, reason""", wide=True, extra=LINES_SQL))
def q_reject_rows_wide(spark, sf_dir):
    rejects = _ingest(spark, sf_dir, corrupt=True).lines.where(F.col("reason").isNotNull())
    return rejects.groupBy(F.col("fields")[6].alias("lineCountry"), "reason").agg(F.count(F.lit(1)).alias("lines"))


for _name, _query in (("describe_bands", prof.q_describe_bands), ("short_summary", prof.q_short_summary),
                      ("song_profile", prof.q_song_profile)):
    @register(f"{_name}_wide", _wide(REGISTRY[_name][1]))
    def q_profile_wide(spark, sf_dir, query=_query):
        """F11-F26 on every row of the wide chart."""
        return query(spark, sf_dir, wide=True)


@register("hit_detect_wide", with_chart(
    f"select {chart_cols_sql()}, consecutiveHitDaysCount, consecutiveHitDaysList, hit from hits", wide=True, extra=HITS))
def q_hit_detect_wide(spark, sf_dir):
    return flat(streaks.detect_hits(load_chart(spark, sf_dir, wide=True), TOP, RUN))


for _mode, _emit, _name in (("final", "annotate", "final"), ("causal", "annotate", "causal"),
                            ("final", "replace", "replace")):
    @register(f"label_{_name}_wide", _label_sql(_mode, _emit, wide=True, top_n=TOP, run=RUN))
    def q_label_wide(spark, sf_dir, mode=_mode, emit=_emit):
        return flat(_labelled(spark, sf_dir, mode, emit))


@register("class_balance_wide", with_chart(
    """select country, count(*) as records, count_if(hit) as hits, count_if(not hit) as nonHits
       from labelled group by country""", wide=True, extra=LAB))
def q_class_balance_wide(spark, sf_dir):
    return classify.class_balance(_labelled(spark, sf_dir))


@register("feature_vector_wide", with_chart(
    f"select {ROW_ID_SQL}, " + ", ".join(f"{_fa(n)} as {n}" for n in FEATURE_NAMES)
    + ", cast(hit as integer) as label from labelled", wide=True, extra=LAB))
def q_feature_vector_wide(spark, sf_dir):
    return flat(_labelled(spark, sf_dir).select(*ROW_ID, *feature_columns(), label_column().alias("label")))


@register("json_roundtrip_wide", _label_sql("final", "annotate", wide=True, top_n=TOP, run=RUN))
def q_json_roundtrip_wide(spark, sf_dir):
    path = shared_path(spark, "labelled-jsonl")
    json_io.to_json_lines(_labelled(spark, sf_dir)).write.mode("overwrite").text(path)
    return flat(json_io.from_json_lines(spark.read.text(path), strict=True))


@register("percent_normalise_wide", with_chart(
    "select country, pos, feature, importance from imp", wide=True, extra=LAB + "," + _raw_sql()))
def q_percent_normalise_wide(spark, sf_dir):
    return imp.percent_normalise(imp.mean_gap_scores(_labelled(spark, sf_dir))).select(
        "country", "pos", "feature", "importance")


@register("stream_hit_detect_wide", with_chart(
    f"select {chart_cols_sql()}, consecutiveHitDaysCount, consecutiveHitDaysList, hit from hits", wide=True, extra=HITS))
def q_stream_hit_detect_wide(spark, sf_dir):
    """T2 over the wide chart; the key's rows of the one batch are taken in date order."""
    st.use_rocksdb(spark)
    src = st.write_daily_files(spark, load_chart(spark, sf_dir, wide=True))
    out, q = st.stream_to_parquet(spark, st.hit_stream(st.file_stream(spark, src, max_files_per_trigger=None), TOP, RUN),
                                  "hit-stream")
    st.drain(q)
    return flat(spark.read.schema(LABELLED_SCHEMA).parquet(out))
