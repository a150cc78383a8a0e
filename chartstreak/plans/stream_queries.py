"""Registered streaming queries: the chart arrives as daily JSON files.

Each query drains its stream with ``availableNow`` into a parquet sink in the
shared folder and returns the sink read back; the result must equal the batch
operator's (same oracle SQL).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartstreak.operators import classify
from chartstreak.plans.common import chart_cols_sql, flat, hits_sql, labelled_sql, with_chart
from chartstreak.plans.queries import _label_sql, labelled, register
from chartstreak.schemas import LABELLED_SCHEMA, RUN_DAYS, TOP_N
from chartstreak.session import materialise, shared_path
from chartstreak.sources.chart import load_chart
from chartstreak.sources.json_io import JSON_OPTIONS, read_labelled_json, stream_json_lines
from chartstreak.streaming import growing, reorder, windows
from chartstreak.streaming import stream as st


@register("stream_file_source", _label_sql("final", "annotate"))
def q_stream_file_source(spark, sf_dir):
    """S2 + T4: labelled rows as files in a directory, picked up by a file stream."""
    src = st.write_daily_files(spark, labelled(spark, sf_dir))
    out, q = st.stream_to_parquet(spark, st.file_stream(spark, src, LABELLED_SCHEMA), "file-source")
    st.drain(q)
    return flat(spark.read.schema(LABELLED_SCHEMA).parquet(out))


@register("stream_country_batches", with_chart(
    """select country, count(*) as records, count_if(hit) as hits, count_if(not hit) as nonHits
       from labelled group by country""", extra=labelled_sql(TOP_N, RUN_DAYS)))
def q_stream_country_batches(spark, sf_dir):
    """Per-country micro-batches (foreachBatch); per-batch counts summed per country."""
    src = st.write_daily_files(spark, labelled(spark, sf_dir))
    out, q = st.country_batches(spark, st.file_stream(spark, src, LABELLED_SCHEMA))
    st.drain(q)
    return (spark.read.parquet(out).groupBy("country")
            .agg(F.sum("records").cast("bigint").alias("records"), F.sum("hits").cast("bigint").alias("hits"),
                 F.sum("nonHits").cast("bigint").alias("nonHits")))


@register("stream_hit_detect", with_chart(
    f"select {chart_cols_sql()}, consecutiveHitDaysCount, consecutiveHitDaysList, hit from hits",
    extra=hits_sql(TOP_N, RUN_DAYS)))
def q_stream_hit_detect(spark, sf_dir):
    """The streak detector as keyed state over the chart stream."""
    st.use_rocksdb(spark)
    src = st.write_daily_files(spark, load_chart(spark, sf_dir))
    out, q = st.stream_to_parquet(spark, st.hit_stream(st.file_stream(spark, src)), "hit-stream")
    st.drain(q)
    return flat(spark.read.schema(LABELLED_SCHEMA).parquet(out))


@register("stream_label", _label_sql("final", "annotate"))
def q_stream_label(spark, sf_dir):
    """Hits from the stateful stream, then the chart stream labelled against them."""
    st.use_rocksdb(spark)
    src = st.write_daily_files(spark, load_chart(spark, sf_dir))
    hits_out, q1 = st.stream_to_parquet(spark, st.hit_stream(st.file_stream(spark, src)), "hit-stream")
    st.drain(q1)
    out, q2 = st.label_stream(spark, st.file_stream(spark, src), hits_out)
    st.drain(q2)
    return flat(spark.read.schema(LABELLED_SCHEMA).parquet(out).select(*LABELLED_SCHEMA.fieldNames()))


@register("stream_json_sink", _label_sql("final", "annotate"))
def q_stream_json_sink(spark, sf_dir):
    """The rolling JSON sink on a stream, read back with a fixed schema."""
    src = st.write_daily_files(spark, labelled(spark, sf_dir))
    out = shared_path(spark, "json-sink")
    st.drain(stream_json_lines(st.file_stream(spark, src, LABELLED_SCHEMA), out, f"{out}-ckpt",
                               max_records_per_file=500, available_now=True))
    return flat(read_labelled_json(spark, out))


# --- input that arrives in parts: one run of the stream per part, on the same checkpoint ------

def arrive(rows: DataFrame, part: Column, path: str, step: Callable[[], None]) -> None:
    """Write ``rows`` as JSON files part by part; after each, ``step`` drains the stream (one micro-batch)."""
    staged = materialise(rows.withColumn("part", part), "arriving")
    for p in sorted(r[0] for r in staged.select("part").distinct().collect()):
        staged.where(F.col("part") == p).drop("part").write.options(**JSON_OPTIONS).json(f"{path}/part={p}")
        step()


DAY_SQL = "({}snapshotDate - date '2000-01-01')"


def _day() -> Column:
    return F.datediff("snapshotDate", F.lit("2000-01-01"))


def _week() -> Column:
    return F.floor(_day() / 7).cast("int")


def _growing_sql(wide: bool, top_n: int, run: int) -> str:
    """Only rows of a later week than their key's trigger row are labelled hit."""
    sql = _label_sql("causal", "annotate", wide=wide, top_n=top_n, run=run)
    return sql.replace("c.snapshotDate > h.snapshotDate", f"{DAY_SQL.format('c.')} // 7 > {DAY_SQL.format('h.')} // 7")


def _label_growing(spark, chart, top_n, run):
    st.use_rocksdb(spark)
    src, root = shared_path(spark, "stream-in"), shared_path(spark, "growing-labels")

    def step():
        stream = st.file_stream(spark, src, max_files_per_trigger=None)
        # the derived chart is grouped by country, song and day
        _, q = growing.growing_label_stream(spark, stream, top_n, run, root=root, one_row_a_day=True, compact_every=3)
        st.drain(q)
    arrive(chart, _week(), src, step)
    return flat(growing.GrowingLabels(spark, root).labelled())


@register("stream_label_growing", _growing_sql(False, TOP_N, RUN_DAYS))
def q_stream_label_growing(spark, sf_dir):
    """Weeks arrive one by one; each is labelled with the hits of the weeks before it, in the detector's stream."""
    return _label_growing(spark, load_chart(spark, sf_dir), TOP_N, RUN_DAYS)


@register("stream_label_growing_wide", _growing_sql(True, TOP_N, 2))
def q_stream_label_growing_wide(spark, sf_dir):
    return _label_growing(spark, load_chart(spark, sf_dir, wide=True), TOP_N, 2)


@register("stream_country_windows", with_chart(
    f"""select l.country, opened + 14 as windowEndDay, count(*) as records, count_if(hit) as hits,
          count_if(not hit) as nonHits, case when count(*) < 2 then 'TOO_FEW_ROWS'
            when count_if(hit) = 0 or count_if(not hit) = 0 then 'SKIPPED_ONE_CLASS' else 'TRAIN' end as gate
        from labelled l join sw_win w on w.country = l.country and {DAY_SQL.format('l.')} // 7 * 7 >= opened
          and {DAY_SQL.format('l.')} // 7 * 7 < opened + 14 group by l.country, opened""",
    extra=labelled_sql(TOP_N, RUN_DAYS) + f""",
    sw_weeks as (select distinct country, {DAY_SQL.format('')} // 7 * 7 as t from labelled),
    sw_win as (select country, min(t) as opened from sw_weeks group by country
               union all
               select w.country, min(x.t) from sw_win w join sw_weeks x on x.country = w.country and x.t >= w.opened + 14
               group by w.country)""").replace("with ", "with recursive ", 1))
def q_stream_country_windows(spark, sf_dir):
    """T1 exact: weeks arrive one by one under a clock of their own; windows of 14 days hand their rows to the gate."""
    src, root = shared_path(spark, "stream-in"), shared_path(spark, "training-windows")
    reports = f"{root}/reports"

    def clock(batch, batch_id):
        return batch.agg(F.max(_week())).first()[0] * 7 * reorder.DAY_MS

    def train(rows, batch_id):
        ends = rows.groupBy("country").agg(F.max("windowEnd").alias("windowEnd"))   # a country fires one at a time
        classify.training_gate(rows).join(ends, "country").write.mode("overwrite").parquet(f"{reports}/batchId={batch_id}")

    def step():
        stream = st.file_stream(spark, src, LABELLED_SCHEMA, None)
        _, q = windows.training_windows(spark, stream, train, 14 * reorder.DAY_MS, True, root, clock)
        st.drain(q)
    arrive(labelled(spark, sf_dir), _week(), src, step)
    windows.TrainingWindows(spark, root, train).finish(LABELLED_SCHEMA)
    day = (F.col("windowEnd") / reorder.DAY_MS).cast("bigint")
    return spark.read.parquet(f"{reports}/*").select(
        "country", day.alias("windowEndDay"), "records", "hits", "nonHits", "gate")


@register("stream_hit_detect_reordered", with_chart(
    f"select {chart_cols_sql()}, consecutiveHitDaysCount, consecutiveHitDaysList, hit from hits",
    extra=hits_sql(TOP_N, RUN_DAYS)))
def q_stream_hit_detect_reordered(spark, sf_dir):
    """T2 behind the reorder buffer: days arrive mixed, four parts one after the other, and give the batch hits."""
    st.use_rocksdb(spark)
    src, root = shared_path(spark, "stream-in"), shared_path(spark, "reordered")
    chart = materialise(load_chart(spark, sf_dir), "chart")
    span = chart.agg(F.datediff(F.max("snapshotDate"), F.min("snapshotDate"))).first()[0] or 0

    def step():
        hits = reorder.reordered_hit_stream(st.file_stream(spark, src, max_files_per_trigger=None), f"{span + 1} days")
        st.drain(st._start(hits.writeStream.format("parquet").option("path", f"{root}/out").option(
            "checkpointLocation", f"{root}/checkpoint").outputMode("append"), True))
    part = F.when(F.col("spotifyId") == reorder.END, 4).otherwise(_day() * 37 % 4)
    arrive(chart.unionByName(reorder.end_of_days(chart, span + 1)), part, src, step)
    return flat(spark.read.schema(LABELLED_SCHEMA).parquet(f"{root}/out"))
