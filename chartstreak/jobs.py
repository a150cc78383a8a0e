"""The two end-to-end jobs: batch hit detection and streaming per-country ML.

``batch_hit_songs_job``: CSV -> clean -> detect hits -> label every row ->
JSON files, with the counters (valid, parsed, hits) observed on the way.
``streaming_ml_job``: JSON files arriving in a folder -> per-country
micro-batches -> gates, K-Means on hits, forest per country, importance
documents, predictions and a report per country.
``windowed_ml_job``: the same training, once per window of a country instead of
per micro-batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from chartstreak.operators import forest, importance, kmeans, streaks
from chartstreak.operators.label import label
from chartstreak.schemas import LABELLED_SCHEMA, RUN_DAYS, TOP_N
from chartstreak.session import materialise, remove_path
from chartstreak.sources import json_io
from chartstreak.sources.csv_ingest import ingest_chart_csv
from chartstreak.streaming import stream as st
from chartstreak.streaming import windows as tw


@dataclass
class BatchResult:
    output_path: str
    valid_records: int
    parsed_records: int
    hit_songs_records: int


def batch_hit_songs_job(spark: SparkSession, csv_path: str, output_path: str,
                        top_n: int = TOP_N, run: int = RUN_DAYS, mode: str = "final",
                        emit: str = "annotate", stage_path: str | None = None) -> BatchResult:
    """Job 1. The parsed chart is staged once as Parquet (it is read twice:
    detection and labelling) and the stage removed at the end; the labelled
    rows are written as JSON lines. A chart in which a day repeats goes through
    the retracting detector, in date order."""
    ing = ingest_chart_csv(spark, csv_path)
    stage = stage_path or f"{output_path.rstrip('/')}_parsed"
    ing.rows.write.mode("overwrite").parquet(stage)           # fills ing.counters
    rows = spark.read.parquet(stage)
    hits_obs = Observation("hits")
    hits = streaks.detect_hits(rows, top_n, run, repeated_dates="auto").observe(
        hits_obs, F.count(F.lit(1)).alias("hitSongsRecords"))
    labelled = label(rows, hits, mode=mode, emit=emit)         # size check materialises the hits
    json_io.write_json_lines(labelled, output_path)
    if stage_path is None:
        remove_path(spark, stage)
    c = ing.counters.get
    return BatchResult(output_path, int(c.get("validRecords") or 0), int(c.get("parsedRecords") or 0),
                       int(hits_obs.get.get("hitSongsRecords") or 0))


def train_countries(spark: SparkSession, labelled: DataFrame, output_root: str,
                    params: forest.ForestParams | None = None, report_name: str = "report") -> DataFrame:
    """Per-country ML over one batch of labelled rows; everything it makes is kept below ``output_root``.

    ``models/country=XX`` the classifiers, ``importance`` the documents (both
    published as a new version per country), ``<report_name>`` the report as JSON lines: counts,
    clustering outcome with the summary and profile of each cluster, classifier
    outcome (TRAINED, FAILED or the gate's reason) and the predictions for the
    first hit and the first song. Writing the same batch again replaces it.
    """
    labelled = materialise(labelled, "batch")
    cents, km_status = kmeans.grouped_kmeans(labelled)
    run = forest.train_per_country(spark, labelled, params, model_root=f"{output_root}/models")
    if run.models:
        docs = importance.to_documents(forest.importances(spark, run))
        json_io.publish_importance_docs(docs, f"{output_root}/importance")
    clusters = kmeans.cluster_profiles(cents).groupBy("country").agg(
        F.array_sort(F.collect_list(F.struct("cluster", "summary", "profile"))).alias("clusters"))
    samples = forest.predict_samples(spark, run, labelled).groupBy("country").agg(
        F.array_sort(F.collect_list(F.struct("sample", "spotifyId", "name", "predictionText"))).alias("predictions"))
    report = (run.gate.drop("gate").join(km_status, "country").join(run.status, "country")
              .join(clusters, "country", "left").join(samples, "country", "left"))
    path = f"{output_root}/{report_name}"
    report.write.mode("overwrite").json(path)
    return spark.read.schema(report.schema).json(path)


def streaming_ml_job(spark: SparkSession, input_dir: str, output_root: str,
                     available_now: bool = False, params: forest.ForestParams | None = None):
    """Job 2: micro-batches every 30 s (or drain with ``available_now``); a report per batch below ``output_root``."""
    def train(batch: DataFrame, batch_id: int) -> None:
        train_countries(spark, batch, output_root, params, f"reports/batchId={batch_id}")

    _, q = st.country_batches(spark, st.file_stream(spark, input_dir, LABELLED_SCHEMA, None),
                              available_now=available_now, train=train)
    return q


def windowed_ml_job(spark: SparkSession, input_dir: str, output_root: str, delay_ms: int = tw.DELAY_MS,
                    available_now: bool = False, params: forest.ForestParams | None = None,
                    max_files_per_trigger: int | None = None, clock=tw.wall_clock):
    """Job 2 with a timer per country: each (country, window) is trained once and has one report.

    A country has one open window at a time, so the windows that one batch fires
    are of different countries and train together. A batch's reports lie below
    ``reports/batchId=N`` with their ``windowEnd``, and a replay replaces them.
    Returns (windows, query); after a drain ``windows.finish(LABELLED_SCHEMA)``
    hands over what is still open.
    """
    def train(rows: DataFrame, batch_id: int) -> None:
        ends = rows.groupBy("country").agg(F.max("windowEnd").alias("windowEnd"))
        report = train_countries(spark, rows.drop("windowEnd"), output_root, params, f"made/batchId={batch_id}")
        report.join(ends, "country").write.mode("overwrite").json(f"{output_root}/reports/batchId={batch_id}")
        remove_path(spark, f"{output_root}/made/batchId={batch_id}")

    source = st.file_stream(spark, input_dir, LABELLED_SCHEMA, max_files_per_trigger)
    return tw.training_windows(spark, source, train, delay_ms, available_now, root=f"{output_root}/windows", clock=clock)
