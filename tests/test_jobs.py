"""Both end-to-end jobs over files, and the scratch they leave."""

import json
import os

import pytest
from pyspark.sql import functions as F

from chartstreak import jobs
from chartstreak.operators import forest, streaks
from chartstreak.operators import label as lab
from chartstreak.plans.queries import labelled, restated_chart
from chartstreak.session import ensure_checkpoint_dir, materialise, remove_path, shared_path
from chartstreak.sources import json_io, versions
from chartstreak.sources.chart import load_chart
from chartstreak.sources.chart_csv import write_chart_csv
from chartstreak.streaming import stream as st

SF01 = "/root/testdata/sf0.01"
SMALL = forest.ForestParams(num_trees=5, max_depth=4)


def test_batch_job(spark, tmp_path):
    csv = write_chart_csv(spark, load_chart(spark, SF01), corrupt=True)
    out = str(tmp_path / "labelled")
    result = jobs.batch_hit_songs_job(spark, csv, out, run=3)
    rows = json_io.read_labelled_json(spark, out)
    assert rows.count() == result.parsed_records < result.valid_records
    assert rows.where("hit").select("country", "spotifyId").distinct().count() == result.hit_songs_records > 0
    assert not os.path.exists(f"{out}_parsed")


def test_batch_job_with_repeated_days(spark, tmp_path):
    chart = restated_chart(spark, SF01).drop("seq")
    assert streaks.has_repeated_days(chart) and not streaks.has_repeated_days(load_chart(spark, SF01))
    out = str(tmp_path / "labelled")
    result = jobs.batch_hit_songs_job(spark, write_chart_csv(spark, chart), out, run=5)
    want = streaks.detect_hits_ordered(chart, "snapshotDate", run=5).select("country", "spotifyId").collect()
    assert result.hit_songs_records == len(want) > 0
    got = json_io.read_labelled_json(spark, out).where("hit").select("country", "spotifyId").distinct().collect()
    assert sorted(got) == sorted(want)


def test_rows_of_equal_order_give_one_hit(spark):
    chart = restated_chart(spark, SF01).withColumn("always", F.lit(1))
    hits = streaks.detect_hits_ordered(chart, "always", run=3)
    assert hits.count() == hits.select("country", "spotifyId").distinct().count() > 0


def test_streaming_job_report_models_and_documents(spark, tmp_path):
    rows = labelled(spark, SF01)
    src = st.write_daily_files(spark, rows)
    root = str(tmp_path / "ml")
    st.drain(jobs.streaming_ml_job(spark, src, root, available_now=True, params=SMALL))
    report = {r["country"]: r for r in spark.read.json(f"{root}/reports").collect()}
    counts = {r["country"]: r for r in rows.groupBy("country").agg(
        F.count("*").alias("n"), F.count_if("hit").alias("h")).collect()}
    assert set(report) == set(counts)
    for c, r in report.items():
        assert (r["records"], r["hits"]) == (counts[c]["n"], counts[c]["h"])
        assert (r["classifierStatus"] == forest.TRAINED) == (0 < r["hits"] < r["records"])
        if r["kmeansStatus"] == "OK":
            assert [k["cluster"] for k in r["clusters"]] == [1, 2, 3, 4] and all(k["profile"] for k in r["clusters"])
        if r["classifierStatus"] == forest.TRAINED:
            assert [p["sample"] for p in r["predictions"]] == ["any", "hit"]
            assert os.path.isdir(f"{root}/models/country={c}")
    docs = {r["country"]: r for r in json_io.read_importance_docs(spark, f"{root}/importance").collect()}
    assert set(docs) == {c for c, r in report.items() if r["classifierStatus"] == forest.TRAINED}
    folder = versions.current(spark, f"{root}/importance", json_io.FOLDER)[next(iter(docs))]
    name = next(n for n in os.listdir(folder) if n.endswith(".json"))
    assert set(json.loads(open(f"{folder}/{name}").readline())) == {"country", "featureImportances"}
    scored = forest.score(spark, f"{root}/models", rows)
    assert scored.count() == rows.count()


def test_few_long_hits_are_not_broadcast(spark):
    chart = load_chart(spark, SF01)
    hits = streaks.detect_hits(chart, run=3).withColumn(
        "consecutiveHitDaysList", F.array_repeat(F.lit("2024-01-01" * 50), 100))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan(lab.label(chart, hits, broadcast_max_bytes=100_000))
    assert "broadcast" in plan(lab.label(chart, hits))


def test_scratch_is_removable_and_unique(spark):
    root = ensure_checkpoint_dir(spark)
    before = set(os.listdir(root.removeprefix("file:")))
    path = shared_path(spark, "x")
    spark.range(3).write.parquet(path)
    remove_path(spark, path)
    assert set(os.listdir(root.removeprefix("file:"))) == before
    df = materialise(spark.range(5).toDF("n"), "y")
    assert df.count() == 5 and shared_path(spark, "y") != shared_path(spark, "y")


@pytest.mark.parametrize("master", ["local", "local[4]", "spark://host:7077"])
def test_no_local_scratch_on_a_cluster(master):
    class Context:
        def __init__(self):
            self.master = master

        def getCheckpointDir(self):
            return None

        def setCheckpointDir(self, _):
            raise InterruptedError

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(*_):
                return None
    with pytest.raises(ValueError if master.startswith("spark") else InterruptedError):
        ensure_checkpoint_dir(Session)


def test_windowed_job_trains_each_window_once(spark, tmp_path):
    from chartstreak.schemas import LABELLED_SCHEMA
    rows = labelled(spark, SF01).withColumn("part", F.abs(F.hash("spotifyId")) % 3)
    src, root, times = str(tmp_path / "in"), str(tmp_path / "ml"), [0, 10, 50, 60]
    os.makedirs(src)
    parts = [rows.where(F.col("part") == i).drop("part") for i in range(3)]
    for i, part in enumerate(parts):
        made = str(tmp_path / f"made-{i}")
        json_io.write_json_lines(part.coalesce(1), made)
        (name,) = [f for f in os.listdir(made) if f.startswith("part-")]
        os.rename(f"{made}/{name}", f"{src}/{i}.json")
        os.utime(f"{src}/{i}.json", (1_000_000 + i, 1_000_000 + i))
    windows, q = jobs.windowed_ml_job(spark, src, root, delay_ms=30, available_now=True, params=SMALL,
                                      max_files_per_trigger=1, clock=lambda batch, n: times[n])
    st.drain(q)
    windows.finish(LABELLED_SCHEMA)
    reports = spark.read.json(f"{root}/reports").collect()
    # files 0 and 1 arrive within the first window (ends at 30); file 2 at 50 opens the next one
    counts = {(r["country"], r["first"]): (r["n"], r["h"]) for r in rows.groupBy(
        "country", (F.col("part") < 2).alias("first")).agg(F.count("*").alias("n"), F.count_if("hit").alias("h")).collect()}
    got = {(r["country"], r["windowEnd"] == 30): (r["records"], r["hits"]) for r in reports}
    assert len(reports) == len(got) and got == counts
    assert not os.listdir(f"{root}/made")


def test_scratch_tables_go_with_the_finished_result(spark):
    from chartstreak.session import finished, materialise
    paths = []

    def files(df):
        return [f.removeprefix("file://") for f in df.inputFiles()]

    def inner():
        left = materialise(spark.range(10), "scratch-inner")
        paths.extend(files(left))
        return left.where("id % 2 = 0")

    def outer():
        kept = finished(spark, inner, "scratch-middle")
        assert kept.count() == 5 and not any(os.path.exists(p) for p in paths)
        paths.extend(files(kept))
        return kept.selectExpr("id + 1 as id")

    before = materialise(spark.range(3), "scratch-before")
    out = finished(spark, outer, "scratch-result")
    assert sorted(r.id for r in out.collect()) == [1, 3, 5, 7, 9]
    assert len(paths) >= 2 and not any(os.path.exists(p) for p in paths)
    assert before.count() == 3

    def failing():
        paths[:] = files(materialise(spark.range(4), "scratch-failing"))
        raise ValueError("no result")

    with pytest.raises(ValueError):
        finished(spark, failing, "scratch-none")
    assert paths and all(os.path.exists(p) for p in paths)
    assert materialise(spark.range(2), "scratch-after").count() == 2
