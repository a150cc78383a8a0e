"""ML invariants: importances, gates, determinism, K-Means edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartstreak.operators import classify, forest, forest_table, importance, kmeans
from chartstreak.plans.queries import labelled
from chartstreak.schemas import CHART_SCHEMA, FEATURE_NAMES
from chartstreak.sources import json_io, versions

SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def lab(spark):
    return labelled(spark, SF01).checkpoint(eager=True)


@pytest.fixture(scope="module")
def run(spark, lab):
    return forest.train_per_country(spark, lab, forest.ForestParams(num_trees=10, max_depth=5))


def test_importances(spark, run):
    imp = forest.importances(spark, run)
    per = imp.groupBy("country").agg(F.count(F.lit(1)).alias("n"), F.sum("importance").alias("s")).collect()
    assert per
    for r in per:
        assert r["n"] == len(FEATURE_NAMES)
        assert abs(r["s"] - 100.0) <= 0.1


def test_same_seed_same_importances(spark, lab, run):
    again = forest.train_per_country(spark, lab, forest.ForestParams(num_trees=10, max_depth=5))
    a = sorted(forest.importances(spark, run).collect())
    b = sorted(forest.importances(spark, again).collect())
    assert a == b


def test_gates(spark):
    rows = [("A", "s1", True), ("B", "s1", True), ("B", "s2", True), ("C", "s1", False), ("C", "s2", True)]
    df = spark.createDataFrame(rows, "country string, spotifyId string, hit boolean")
    g = {r["country"]: r["gate"] for r in classify.training_gate(df).collect()}
    assert g == {"A": classify.TOO_FEW_ROWS, "B": classify.SKIPPED_ONE_CLASS, "C": classify.TRAIN}


def _rows(spark, spec):
    """spec: (country, song, day, hit, danceability) -> labelled-like rows."""
    import datetime as dt
    data = []
    for c, s, d, hit, dance in spec:
        data.append((s, s, 1, c, dt.date(2024, 1, d), False, 200000, dance, 0.5, 1, -6.0, 1, 0.1, 0.2,
                     0.0, 0.1, 0.5, 120.0, 4, hit))
    schema = T.StructType(CHART_SCHEMA.fields + [T.StructField("hit", T.BooleanType())])
    return spark.createDataFrame(data, schema)


def test_kmeans_fewer_songs_than_k(spark):
    spec = [("X", f"s{i}", 1, True, 0.1 * i) for i in range(3)] + [("Y", f"s{i}", 1, True, 0.1 * i)
                                                                    for i in range(6)]
    spec += [("Z", "s0", 1, False, 0.5)]
    cents, status = kmeans.grouped_kmeans(_rows(spark, spec), k=4)
    st = {r["country"]: r["kmeansStatus"] for r in status.collect()}
    assert st == {"X": kmeans.FAILED, "Y": kmeans.OK, "Z": kmeans.NO_HITS}
    assert sorted(r["cluster"] for r in cents.where("country = 'Y'").collect()) == [1, 2, 3, 4]
    assert cents.where("country = 'X'").count() == 0


def test_kmeans_separates_clusters(spark):
    spec = [("Q", f"a{i}", 1, True, 0.0) for i in range(4)] + [("Q", f"b{i}", 1, True, 1.0) for i in range(4)]
    cents, _ = kmeans.grouped_kmeans(_rows(spark, spec), k=2)
    d = sorted(round(r["f"][2], 6) for r in cents.collect())
    assert d == [0.0, 1.0]


def test_separable_fixture_trains_well(spark):
    spec = [("S", f"h{i}", 1 + i % 28, True, 0.9) for i in range(200)]
    spec += [("S", f"n{i}", 1 + i % 28, False, 0.1) for i in range(200)]
    df = _rows(spark, spec)
    run = forest.train_per_country(spark, df, forest.ForestParams(num_trees=10, max_depth=4))
    labelled_rows = df.withColumn("label", F.col("hit").cast("int"))
    scored = forest.score_summary(forest.score(spark, run.model_path, labelled_rows)).first()
    assert scored["correct"] / scored["rows"] >= 0.95


def test_predict_samples(spark, lab, run):
    p = forest.predict_samples(spark, run, lab).collect()
    assert p and all(r["predictionText"] in ("a HIT.", "not a HIT.") for r in p)


def test_rows_without_a_model_keep_their_place(spark, run):
    rows = _rows(spark, [("nowhere", "s1", 1, False, 0.5), ("nowhere", "s2", 2, False, 0.5)])
    out = forest.score(spark, run.model_path, rows).collect()
    assert [(r["prediction"], r["predictionText"], r["scoreStatus"]) for r in out] == [(None, None, forest.NO_MODEL)] * 2
    assert forest.score(spark, run.model_path, rows.limit(0)).collect() == []


def _keyed(rows):
    return {(r["country"], r["spotifyId"], r["snapshotDate"], r["dailyRank"]): r["prediction"] for r in rows}


def test_one_pass_equals_each_model(spark, lab, run, monkeypatch):
    """Every row of every country, also when a country is dealt over many groups."""
    want = {}
    for c, m in run.models.items():
        want |= _keyed(forest.predicted_by_model(m, lab.where(F.col("country") == c)).collect())
    assert len(run.models) > 1 and set(want.values()) == {0, 1}
    for most in (200_000, 40):
        monkeypatch.setattr(forest_table, "ROWS_PER_GROUP", most)
        scored = forest.score(spark, run.model_path, lab)
        assert _keyed(scored.where("scoreStatus = 'SCORED'").collect()) == want


def test_votes_equal_the_models_bit_by_bit(spark, lab, run):
    country, model = sorted(run.models.items())[0]
    rows = forest.predicted_by_model(model, lab.where(F.col("country") == country)).collect()
    packed = forest_table.packed_forests(spark, run.model_path).where(F.col(forest_table.GROUP) == country)
    x = np.array([[float(r[n]) for n in FEATURE_NAMES] for r in rows])
    votes = forest_table.Forest(packed.toArrow()).votes(x)
    assert votes.tolist() == [r["rawPrediction"].toArray().tolist() for r in rows]


def test_scoring_keeps_every_row_and_type(spark, lab, run):
    """Null countries, null features, repeated rows, names of inner columns and other types go through."""
    c = sorted(run.models)[0]
    rows = lab.where(F.col("country") == c).limit(5)
    odd = (rows.unionByName(rows).unionByName(rows.withColumn("country", F.lit(None).cast("string")))
           .unionByName(rows.withColumn("tempo", F.lit(None).cast("double")))
           .withColumn("salt", F.lit("x")).withColumn("_salt", F.create_map(F.lit("a"), F.lit(1)))
           .withColumn("at", F.lit("2024-01-01 10:00:00").cast("timestamp")))
    out = forest.score(spark, run.model_path, odd)
    assert out.columns[:len(odd.columns)] == odd.columns
    got = out.collect()
    assert sorted(r["scoreStatus"] for r in got) == sorted(
        [forest.SCORED] * 10 + [forest.NO_MODEL] * 5 + [forest_table.INCOMPLETE] * 5)
    assert all((r["prediction"] is None) == (r["scoreStatus"] != forest.SCORED) for r in got)
    assert {r["at"] for r in got} == {odd.first()["at"]} and all(r["_salt"] == {"a": 1} for r in got)


def test_one_job_scores_all_countries(spark, lab, run):
    """The plan holds one cogroup however many countries there are, and no broadcast of models."""
    plan = forest.score(spark, run.model_path, lab)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("CoGroup") == 1


def test_scoring_reads_one_version_while_countries_are_trained_again(spark, lab, tmp_path):
    """Rows scored after a second training published (and removed) versions are those of the first."""
    root = str(tmp_path / "models")
    first = forest.train_per_country(spark, lab, forest.ForestParams(num_trees=3, max_depth=3), root, keep_versions=1)
    scored = forest.score(spark, root, lab)
    before = _keyed(scored.collect())
    turned = lab.withColumn("hit", ~F.col("hit"))
    second = forest.train_per_country(spark, turned, forest.ForestParams(num_trees=3, max_depth=3), root, keep_versions=1)
    assert set(second.models) == set(first.models)
    assert _keyed(scored.collect()) == before
    assert _keyed(forest.score(spark, root, lab).collect()) != before
    assert all(len(versions.versions(spark, root, "country", c)) == 1 for c in first.models)


def test_a_writer_that_dies_leaves_the_version_before(spark, lab, tmp_path, monkeypatch):
    root = str(tmp_path / "models")
    small = forest.ForestParams(num_trees=3, max_depth=3)
    run = forest.train_per_country(spark, lab, small, root)
    current = versions.current(spark, root, "country")

    def dies(*_):
        raise RuntimeError("power cut")
    with monkeypatch.context() as m:
        m.setattr(versions, "publish", dies)
        again = forest.train_per_country(spark, lab.withColumn("hit", ~F.col("hit")), small, root)
    assert not again.models and set(again.errors.values()) == {"power cut"}
    assert versions.current(spark, root, "country") == current
    assert forest.load_model(spark, root, sorted(run.models)[0]).getNumTrees == 3
    assert forest.load_model(spark, root, "nowhere") is None
    third = forest.train_per_country(spark, lab, small, root, keep_versions=1)
    assert set(third.models) == set(run.models)
    assert all(len(versions.versions(spark, root, "country", c)) == 1 for c in third.models)


def test_published_documents(spark, tmp_path):
    """A country's document changes at once, others stay; names that are no folder names go through."""
    path = str(tmp_path / "docs")

    def docs(values):
        rows = [(c, i, n, v) for c, v in values.items() for i, n in enumerate(FEATURE_NAMES)]
        return importance.to_documents(spark.createDataFrame(rows, "country string, pos int, feature string, importance double"))

    def read():
        return {r["country"]: r["featureImportances"][FEATURE_NAMES[0]] for r in json_io.read_importance_docs(spark, path).collect()}
    json_io.publish_importance_docs(docs({"AA": 1.0, "b/c=d": 2.0}), path)
    before = json_io.read_importance_docs(spark, path)
    json_io.publish_importance_docs(docs({"AA": 3.0}), path)
    assert read() == {"AA": 3.0, "b/c=d": 2.0}
    assert sorted(r["featureImportances"][FEATURE_NAMES[0]] for r in before.collect()) == [1.0, 2.0]
    for v in range(5):
        json_io.publish_importance_docs(docs({"AA": float(v)}), path, keep=2)
    assert read() == {"AA": 4.0, "b/c=d": 2.0}
    assert len(versions.versions(spark, path, json_io.FOLDER, "AA")) == 2


def test_one_failing_fit_is_a_status(spark, lab, monkeypatch):
    real = forest.fit_country

    def fit(spark_, path, country, *args):
        if country == "click":
            raise RuntimeError("no luck")
        return real(spark_, path, country, *args)
    monkeypatch.setattr(forest, "fit_country", fit)
    done = forest.train_per_country(spark, lab, forest.ForestParams(num_trees=3, max_depth=2))
    status = {r["country"]: r["classifierStatus"] for r in done.status.collect()}
    assert status["click"] == forest.FAILED and done.errors == {"click": "no luck"}
    assert all(s == forest.TRAINED for c, s in status.items() if c in done.models)
    assert set(done.models) == {c for c, s in status.items() if s == forest.TRAINED}


def test_equal_vectors_are_no_start_points(spark):
    spec = [("X", f"s{i}", 1, True, 0.3) for i in range(9)]
    _, status = kmeans.grouped_kmeans(_rows(spark, spec), k=4)
    assert status.first()["kmeansStatus"] == kmeans.FAILED


def test_spread_starts_cost_less_than_the_first(spark):
    """Wide chart: k vectors that lie apart cost no more than the first k, before and after the iterations."""
    wide = labelled(spark, SF01, wide=True, top_n=10, run=2).checkpoint(eager=True)
    points = kmeans.kmeans_points(wide).checkpoint(eager=True)

    def costs(centroids):
        return {r["country"]: r["cost"] for r in kmeans.total_cost(points, centroids).collect()}
    first, spread = costs(kmeans.initial_centroids(points, 4)), costs(kmeans.spread_centroids(points, 4))
    assert set(first) == set(spread) and first
    assert all(spread[c] <= first[c] for c in first)
    again = kmeans.spread_centroids(points.repartition(7), 4)
    assert {c: round(x, 6) for c, x in costs(again).items()} == {c: round(x, 6) for c, x in spread.items()}
    done = [sum(costs(kmeans.grouped_kmeans(wide, start=s)[0]).values()) for s in ("spread", "first")]
    assert done[0] <= done[1]


def test_spread_starts_of_few_vectors(spark):
    """Fewer candidates than k are filled from all vectors; fewer vectors than k fail as before."""
    spec = [("Y", f"s{i}", 1, True, 0.1 * i) for i in range(4)] + [("X", f"s{i}", 1, True, 0.1 * i) for i in range(3)]
    spec += [("H", f"s{i % 5}", 1 + i % 28, True, 0.1 * (i % 5)) for i in range(400)] + [("Z", "s", 1, False, 0.1)]
    cents, status = kmeans.grouped_kmeans(_rows(spark, spec), k=4, start="spread")
    assert {r["country"]: r["kmeansStatus"] for r in status.collect()} == {
        "X": kmeans.FAILED, "Y": kmeans.OK, "H": kmeans.OK, "Z": kmeans.NO_HITS}
    found = {}
    for r in cents.collect():
        found.setdefault(r["country"], []).append(r["cluster"])
    assert {c: sorted(n) for c, n in found.items()} == {"Y": [1, 2, 3, 4], "H": [1, 2, 3, 4]}
