"""A random-forest hit classifier per country (MLlib).

Training rows are written once to the shared folder, partitioned by country
(repartitioned by country and a salt first, so a large country is spread over
tasks and a small one is one file); each country's fit reads only its
partition (partition pruning) and runs as an ordinary distributed MLlib job.
Fits for different countries are submitted from a bounded thread pool; a fit
that fails marks its country FAILED and leaves the others alone. Every model is
saved as a version below ``model_root/country=XX`` and published when it is whole
(``sources/versions.py``), so a later job can load it while the country is trained
again. Only models and their 14 importances (countries x 14 numbers) reach the
driver. Scores of all countries come from one job (``forest_table.py``).

Sizes are the usual library defaults of the reference (500 trees, depth 20,
leaves of 5 rows or more) and parameters.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartstreak.functions.features import feature_columns, label_column
from chartstreak.functions.profile import prediction_text
from chartstreak.operators import classify
from chartstreak.operators.forest_table import NO_MODEL, SCORED, score_rows  # noqa: F401
from chartstreak.operators.importance import percent_normalise
from chartstreak.schemas import FEATURE_NAMES
from chartstreak.session import materialise, shared_path
from chartstreak.sources import versions

TRAINED, FAILED = "TRAINED", "FAILED"
ROWS_PER_FILE = 200_000


@dataclass
class ForestParams:
    num_trees: int = 500
    max_depth: int = 20
    min_leaf: int = 5
    seed: int = 42
    parallelism: int = 4          # concurrent per-country fits
    extra: dict = field(default_factory=dict)


def _by_country(rows: DataFrame, by: str) -> DataFrame:
    """Rows dealt by country and a salt that grows with the country's rows.

    The salt hangs on the row, the number of partitions is fixed and each is
    sorted by all columns: files are the same in every run, and a task that runs
    again after a lost executor deals its rows as before. So bags of a seeded
    forest are the same too.
    """
    counts = rows.groupBy(by).agg(F.ceil(F.count("*") / ROWS_PER_FILE).cast("int").alias("_files"))
    salt = F.pmod(F.xxhash64("spotifyId", "snapshotDate"), F.col("_files")).cast("int")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.join(counts, by).withColumn("_salt", salt).repartition(parts, by, "_salt").drop("_files", "_salt")
    return dealt.sortWithinPartitions(by, *[c for c in rows.columns if c != by])


def training_table(spark: SparkSession, labelled: DataFrame, path: str | None = None,
                   by: str = "country") -> str:
    """Write (by, spotifyId, snapshotDate, 14 features, label) partitioned by ``by``."""
    path = path or shared_path(spark, "forest-train")
    rows = labelled.select(by, "spotifyId", "snapshotDate", "name", *feature_columns(),
                           label_column().alias("label"))
    _by_country(rows, by).write.mode("overwrite").partitionBy(by).parquet(path)
    return path


def _assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=FEATURE_NAMES, outputCol="features")


def _rows_of(spark: SparkSession, path: str, country: str, by: str) -> DataFrame:
    # partition values are read as text, whatever they look like
    schema = spark.read.parquet(path).schema
    schema = T.StructType([T.StructField(by, T.StringType()) if f.name == by else f for f in schema.fields])
    return spark.read.schema(schema).parquet(path).where(F.col(by) == country)


def fit_country(spark: SparkSession, train_path: str, country: str, params: ForestParams,
                by: str = "country") -> RandomForestClassificationModel:
    rf = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=params.num_trees,
                                maxDepth=params.max_depth, minInstancesPerNode=params.min_leaf,
                                seed=params.seed, **params.extra)
    return rf.fit(_assembler().transform(_rows_of(spark, train_path, country, by)))


@dataclass
class ForestRun:
    train_path: str
    gate: DataFrame                                   # (country, records, hits, nonHits, gate)
    models: dict[str, RandomForestClassificationModel]
    model_path: str
    status: DataFrame                                 # (country, classifierStatus)
    errors: dict[str, str]


def train_per_country(spark: SparkSession, labelled: DataFrame, params: ForestParams | None = None,
                      model_root: str | None = None, by: str = "country",
                      keep_versions: int = versions.KEEP) -> ForestRun:
    """L3 (+A6/A7 gates, S9): fit one forest per country that passes the gate.

    ``model_root``: where models are kept, one folder per country with its newest
    ``keep_versions`` versions; a fresh folder of the run if not given. A country
    whose fit fails keeps the version it had.
    """
    params = params or ForestParams()
    gate = materialise(classify.training_gate(labelled, by), "gate")
    train_path = training_table(spark, labelled, by=by)
    countries = [r[by] for r in gate.where(F.col("gate") == classify.TRAIN).select(by).collect()]
    # Models are used as re-loaded: a freshly fitted model keeps its training
    # summary, which refers back to the session, and once the session has run
    # an Observation that reference can no longer be serialised when
    # transform() broadcasts the model. A loaded model carries no summary.
    model_path = model_root or shared_path(spark, "forest-models")
    version = versions.next_version(spark, model_path, by)
    errors: dict[str, str] = {}

    def fit(c):
        try:
            m = fit_country(spark, train_path, c, params, by)
            folder = f"{versions.group_folder(spark, model_path, by, c)}/version={version}"
            m.save(folder)
            loaded = RandomForestClassificationModel.load(folder)
            versions.publish(spark, model_path, by, c, version, keep_versions)
            return c, loaded
        except Exception as e:  # noqa: BLE001  one country's failure is its status, as in the reference
            errors[c] = str(e)[:500]
            return c, None

    with ThreadPoolExecutor(max_workers=max(1, params.parallelism)) as pool:
        models = {c: m for c, m in pool.map(fit, sorted(countries)) if m is not None}
    outcome = spark.createDataFrame([(c, TRAINED if c in models else FAILED) for c in countries],
                                    f"{by} string, outcome string")
    status = gate.join(outcome, by, "left").select(by, F.coalesce("outcome", "gate").alias("classifierStatus"))
    return ForestRun(train_path, gate, models, model_path, status, errors)


def importances(spark: SparkSession, run: ForestRun, by: str = "country") -> DataFrame:
    """L4: (country, pos, feature, importance %) with A5 normalisation."""
    rows = [(c, i, n, float(m.featureImportances[i]))
            for c, m in sorted(run.models.items()) for i, n in enumerate(FEATURE_NAMES)]
    raw = spark.createDataFrame(rows, f"{by} string, pos int, feature string, raw double")
    return percent_normalise(raw, by)


def load_model(spark: SparkSession, model_root: str, country: str, by: str = "country"):
    """The country's current model, None if it has none."""
    folder = versions.current(spark, model_root, by).get(country)
    return folder and RandomForestClassificationModel.load(folder)


def predicted_by_model(model: RandomForestClassificationModel, songs: DataFrame) -> DataFrame:
    """``songs`` of one country scored by the model itself (all features must be there)."""
    if "durationSeconds" not in songs.columns:
        songs = songs.withColumn("durationSeconds", F.col("durationMs") / 1000.0)
    out = model.transform(_assembler().transform(songs))
    return out.select(*songs.columns, F.col("prediction").cast("int").alias("prediction"), "rawPrediction")


def score(spark: SparkSession, model_root: str, songs: DataFrame, by: str = "country") -> DataFrame:
    """Every row of ``songs`` (chart rows or rows with the 14 features) with its country's prediction.

    Adds ``prediction`` (int), ``predictionText`` and ``scoreStatus``. Rows of a
    country without a saved model keep a null prediction and NO_MODEL, rows with a
    null feature a null prediction and INCOMPLETE. All countries are scored in one
    job, with the versions that are current when ``score`` is called.
    """
    if "durationSeconds" not in songs.columns:
        songs = songs.withColumn("durationSeconds", F.col("durationMs") / 1000.0)
    text = F.when(F.col("prediction").isNotNull(), prediction_text(F.col("prediction")))
    return score_rows(spark, model_root, songs, by).select(
        *songs.columns, "prediction", text.alias("predictionText"), "scoreStatus")


def predict_samples(spark: SparkSession, run: ForestRun, labelled: DataFrame, by: str = "country") -> DataFrame:
    """L5 + F27: the first hit and first row of each trained country, predicted."""
    samples = classify.first_of_group(labelled, by).select(
        by, "sample", "spotifyId", "name", "snapshotDate", *feature_columns())
    scored = score(spark, run.model_path, materialise(samples, "samples"), by)
    return scored.where(F.col("scoreStatus") == SCORED).select(
        by, "sample", "spotifyId", "name", "prediction", "predictionText")


def score_summary(scored: DataFrame, by: str = "country") -> DataFrame:
    """Rows, actual hits, predicted hits and correct predictions per country (needs ``label``)."""
    right = F.col("prediction") == F.col("label").cast("int")
    return scored.groupBy(by).agg(F.count("*").alias("rows"), F.sum("label").cast("bigint").alias("actualHits"),
                                  F.sum("prediction").cast("bigint").alias("predictedHits"),
                                  F.count_if(right).alias("correct"))
