"""Saved forests as a table of trees, and all countries' rows scored in one job.

``packed_forests`` reads the current model of every country in one scan and packs
each tree's nodes into one row. ``walk`` scores blocks of rows with numpy: all
trees step down one level at a time. Class shares of the leaves are added tree by
tree, in the order of the trees, and the first of the highest sums wins, as MLlib
does, so votes and predictions are equal bit by bit.

Rows meet their country's trees in a cogroup by (country, salt). The salt hangs on
a row's place in a written table and grows with the country's rows, so that a
group holds about ``ROWS_PER_GROUP`` rows however large a country is; trees are
repeated once per salt. Nothing is broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartstreak.schemas import FEATURE_NAMES
from chartstreak.session import materialise, workers_import_package
from chartstreak.sources import versions

NO_MODEL, SCORED, INCOMPLETE = "NO_MODEL", "SCORED", "INCOMPLETE"
ROWS_PER_GROUP = 200_000
ROWS_PER_BLOCK = 2_000

NODES_SCHEMA = ("treeID int, nodeData struct<id: int, impurityStats: array<double>, leftChild: int, rightChild: int, "
                "split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>")
GROUP, SALT, SALTS = "_forestGroup", "_forestSalt", "_forestSalts"


def packed_forests(spark: SparkSession, model_root: str, by: str = "country") -> DataFrame:
    """(group, treeID, nodes): one row per tree of each country's current model, nodes by id."""
    found = versions.current(spark, model_root, by)
    schema = T.StructType([*T._parse_datatype_string(NODES_SCHEMA).fields, T.StructField(by, T.StringType()),
                           T.StructField("version", T.StringType())])
    if not found:
        rows = spark.createDataFrame([], schema)
    else:
        rows = spark.read.schema(schema).option("basePath", model_root).parquet(
            *[f"{folder}/data" for _, folder in sorted(found.items())])
    node = F.struct(
        F.col("nodeData.id").alias("id"), F.col("nodeData.split.featureIndex").alias("feature"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.col("nodeData.split.numCategories").alias("categories"), F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"), F.col("nodeData.impurityStats").alias("stats"))
    return rows.groupBy(F.col(by).alias(GROUP), "treeID").agg(F.sort_array(F.collect_list(node)).alias("nodes"))


class Forest:
    """The trees of one country, their nodes end to end."""

    def __init__(self, trees: pa.Table):
        trees = trees.sort_by("treeID")
        nodes = trees["nodes"].combine_chunks()
        sizes = nodes.value_lengths().to_numpy()
        self.roots = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        flat = nodes.flatten()
        field = {f.name: flat.field(i) for i, f in enumerate(flat.type)}
        base = np.repeat(self.roots, sizes)
        if not np.array_equal(field["id"].to_numpy() + base, np.arange(len(base))):
            raise ValueError("nodes of a tree are not numbered from 0 without gaps")
        self.feature = field["feature"].to_numpy()
        if (field["categories"].to_numpy()[self.feature >= 0] >= 0).any():
            raise ValueError("trees with categorical splits are not walked")
        self.threshold = field["threshold"].to_numpy(zero_copy_only=False)
        self.left, self.right = field["left"].to_numpy() + base, field["right"].to_numpy() + base
        stats = field["stats"].flatten().to_numpy().reshape(len(base), -1)
        total = np.zeros(len(base))
        for k in range(stats.shape[1]):
            total = total + stats[:, k]
        self.share = np.divide(stats, total[:, None], out=np.zeros_like(stats), where=total[:, None] != 0)

    def votes(self, x: np.ndarray) -> np.ndarray:
        """Summed class shares of each row of ``x`` (rows x features)."""
        node = np.repeat(self.roots[None, :], len(x), axis=0)
        row = np.arange(len(x))[:, None]
        while True:
            feature = self.feature[node]
            inner = feature >= 0
            if not inner.any():
                break
            left = x[row, np.maximum(feature, 0)] <= self.threshold[node]
            node = np.where(inner, np.where(left, self.left[node], self.right[node]), node)
        votes = np.zeros((len(x), self.share.shape[1]))
        for tree in range(len(self.roots)):
            votes += self.share[node[:, tree]]
        return votes


def walk(rows: pa.Table, trees: pa.Table) -> tuple[pa.Array, pa.Array]:
    """Prediction and status of each row of a group."""
    n = rows.num_rows
    if not trees.num_rows:
        return pa.nulls(n, pa.int32()), pa.array([NO_MODEL] * n, pa.string())
    columns = [rows[name].combine_chunks().cast(pa.float64()) for name in FEATURE_NAMES]
    missing = np.zeros(n, bool)
    for c in columns:
        missing |= c.is_null().to_numpy(zero_copy_only=False)
    x = np.column_stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in columns])
    forest = Forest(trees)
    best = np.zeros(n, np.int32)
    for at in range(0, n, ROWS_PER_BLOCK):
        best[at:at + ROWS_PER_BLOCK] = forest.votes(x[at:at + ROWS_PER_BLOCK]).argmax(axis=1)
    status = pa.array(np.where(missing, INCOMPLETE, SCORED).astype(object), pa.string())
    return pa.array(best, pa.int32(), mask=missing), status


def score_rows(spark: SparkSession, model_root: str, songs: DataFrame, by: str = "country") -> DataFrame:
    """``songs`` (with the 14 features) plus ``prediction`` and ``scoreStatus``, in one job for all countries.

    Rows of a country without a published model are NO_MODEL, rows with a null
    feature INCOMPLETE, both with a null prediction. The current versions are
    packed to the shared folder first: training that publishes or removes versions
    afterwards changes nothing here.
    """
    workers_import_package(spark)
    rows = materialise(songs, "score-in")
    forests = materialise(packed_forests(spark, model_root, by), "forests")
    salts = rows.groupBy(F.col(by).cast("string").alias(GROUP)).agg(
        F.ceil(F.count("*") / ROWS_PER_GROUP).cast("int").alias(SALTS))
    placed = rows.withColumn(GROUP, F.col(by).cast("string")).withColumn(SALT, F.monotonically_increasing_id())
    other = salts.withColumnRenamed(GROUP, f"{GROUP}2")
    dealt = (placed.join(other, F.col(GROUP).eqNullSafe(F.col(f"{GROUP}2")))
             .withColumn(SALT, F.pmod(F.col(SALT), F.col(SALTS)).cast("int")).drop(f"{GROUP}2", SALTS))
    trees = (forests.join(salts, GROUP)
             .withColumn(SALT, F.explode(F.sequence(F.lit(0), F.col(SALTS) - 1))).drop(SALTS))
    names = list(songs.columns)

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        prediction, status = walk(left, right)
        return left.select(names).append_column("prediction", prediction).append_column("scoreStatus", status)

    schema = T.StructType([*rows.schema.fields, T.StructField("prediction", T.IntegerType()),
                           T.StructField("scoreStatus", T.StringType())])
    return dealt.groupBy(GROUP, SALT).cogroup(trees.groupBy(GROUP, SALT)).applyInArrow(apply, schema)
