"""Per-country training inputs: P6, A4, A6, A7, W6.

All per-country figures are aggregations (partial aggregation map-side), so
a country holding a third of all rows never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: gate statuses ---------------------------------------------
MIN_BATCH = 2
TOO_FEW_ROWS = "TOO_FEW_ROWS"
SKIPPED_ONE_CLASS = "SKIPPED_ONE_CLASS"
TRAIN = "TRAIN"
# ---------------------------------------------------------------------------


def hits_only(labelled: DataFrame) -> DataFrame:
    """Rows labelled hit."""
    return labelled.where(F.col("hit"))


def class_balance(labelled: DataFrame, by: str = "country") -> DataFrame:
    """A4: records, hits and non-hits per country."""
    return labelled.groupBy(by).agg(F.count(F.lit(1)).alias("records"),
                                    F.count_if("hit").alias("hits"),
                                    F.count_if(~F.col("hit")).alias("nonHits"))


def gate_status() -> F.Column:
    return (F.when(F.col("records") < MIN_BATCH, F.lit(TOO_FEW_ROWS))
            .when((F.col("hits") == 0) | (F.col("nonHits") == 0), F.lit(SKIPPED_ONE_CLASS))
            .otherwise(F.lit(TRAIN)))


def training_gate(labelled: DataFrame, by: str = "country") -> DataFrame:
    """A6 + A7: a country trains only with >= 2 rows and both classes."""
    return class_balance(labelled, by).withColumn("gate", gate_status())


def first_of_group(labelled: DataFrame, by: str = "country",
                   order: tuple[str, ...] = ("snapshotDate", "spotifyId")) -> DataFrame:
    """W6 + O2: per country the first hit row and the first row overall.

    "First" is by ``order`` (arrival order is not reproducible). Computed as
    a ``min`` over a struct led by the order columns: an aggregation with a
    map-side partial step, not a window over the whole country.
    """
    rest = [c for c in labelled.columns if c not in order and c != by]
    first = F.min(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest]))
    hit = (labelled.where(F.col("hit")).groupBy(by).agg(first.alias("r"))
           .withColumn("sample", F.lit("hit")))
    anyrow = labelled.groupBy(by).agg(first.alias("r")).withColumn("sample", F.lit("any"))
    both = hit.unionByName(anyrow)
    cols = [c for c in labelled.columns if c != by]
    return both.select(by, "sample", *[F.col(f"r.{c}").alias(c) for c in cols])

