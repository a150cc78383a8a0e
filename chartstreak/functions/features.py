"""The 14-feature vector and the hit label, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartstreak.schemas import FEATURE_NAMES


def feature_columns() -> list[Column]:
    """The 14 features as double columns named by ``FEATURE_NAMES``.

    explicit -> 1.0 / 0.0, durationMs -> seconds, everything else widened.
    """
    exprs = {
        "explicit": F.when(F.col("explicit"), F.lit(1.0)).otherwise(F.lit(0.0)),
        "durationSeconds": F.col("durationMs") / F.lit(1000.0),
    }
    return [exprs.get(n, F.col(n).cast("double")).alias(n) for n in FEATURE_NAMES]


def feature_array() -> Column:
    """F8: ``array<double>`` of the 14 features in fixed order."""
    return F.array(*[c for c in feature_columns()])


def label_column(hit_col: str = "hit") -> Column:
    """hit -> 1, otherwise 0."""
    return F.col(hit_col).cast("int")


def features_of(arr: Column) -> dict[str, Column]:
    """Named access to a 14-feature array column (rows or centroids)."""
    return {n: arr[i] for i, n in enumerate(FEATURE_NAMES)}
