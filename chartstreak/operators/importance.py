"""Feature-importance tables.

Importances are kept long, one row per (country, feature); documents are the
nested form ``{country, featureImportances: map}`` in fixed feature order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartstreak.functions.features import feature_columns
from chartstreak.schemas import FEATURE_NAMES


def percent_normalise(raw: DataFrame, by: str = "country", value: str = "raw") -> DataFrame:
    """A5: value / total * 100, rounded half-up to 2 decimals; NaN total -> 0.

    The total is a sum over the country's 14 feature rows (a window over a
    bounded group of 14 rows).
    """
    total = F.sum(value).over(Window.partitionBy(by))
    pct = F.when(total != 0, F.col(value) / total * F.lit(100.0))
    rounded = F.floor(pct * F.lit(100.0) + F.lit(0.5)) / F.lit(100.0)
    return (raw.withColumn("importance", F.when(F.isnan(pct) | pct.isNull(), F.lit(0.0))
                           .otherwise(rounded))
               .drop(value))


def mean_gap_scores(labelled: DataFrame, by: str = "country") -> DataFrame:
    """Deterministic raw per-feature scores: |mean(hit) - mean(non-hit)| / (max - min).

    A reproducible stand-in for a learner's importances, so the document
    operators can be checked exactly. One aggregation pass (partial
    aggregation map-side), then a 14-way unpivot of one row per country.
    """
    feats = labelled.select(by, "hit", *feature_columns())
    aggs = []
    for n in FEATURE_NAMES:
        aggs += [F.avg(F.when(F.col("hit"), F.col(n))).alias(f"{n}__h"),
                 F.avg(F.when(~F.col("hit"), F.col(n))).alias(f"{n}__n"),
                 (F.max(n) - F.min(n)).alias(f"{n}__r")]
    stats = feats.groupBy(by).agg(*aggs)
    score = {n: F.coalesce(F.when(F.col(f"{n}__r") > 0,
                                  F.abs(F.col(f"{n}__h") - F.col(f"{n}__n")) / F.col(f"{n}__r")),
                           F.lit(0.0))
             for n in FEATURE_NAMES}
    entries = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(n).alias("feature"),
                                 score[n].alias("raw")) for i, n in enumerate(FEATURE_NAMES)])
    return (stats.select(by, F.inline(entries)))


def to_documents(long: DataFrame, by: str = "country") -> DataFrame:
    """M4: (country, feature, importance) -> {country, featureImportances}.

    Map entries follow the fixed feature order (``pos``).
    """
    entries = F.array_sort(F.collect_list(F.struct("pos", "feature", "importance")))
    return (long.groupBy(by).agg(entries.alias("e"))
            .select(by, F.map_from_arrays(F.col("e.feature"), F.col("e.importance"))
                    .alias("featureImportances")))


def unpivot(docs: DataFrame) -> DataFrame:
    """M1: one row per (country, feature, importance), in map order."""
    return docs.select("country", F.posexplode("featureImportances").alias("pos", "feature", "importance"))


def keys(docs: DataFrame) -> DataFrame:
    """M2: the characteristic names of each document, with position."""
    return docs.select("country", F.posexplode(F.map_keys("featureImportances")).alias("pos", "feature"))


def search(docs: DataFrame, text: str) -> DataFrame:
    """Countries whose code contains ``text``, case-insensitive."""
    return docs.where(F.lower(F.col("country")).contains(text.lower()))


def compare(docs: DataFrame, countries: list[str], characteristic: str | None = None) -> DataFrame:
    """P9 + M3: selected countries x characteristic(s).

    With ``characteristic`` one row per selected country and its value;
    without, a pivot: one row per characteristic, one column per country.
    """
    sel = docs.where(F.col("country").isin(countries))
    if characteristic is not None:
        return sel.select("country", F.col("featureImportances")[characteristic].alias(characteristic))
    return (unpivot(sel).groupBy("pos", "feature").pivot("country", countries)
            .agg(F.first("importance")))


def as_columns(docs: DataFrame) -> DataFrame:
    """S11 lookup: one row per country, one column per feature."""
    return docs.select("country", *[F.col("featureImportances")[n].alias(n) for n in FEATURE_NAMES])
