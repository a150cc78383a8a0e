"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str) -> Column:
    """A text column with null counted as empty."""
    return F.coalesce(F.col(quoted(column)).cast("string"), F.lit(""))


def quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


class Generations:
    """A bounded memo: a full young generation becomes the old one; hits in the old one are renewed."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def get(self, key):
        value = self.young.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if len(self.young) >= self.most:
            self.old, self.young = self.young, {}
        self.young[key] = value
