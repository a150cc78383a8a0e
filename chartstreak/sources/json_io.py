"""JSON lines and importance documents.

Rows become JSON lines with ISO dates (``to_json``); JSON lines become typed
rows with ``from_json``. ``strict=True`` reproduces a strict object mapper:
a malformed line, a value of the wrong type or an unknown key fails the job,
it is not silently nulled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartstreak.schemas import IMPORTANCE_SCHEMA, LABELLED_FIELDS, LABELLED_SCHEMA
from chartstreak.sources import versions

JSON_OPTIONS = {"dateFormat": "yyyy-MM-dd"}


def to_json_lines(df: DataFrame) -> DataFrame:
    """One ``value`` JSON line per row, keys in column order."""
    return df.select(F.to_json(F.struct(*df.columns), JSON_OPTIONS).alias("value"))


def from_json_lines(lines: DataFrame, schema: T.StructType = LABELLED_SCHEMA,
                    strict: bool = True, line_col: str = "value") -> DataFrame:
    """S3: JSON lines -> typed rows, batch or stream.

    Strict mode fails the job on a malformed line, on a value of the wrong
    type and on an unknown key; otherwise such values become null.
    """
    line = F.col(line_col)
    parsed = F.from_json(line, schema, {**JSON_OPTIONS, "mode": "FAILFAST" if strict else "PERMISSIVE"})
    if strict:
        known = F.array(*[F.lit(f.name) for f in schema.fields])
        keys = F.json_object_keys(line)
        bad = keys.isNull() | (F.size(F.array_except(keys, known)) > 0)
        message = F.concat(F.lit("bad JSON line: "), F.substring(line, 1, 200))
        parsed = F.when(bad, F.raise_error(message)).otherwise(parsed)
    out = lines.select(parsed.alias("r"))
    return out.select(*[F.col(f"r.{f.name}").alias(f.name) for f in schema.fields])


def write_json_lines(df: DataFrame, path: str, max_records_per_file: int = 1_000_000) -> str:
    """Row-format JSON sink; files roll by number of records (``maxRecordsPerFile``)."""
    (df.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
       .options(**JSON_OPTIONS).json(path))
    return path


def stream_json_lines(stream: DataFrame, path: str, checkpoint: str, roll: str = "15 minutes",
                      max_records_per_file: int = 1_000_000, available_now: bool = False):
    """S5 on a stream: files roll with the trigger (``roll``) and by number of records; exactly once.

    A trigger without new rows writes no file, so an inactive stream leaves its last file closed.
    """
    writer = (stream.writeStream.format("json").options(**JSON_OPTIONS).option("path", path)
              .option("maxRecordsPerFile", max_records_per_file)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=roll)).start()


def read_labelled_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LABELLED_SCHEMA).options(**JSON_OPTIONS).json(path).select(*LABELLED_FIELDS)


def write_importance_docs(docs: DataFrame, path: str) -> str:
    """One document {country, featureImportances} per country under ``path/countryFolder=XX``.

    Dynamic partition overwrite replaces only the countries present in
    ``docs``; other countries' documents stay.
    """
    (docs.withColumn("countryFolder", F.col("country")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("countryFolder").json(path))
    return path


FOLDER = "countryFolder"


def publish_importance_docs(docs: DataFrame, path: str, keep: int = versions.KEEP) -> str:
    """S8 for readers that do not wait: each country's document is a new version, published when written.

    Countries that are not in ``docs`` keep theirs.
    """
    spark = docs.sparkSession
    version = versions.next_version(spark, path, FOLDER)
    (docs.withColumn(FOLDER, F.col("country")).withColumn("version", F.lit(version))
         .write.mode("append").partitionBy(FOLDER, "version").json(path))
    for country in versions.groups(spark, path, FOLDER):
        if f"version={version}" in versions.versions(spark, path, FOLDER, country):
            versions.publish(spark, path, FOLDER, country, version, keep)
    return path


def read_importance_docs(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """All documents as (country, featureImportances); of published ones each country's current version."""
    published = list(versions.current(spark, path, FOLDER).values())
    r = spark.read.schema(IMPORTANCE_SCHEMA).option("multiLine", multiline).json(published or path)
    return r.select("country", "featureImportances")
