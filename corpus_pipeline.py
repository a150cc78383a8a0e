"""Documents to packed training sequences, one operator of ``chartstreak.llm`` per stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its output is
written to the shared folder as Parquet and read back as the next stage's
documents. All stages but the last return the columns of ``documents``. A stage's
scratch tables are removed once its output is written.

1. language ID: documents whose language is ``und`` go (no letter, or hardly
   any n-gram of a learned language). The model learns from the labelled
   documents of its own input.
2. exact dedup: of equal texts the row with the largest id stays.
3. MinHash near-dedup: five-word shingles, similarity 0.8; the smallest id of
   each group stays.
4. substring dedup: repeated passages go from all but their first document;
   ``n_chars`` is that of the remaining text.
5. best-fit packing: the pieces of all remaining texts, placed in sequences.

Null texts, empty tables, repeated rows and extra columns are handled as each
operator's module says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartstreak.llm.exact_dedup import drop_exact_copies
from chartstreak.llm.language_id import keep_known_languages, learn
from chartstreak.llm.minhash_dedup import drop_near_duplicates
from chartstreak.llm.packing import pack_documents
from chartstreak.llm.substring_dedup import remove_repeats
from chartstreak.session import finished


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_known_languages(docs, learn(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_copies(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = remove_repeats(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("minhash_near_dedup", minhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]

# Tokenisation and learned decisions are not SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = finished(spark, lambda: stage(spark, docs, sf_dir), f"stage-{name}")  # noqa: B023
    return STAGES[-1][1](spark, docs, sf_dir)
