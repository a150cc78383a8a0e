"""Exact dedup: tree merge of digest runs, DataFrame operations only.

Every row is dealt to one of ``fan_in ** rounds`` runs by its row number.
Round by round, ``fan_in`` neighbouring runs (``run``, ``run ^ 1``, ... as in
a binomial tree) are merged: rows of equal digest become one row with the
surviving identifier and the number of texts below it. After the last round
one row per digest is left. The verdict travels the same tree downwards: each
merged row hands it to at most ``fan_in`` rows of the round below, and a leaf
row to its own documents. A digest that holds a third of all rows is therefore
spread over all runs both on the way up and on the way down.

A digest is SHA-256 of the text in UTF-8 together with its byte length; both
are compared at every level, so rows are only merged on verified digests.

Defined results: null text counts as empty, empty texts are equal to each
other, the survivor of a group is the row with the largest (or smallest) id,
null ids lose against any id, and of repeated rows (same id, same text) exactly
one is kept. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartstreak.llm.common import fresh, quoted, table, text_of
from chartstreak.session import materialise

DIGEST = ["digest", "n_bytes"]


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "largest", fan_in: int = 16, rounds: int = 2) -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    runs = fan_in ** rounds
    text = text_of(text_col)
    rows = materialise(
        docs.select(F.col(quoted(id_col)).alias("id"), F.sha2(text, 256).alias("digest"),
                    F.octet_length(text).alias("n_bytes"), F.monotonically_increasing_id().alias("row")),
        "digest-rows").withColumn("run", F.pmod(F.xxhash64("row"), F.lit(runs)))
    # null ids sort first for "largest"; for "smallest" they are ranked behind every id
    rank = F.struct(F.col("id").isNotNull().alias("has"), "id", "row") if keep == "largest" else \
        F.struct(F.col("id").isNull().alias("has"), "id", "row")
    best = F.max if keep == "largest" else F.min
    level = rows.groupBy("run", *DIGEST).agg(best(rank).alias("best"), F.count("*").alias("size"))
    level = materialise(level, "digest-runs")
    levels = [level]
    for _ in range(rounds):
        level = (level.withColumn("run", F.floor(F.col("run") / fan_in)).groupBy("run", *DIGEST)
                 .agg(best("best").alias("best"), F.sum("size").alias("size")))
        levels.append(level)
    verdict = level
    for below in reversed(levels[:-1]):
        child = below.select(F.col("run").alias("low"), F.floor(F.col("run") / fan_in).alias("run"), *DIGEST)
        verdict = child.join(verdict, ["run", *DIGEST]).select(F.col("low").alias("run"), *DIGEST, "best", "size")
    return rows.join(verdict, ["run", *DIGEST]).select(
        F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"), F.col("digest").alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      keep: str = "largest") -> DataFrame:
    """The documents that ``exact_dedup`` keeps, with all their columns, repeated rows once."""
    id_, sha, its = fresh(docs, "kept_id"), fresh(docs, "kept_sha256"), fresh(docs, "own_sha256")
    kept = (exact_dedup(docs, id_col, text_col, keep).where("kept")
            .select(F.col(quoted(id_col)).alias(id_), F.col("text_sha256").alias(its)))
    marked = docs.withColumn(sha, F.sha2(text_of(text_col), 256))
    joined = marked.join(kept, F.col(quoted(id_col)).eqNullSafe(F.col(id_)) & (F.col(sha) == F.col(its)))
    return joined.dropDuplicates([id_, sha]).select(*[joined[quoted(c)] for c in docs.columns])


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


OP3_SQL = """
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
       doc_id = max(doc_id) over w as kept, sha256(coalesce(text, '')) as text_sha256
from documents window w as (partition by coalesce(text, ''))"""
