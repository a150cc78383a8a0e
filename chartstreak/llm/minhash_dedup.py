"""MinHash near-dedup with odd sketches.

1. Every text becomes its set of distinct word shingles (64-bit hashes), a
   MinHash of ``BANDS * ROWS`` samples cut into bands, and an odd sketch: the
   samples toggle bits of a ``SKETCH_BITS`` bitmap, so the XOR of two sketches
   counts the samples in which they differ, most precisely when few do.
2. Texts with equal sets are folded to one class (a partially aggregated
   group), so thousands of copies cost one row from here on.
3. Classes that share a band meet in buckets. Hashes and ids are shuffled
   first; only buckets of two or more classes fetch sketches. A bucket is dealt
   to blocks, each pair of blocks is one unit of work, and in it sketches are
   compared by population counts. The estimate admits a pair well below the
   threshold (``ADMIT``, about five standard deviations), and what leaves the
   unit is one row per admitted class (its smallest partner by connection), not
   the pairs. Their components are the candidate groups.
4. In each candidate group, again in pairs of blocks, admitted pairs that are
   not yet connected are verified on the full shingle sets, most similar first,
   and connected if ``100 * intersection >= percent * union``. The components of
   the verified links are the result; the smallest id of each is kept.

A pair at the threshold shares no band with probability below 1e-5 (150
samples in 30 bands of 5; 2e-8 at 0.85), falling steeply above it. There is no cap on
buckets, groups or partners: large ones are dealt to more units.

Defined results: words are the runs of other characters than ASCII white
space, A-Z in lower case; a text of fewer words than a shingle has one shingle,
its whole word sequence; a null text or one without words has an empty set and
links with nothing. Links are between classes (a class is a node of its own,
whatever ids its rows have), so rows with the same id or without one are not
mixed up; ids are only reported. Of each component the row with the smallest id
is kept, of equal ids the one with the smallest text hash. Rows that repeat id
and text are one document (each row is reported alike); rows without an id are
documents of their own and sort behind all ids. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartstreak.llm.common import fresh, quoted, table, text_of
from chartstreak.llm.components import connected_components
from chartstreak.session import materialise, workers_import_package

BANDS, ROWS = 30, 5
SAMPLES = BANDS * ROWS
SKETCH_BITS = 512
ADMIT = 0.6
_RANDOM = np.random.default_rng(20240229)
FACTORS = _RANDOM.integers(1, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
TERMS = _RANDOM.integers(0, 1 << 63, SAMPLES, dtype=np.uint64)
WORD_FACTORS = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MIX = np.uint64(0x9E3779B97F4A7C15)
BLOCK = 512


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    return x ^ (x >> np.uint64(29))


def shingles(text: str, words_each: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(words_each, len(words))
    out = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        out += one[i:len(words) - n + 1 + i] * WORD_FACTORS[i]
    return np.unique(_mixed(out))


def minhash(found: np.ndarray) -> np.ndarray:
    """The smallest value of the set under each of ``SAMPLES`` hash functions."""
    least = np.full(SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(found), 256):
        np.minimum(least, (found[i:i + 256, None] * FACTORS + TERMS).min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    keys = np.arange(1, BANDS + 1, dtype=np.uint64) * MIX
    for column in least.reshape(BANDS, ROWS).T:
        keys = _mixed(keys + column)
    return keys.view(np.int64)


def odd_sketch(least: np.ndarray) -> bytes:
    bits = _mixed(least + np.arange(SAMPLES, dtype=np.uint64) * FACTORS) >> np.uint64(64 - SKETCH_BITS.bit_length() + 1)
    return np.packbits((np.bincount(bits.astype(np.int64), minlength=SKETCH_BITS) & 1).astype(np.uint8)).tobytes()


def estimate(differing_bits: np.ndarray) -> np.ndarray:
    """Similarity from the number of bits in which two odd sketches differ."""
    share = np.minimum(2 * np.asarray(differing_bits) / SKETCH_BITS, 1 - 1e-9)
    return 1 + SKETCH_BITS * np.log1p(-share) / (4 * SAMPLES)


# The most differing bits at which a pair is admitted.
MOST_BITS = int(SKETCH_BITS * (1 - math.exp(-4 * SAMPLES * (1 - ADMIT) / SKETCH_BITS)) / 2)


def differing(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Differing bits of all rows of ``left`` and ``right`` (sketches as rows of 64-bit words)."""
    out = np.zeros((len(left), len(right)), np.uint16)
    for word in range(left.shape[1]):
        out += np.bitwise_count(left[:, word][:, None] ^ right[:, word][None, :])
    return out


# A row is known by whether it has no id, its id (else 0) and the hash of its text.
ROW = ["missing", "doc", "code"]


def _row_of(id_col: str, text_col: str) -> list:
    id_ = F.col(quoted(id_col)).cast("long")
    return [id_.isNull().alias("missing"), F.coalesce(id_, F.lit(0)).alias("doc"), F.md5(text_of(text_col)).alias("code")]


def _sketches(words_each: int):
    def sketches(batches):
        for frame in batches:
            out = []
            for missing, doc, code, text in zip(*(frame[c] for c in ROW + ["text"])):
                found = shingles(text, words_each)
                sign = xxhash.xxh3_128_digest(found.tobytes())
                least = minhash(found) if len(found) else None
                out.append((missing, doc, code, len(found), sign, None if least is None else band_keys(least),
                            None if least is None else odd_sketch(least)))
            yield pd.DataFrame(out, columns=[*ROW, "n_shingles", "sign", "bands", "odd"])
    return sketches


def _groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Consecutive rows of equal keys, also across batches."""
    rest = None
    for frame in batches:
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        change = np.zeros(len(frame), bool)
        for k in keys:
            values = frame[k].to_numpy()
            change[1:] |= values[1:] != values[:-1]
        starts = [0, *np.flatnonzero(change)]
        for a, b in zip(starts, starts[1:]):
            yield frame.iloc[a:b]
        rest = frame.iloc[starts[-1]:].reset_index(drop=True)
    if rest is not None and len(rest):
        yield rest


def _sides(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, bool]:
    """Row numbers of the two blocks of a unit, and whether they are the same block."""
    block, left, right = (group[c].to_numpy() for c in ("block", "left", "right"))
    rows = np.arange(len(group))
    return rows[block == left[0]], rows[block == right[0]], left[0] == right[0]


def _admitted(group: pd.DataFrame, percent: int):
    """Pairs of a unit that size and sketch admit: row numbers of both, and their differing bits."""
    a, b, same = _sides(group)
    if len(a) == 0 or len(b) == 0 or len(group) < 2:
        return np.empty(0, int), np.empty(0, int), np.empty(0, int)
    sketch = np.frombuffer(b"".join(group["odd"]), np.uint64).reshape(len(group), -1)
    n = group["n_shingles"].to_numpy()
    bits = differing(sketch[a], sketch[b])
    size_ok = 100 * np.minimum(n[a][:, None], n[b][None, :]) >= percent * np.maximum(n[a][:, None], n[b][None, :])
    ok = size_ok & (bits <= MOST_BITS)
    if same:
        ok = np.triu(ok, 1)
    i, j = np.nonzero(ok)
    return a[i], b[j], bits[i, j]


class Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j

    def stars(self, ids: np.ndarray) -> list:
        """(id, an id of its tree) of every row that is not alone; all rows of a tree get the same one."""
        roots = [self.root(i) for i in range(len(ids))]
        return [(ids[i], ids[r]) for i, r in enumerate(roots) if i != r]


UNIT = ["bucket", "left", "right"]
LINK = "a long, b long"


def _candidates(percent: int):
    def candidates(batches):
        out: list = []
        for group in _groups(batches, UNIT):
            i, j, _ = _admitted(group, percent)
            if len(i):
                forest = Forest(len(group))
                for x, y in zip(i.tolist(), j.tolist()):
                    forest.join(x, y)
                out += forest.stars(group["id"].to_numpy())
            if len(out) > 5_000:
                yield pd.DataFrame(out, columns=["a", "b"])
                out = []
        yield pd.DataFrame(out, columns=["a", "b"])
    return candidates


def _verified(percent: int, words_each: int):
    def verified(batches):
        out: list = []
        for group in _groups(batches, UNIT):
            i, j, bits = _admitted(group, percent)
            if len(i):
                forest, texts, sets = Forest(len(group)), group["text"].to_numpy(), {}

                def of(row):
                    if row not in sets:
                        sets[row] = shingles(texts[row], words_each)
                    return sets[row]
                order = np.argsort(bits, kind="stable")
                for x, y in zip(i[order].tolist(), j[order].tolist()):
                    if forest.root(x) != forest.root(y):
                        common = len(np.intersect1d(of(x), of(y), assume_unique=True))
                        if 100 * common >= percent * (len(of(x)) + len(of(y)) - common):
                            forest.join(x, y)
                out += forest.stars(group["id"].to_numpy())
            if len(out) > 5_000:
                yield pd.DataFrame(out, columns=["a", "b"])
                out = []
        yield pd.DataFrame(out, columns=["a", "b"])
    return verified


def _dealt(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """Each row of a bucket once per pair of blocks that its block is in."""
    rows = members.join(sizes, "bucket").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    return (rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("left", F.least("block", "other")).withColumn("right", F.greatest("block", "other"))
            .drop("blocks", "other"))


def _units(dealt: DataFrame) -> DataFrame:
    return dealt.repartition(*UNIT).sortWithinPartitions(*UNIT)


def _sizes(members: DataFrame) -> DataFrame:
    counts = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    return counts.select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))


def _near(docs: DataFrame, id_col: str, text_col: str, percent: int, words_each: int) -> DataFrame:
    """One row per document: ``ROW``, ``n_shingles``, ``head`` (the kept row of its component) and ``kept``."""
    spark = docs.sparkSession
    workers_import_package(spark)
    src = docs.select(*_row_of(id_col, text_col), text_of(text_col).alias("text"))
    rows = src.mapInPandas(_sketches(words_each), "missing boolean, doc long, code string, n_shingles long, sign binary, "
                                                  "bands array<long>, odd binary")
    rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "sketches")
    # rows without an id are told apart by their written row number
    rows = rows.withColumn("me", F.struct(*ROW, F.when(F.col("missing"), F.col("row")).otherwise(0).alias("row")))
    classes = rows.where("n_shingles > 0").groupBy("sign").agg(
        F.min("me").alias("head"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"),
        F.first("odd").alias("odd"))
    # the number of a class is its node from here on
    classes = materialise(classes.withColumn("id", F.monotonically_increasing_id()), "shingle-classes")

    keyed = classes.select(F.explode("bands").alias("bucket"), "id")
    shared = materialise(_dealt(keyed, _sizes(keyed)), "shared-buckets")
    looked_up = shared.join(classes.select("id", "n_shingles", "odd"), "id")
    near = _units(looked_up).mapInPandas(_candidates(percent), LINK)
    groups = materialise(connected_components(near).select(F.col("node").alias("id"), F.col("component").alias("bucket")),
                         "candidate-groups")

    members = groups.join(classes.select("id", "n_shingles", "odd", "head"), "id")
    # always a sort-merge join: texts of candidates are found the same way at every size
    heads = members.select("id", *(F.col(f"head.{c}").alias(c) for c in ROW)).hint("merge")
    # repeated rows bring the same text again: one per class goes on
    texts = src.join(heads, ROW).groupBy("id").agg(F.first("text").alias("text"))
    dealt = _dealt(groups, _sizes(groups)).join(members.select("id", "n_shingles", "odd"), "id").join(texts, "id")
    component = connected_components(_units(dealt).mapInPandas(_verified(percent, words_each), LINK))
    linked = component.withColumnRenamed("node", "id").join(classes.select("id", "head"), "id")
    # written first, so that Spark can split a large component
    first = materialise(linked.groupBy("component").agg(F.min("head").alias("first")), "component-heads")
    first = linked.join(first.hint("merge"), "component").select("id", "first")
    found = classes.select("sign", "id", "head").join(first, "id", "left").select(
        "sign", F.coalesce("first", "head").alias("head"))
    return rows.select(*ROW, "n_shingles", "sign", "me").join(found, "sign", "left").select(
        *ROW, "n_shingles", F.coalesce("head", "me").alias("head"),
        F.coalesce(F.col("head") == F.col("me"), F.lit(True)).alias("kept"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85,
                    words_each: int = 5) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id``, ``kept``."""
    return _near(docs, id_col, text_col, percent, words_each).select(
        F.when(~F.col("missing"), F.col("doc")).alias(id_col), "n_shingles",
        F.when(~F.col("head.missing"), F.col("head.doc")).alias("component_id"), "kept")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         percent: int = 80) -> DataFrame:
    """One document of each group, with all its columns."""
    missing, doc, code, one = (fresh(docs, c) for c in ("kept_missing", "kept_doc", "kept_code", "kept_one"))
    # rows without an id and with equal texts share a key, but only one of them is kept
    one_of = (F.col("missing") & (F.col("n_shingles") > 0)).alias("one")
    keys = materialise(_near(docs, id_col, text_col, percent, 5).where("kept").select(*ROW, one_of).distinct(),
                       "kept-rows").toDF(missing, doc, code, one)
    is_row = [a.eqNullSafe(F.col(b)) for a, b in zip(_row_of(id_col, text_col), (missing, doc, code))]
    several = docs.join(keys.where(~F.col(one)), is_row, "left_semi")
    single = docs.where(F.col(quoted(id_col)).cast("long").isNull()).join(keys.where(one), is_row)
    return several.union(single.dropDuplicates([code]).select(*(F.col(quoted(c)) for c in docs.columns)))


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
with recursive split as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w
  from documents),
shingled as (
  select doc_id, unnest(list_distinct(case
    when len(w) >= 5 then [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]
    when len(w) > 0 then [array_to_string(w, ' ')] end)) as shingle
  from split),
sizes as (select doc_id, count(*) as n from shingled group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as c
  from shingled a join shingled b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by all),
links as (
  select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * c >= 85 * (x.n + y.n - c)),
reach(a, b) as (select a, b from links union select r.a, l.b from reach r join links l on l.a = r.b),
least as (select a, min(b) as b from reach group by a)
select d.doc_id, coalesce(n, 0) as n_shingles, least(d.doc_id, coalesce(l.b, d.doc_id)) as component_id,
       d.doc_id = least(d.doc_id, coalesce(l.b, d.doc_id)) as kept
from documents d left join sizes using (doc_id) left join least l on l.a = d.doc_id"""
