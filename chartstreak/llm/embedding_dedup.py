"""Embedding near-dedup: spherical k-means cells and blocked cosine products.

Vectors link if their labels are equal and their cosine is at least the
threshold. Identical vectors are folded first, so copies cost one row.

Spherical k-means (fitted on at most about ``fit_rows`` vectors, a documented
bound; all vectors are assigned) gives each vector a home cell. No link is
lost between cells: on the way from x (home a) to y (home b) the bisector of
the two centres is crossed, so one of them lies within half the threshold angle
of it, that is ``(c_a - c_b) . x <= |c_a - c_b| sin(angle / 2)``. That one is
also a guest in the other's cell; if both are, the smaller cell number counts
the link.

A cell's home rows and its guests are dealt to blocks of about ``block_rows``
rows. Each pair of home blocks, and each home block with each guest block, is
one group whose cosines are one matrix product in double precision.
A group returns one row per linked vector (number of links, smallest linked
id), never the pairs. A cell of any size is thus spread over many tasks. One
representative of each component, the smallest id, is kept.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and vectors without a label, link with nothing; neither do vectors
of different lengths. Repeated rows are vectors of their own. Each distinct
vector is a node of its own, whatever ids its rows have, so rows with the same
id or without one are not mixed up; of rows without an id one is kept, and only
if no row of the component has an id. A null id sorts behind all ids. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartstreak.llm.common import quoted, table
from chartstreak.llm.components import connected_components
from chartstreak.session import materialise, workers_import_package

KEY = ["label", "h1", "h2"]


def unit_rows(vectors) -> np.ndarray:
    """Rows scaled to length one in double precision."""
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 50) -> np.ndarray:
    """Unit centres of unit rows; starts from rows spread over the input, stops when no row moves."""
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    home = np.full(len(x), -1)
    for _ in range(rounds):
        now = (x @ centres.T).argmax(axis=1)
        if (now == home).all():
            break
        home = now
        sums = np.zeros_like(centres)
        np.add.at(sums, home, x)
        size = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(size > 1e-12, sums / np.maximum(size, 1e-12), centres)
    return np.unique(centres, axis=0)


def cells_of(x: np.ndarray, centres: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each unit row, and whether it is a guest in each cell."""
    reach = math.sin(math.acos(max(-1.0, min(1.0, threshold))) / 2) + 1e-9
    sims = x @ centres.T
    home = sims.argmax(axis=1)
    gap = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T))
    guest = sims[np.arange(len(x)), home][:, None] - sims <= gap[home] * reach
    guest[np.arange(len(x)), home] = False
    return home, guest


def _packed(v) -> bytes:
    """A vector's components, in the width they came in."""
    v = np.asarray(v)
    return v.astype("<f4" if v.dtype == np.float32 else "<f8").tobytes()


def _unpacked(rows: pd.Series, dim: int) -> np.ndarray:
    kind = "<f4" if len(rows.iloc[0]) == 4 * dim else "<f8"
    return unit_rows(np.frombuffer(b"".join(rows), kind).reshape(len(rows), dim))


def _assign(centres: np.ndarray, threshold: float):
    def assign(batches):
        for frame in batches:
            for dim, rows in frame.groupby(frame["v"].map(len)):
                x = unit_rows(rows["v"])
                if len(centres) and dim == centres.shape[1]:
                    home, guest = cells_of(x, centres, threshold)
                else:
                    home, guest = np.zeros(len(x), int), np.zeros((len(x), 1), bool)
                guests = [np.flatnonzero(g) for g in guest]
                at = np.repeat(np.arange(len(x)), [1 + len(g) for g in guests])
                cell = np.concatenate([np.append(h, g) for h, g in zip(home, guests)])
                packed = [_packed(v) for v in rows["v"]]
                yield pd.DataFrame({
                    "label": rows["label"].to_numpy()[at], "dim": dim, "cell": cell, "home": home[at],
                    "guests": [guests[i] if c == home[i] else [] for i, c in zip(at, cell)],
                    "id": rows["id"].to_numpy()[at], "n": rows["n"].to_numpy()[at], "x": [packed[i] for i in at]})
    return assign


def _compare(threshold: float):
    def compare(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        _, dim, cell, left, right, with_guests = key
        at_home = (frame["home"] == cell).to_numpy()
        block = frame["block"].to_numpy()
        same = not with_guests and left == right
        a = frame[at_home & (block == left)]
        b = a if same else frame[(block == right) & (at_home != with_guests)]
        if not len(a) or not len(b):
            return pd.DataFrame({"id": [], "links": [], "root": []})
        x = _unpacked(a["x"], dim)
        linked = x @ (x if same else _unpacked(b["x"], dim)).T >= threshold
        if with_guests:
            # a pair whose two rows are guests in each other's cell counts in the smaller cell
            home = b["home"].to_numpy()
            visits = np.zeros((len(a), max(home.max(), cell) + 1), bool)
            sizes = a["guests"].map(len).to_numpy()
            cells = np.concatenate([np.asarray(g, int) for g in a["guests"]])
            rows = np.repeat(np.arange(len(a)), sizes)
            near = cells < visits.shape[1]
            visits[rows[near], cells[near]] = True
            linked &= ~visits[:, home] | (home > cell)[None, :]
        if same:
            np.fill_diagonal(linked, False)
        ids_a, ids_b = a["id"].to_numpy(), b["id"].to_numpy()
        if same:
            ids, links = ids_a, linked @ a["n"].to_numpy()
        else:
            ids = np.concatenate([ids_a, ids_b])
            links = np.concatenate([linked @ b["n"].to_numpy(), linked.T @ a["n"].to_numpy()])
        i, j = np.nonzero(linked)
        root_a, root_b = ids_a.copy(), ids_a.copy() if same else ids_b.copy()
        while True:  # smallest id along the links of this group
            next_a, next_b = root_a.copy(), root_b.copy()
            np.minimum.at(next_b, j, root_a[i])
            np.minimum.at(next_a, i, next_b[j])
            if same:
                next_a = next_b = np.minimum(next_a, next_b)
            if (next_a == root_a).all() and (next_b == root_b).all():
                break
            root_a, root_b = next_a, next_b
        root = root_a if same else np.concatenate([root_a, root_b])
        found = links > 0
        return pd.DataFrame({"id": ids[found], "links": links[found], "root": root[found]})
    return compare


def link_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 threshold: float = 0.93, cell_rows: int = 1024, most_cells: int = 4096, block_rows: int = 1024,
                 fit_rows: int = 20_000) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id``, ``kept``."""
    workers_import_package(vectors.sparkSession)
    src = vectors.select(F.col(quoted(id_col)).cast("long").alias("vec_id"),
                         F.col(quoted(label_col)).cast("string").alias("label"), F.col(quoted(vector_col)).alias("v"))
    usable = (F.col("label").isNotNull() & F.col("v").isNotNull()
              & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
              & F.exists("v", lambda x: x != 0))
    src = materialise(src.select("vec_id", "label", "v", F.xxhash64("v").alias("h1"), F.hash("v").alias("h2"),
                                 F.coalesce(usable, F.lit(False)).alias("usable"),
                                 F.monotonically_increasing_id().alias("row")), "vectors")
    # rows without an id are told apart by their written row number
    missing = F.col("vec_id").isNull()
    src = src.withColumn("me", F.struct(missing.alias("missing"), F.coalesce("vec_id", F.lit(0)).alias("vec"),
                                        F.when(missing, F.col("row")).otherwise(0).alias("row")))
    distinct = src.where("usable").groupBy(*KEY).agg(
        F.min("me").alias("head"), F.count("*").alias("n"), F.first("v").alias("v"))
    # the number of a distinct vector is its node from here on
    distinct = materialise(distinct.withColumn("id", F.monotonically_increasing_id()), "distinct-vectors")

    total = distinct.count()
    largest = distinct.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    cells = int(max(1, min(most_cells, fit_rows // 4, -(-largest // cell_rows))))
    centres = np.empty((0, 0))
    if cells > 1:
        sample = distinct.select("v").sample(fraction=min(1.0, fit_rows / total), seed=11).limit(2 * fit_rows)
        sample = [r[0] for r in sample.collect()]
        usual = max({len(v) for v in sample}, key=[len(v) for v in sample].count, default=0)
        sample = [v for v in sample if len(v) == usual]
        if len(sample) > cells:
            centres = spherical_kmeans(unit_rows(sample), cells)

    held = materialise(distinct.select("label", "id", "n", "v").mapInPandas(
        _assign(centres, threshold), "label string, dim int, cell int, home int, guests array<int>, id long, n long, "
                                     "x binary"), "cell-rows")
    place = ["label", "dim", "cell"]
    guest = F.col("home") != F.col("cell")
    blocks = held.groupBy(*place).agg(F.ceil(F.count_if(~guest) / block_rows).cast("int").alias("at_home"),
                                      F.ceil(F.count_if(guest) / block_rows).cast("int").alias("visiting"))
    dealt = held.join(blocks, place).withColumn("block", F.pmod(
        F.xxhash64("id"), F.when(guest, F.col("visiting")).otherwise(F.col("at_home"))).cast("int"))
    # home blocks meet each other and every guest block; guests never meet guests
    homes = F.transform(F.sequence(F.lit(0), F.col("at_home") - 1), lambda i: F.struct(
        F.least(i, "block").alias("left"), F.greatest(i, "block").alias("right"), F.lit(False).alias("guests")))
    visits = F.transform(F.sequence(F.lit(1), F.col("visiting")), lambda g: F.struct(
        F.col("block").alias("left"), (g - 1).alias("right"), F.lit(True).alias("guests")))
    hosts = F.transform(F.sequence(F.lit(1), F.col("at_home")), lambda i: F.struct(
        (i - 1).alias("left"), F.col("block").alias("right"), F.lit(True).alias("guests")))
    visits = F.when(F.col("visiting") > 0, visits).otherwise(F.slice(homes, 1, 0))
    hosts = F.when(F.col("at_home") > 0, hosts).otherwise(F.slice(visits, 1, 0))
    dealt = dealt.withColumn("unit", F.explode(F.when(guest, hosts).otherwise(F.concat(homes, visits))))
    dealt = dealt.select(*place, "home", "guests", "id", "n", "x", "block", "unit.left", "unit.right",
                         F.col("unit.guests").alias("with_guests"))
    partial = materialise(dealt.groupBy(*place, "left", "right", "with_guests").applyInPandas(
        _compare(threshold), "id long, links long, root long"), "vector-links")
    component = connected_components(partial.select("id", "root"), "id", "root")
    links = partial.groupBy("id").agg(F.sum("links").alias("links"))
    joined = component.withColumnRenamed("node", "id").join(distinct.select("id", "head"), "id")
    # the smallest row of a component; of vectors that repeat its id the smallest node. Written before the join
    least = materialise(joined.groupBy("component").agg(F.min(F.struct("head", "id")).alias("least")),
                        "component-heads").hint("merge")
    least = joined.join(least, "component").select("id", "least")
    classes = (distinct.drop("v").join(links, "id", "left").join(least, "id", "left")
               .select(*KEY, (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "id",
                       F.coalesce("least", F.struct("head", "id")).alias("least")))
    linked = src.where("usable").select("vec_id", "me", *KEY).join(classes, KEY).select(
        "vec_id", "n_links", F.when(~F.col("least.head.missing"), F.col("least.head.vec")).alias("component_id"),
        ((F.col("least.head") == F.col("me")) & (F.col("least.id") == F.col("id"))).alias("kept"))
    alone = src.where(~F.col("usable")).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                               F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    return linked.union(alone).withColumnRenamed("vec_id", id_col)


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"))


OP1_SQL = """
with recursive v as (
  select vec_id, label, cast(embedding as double[]) as e from embeddings
  where label is not null and embedding is not null
    and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0
    and len([x for x in embedding if x <> 0]) > 0),
links as (
  select a.vec_id as a, b.vec_id as b from v a join v b
  on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  and list_cosine_similarity(a.e, b.e) >= 0.93),
reach(a, b) as (select a, b from links union select r.a, l.b from reach r join links l on l.a = r.b),
least as (select a, min(b) as b from reach group by a),
counted as (select a, count(*) as n from links group by a)
select vec_id, coalesce(n, 0) as n_links, least(vec_id, coalesce(least.b, vec_id)) as component_id,
       vec_id = least(vec_id, coalesce(least.b, vec_id)) as kept
from embeddings left join least on least.a = vec_id left join counted on counted.a = vec_id"""
