"""Exact top-k search by inner product with KD-trees per shard.

Components become integers, ``floor(64 * x)``, so scores are exact. Median splits
fitted on a bounded sample (``fit_rows``) divide the space into at most ``most_cells``
cells; every row is dealt to its cell, and a cell of many rows (copies of one vector,
say) to parts of about ``shard_rows`` rows. A cell's part is a shard. Each shard gets
a KD-tree: rows are halved at the median of the dimension with the widest range until
``leaf_rows`` remain; a leaf holds its rows in the order of their ids, its tight
bounding box and its smallest id. Boxes of inner nodes are those of their halves.

A box bounds the score of any row in it: per dimension, the larger of the products
with its two sides. A search goes down the tree while bounds can still beat the
query's k-th best (score, id) and visits the leaves best first, for a block of queries
at a time. Queries first search their home shard; the k-th score found there travels
with them, cells whose box cannot beat it are left out before anything is shuffled, and
the other shards start from it. Blocks of queries meet shards, never pairs of rows.

Ties in score go to the smaller id, so a bound that equals the k-th score is followed
only while the node holds a smaller id.

Defined results: vectors that are null or hold null or non-finite components take no
part; vectors meet those of their own length only (empty ones score 0); rows without
an id are no queries and, as candidates, come behind all ids; repeated rows are rows of
their own, and a query's own row is the only one left out. Products that doubles cannot
hold are computed in whole numbers, and components and scores are clipped to 64 bits.
An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartstreak.llm.common import quoted, table
from chartstreak.session import materialise, workers_import_package

LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
SHARD = ["dim", "cell", "part"]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact ``a @ b.T`` of 64-bit integers, clipped to 64 bits."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = float(np.abs(a.astype(np.float64)).max()) * float(np.abs(b.astype(np.float64)).max()) * a.shape[1]
    if most < 1 << 52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return np.clip(a.astype(object) @ b.astype(object).T, LOWEST, HIGHEST).astype(np.int64)


def bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The largest possible score of each query with a row of each box."""
    sides = np.concatenate([np.maximum(q, 0), np.minimum(q, 0)], axis=1)
    return products(sides, np.concatenate([high, low], axis=1))


def packed(x: np.ndarray) -> bytes:
    """Integers in the narrowest width that holds them, that width first."""
    most = max(-int(x.min()) - 1, int(x.max())) if x.size else 0
    kind = "i1" if most < 1 << 7 else "i2" if most < 1 << 15 else "i4" if most < 1 << 31 else "i8"
    return kind.encode() + x.astype("<" + kind).tobytes()


def unpacked(data: bytes, dim: int) -> np.ndarray:
    flat = np.frombuffer(data, "<" + bytes(data[:2]).decode(), offset=2).astype(np.int64)
    return flat.reshape(-1, dim) if dim else np.zeros((0, 0), np.int64)


# --- cells: median splits of a bounded sample ---------------------------------

def median_splits(x: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Dimension and threshold of each inner node of a complete tree, in heap order; rows above go right."""
    dims, cuts = np.zeros((1 << depth) - 1, int), np.full((1 << depth) - 1, HIGHEST)
    held = {0: x}
    for at in range(len(dims)):
        rows = held.pop(at)
        if len(rows) > 1:
            spread = rows.max(axis=0).astype(np.float64) - rows.min(axis=0)
            dims[at] = spread.argmax()
            column = rows[:, dims[at]]
            cuts[at] = np.sort(column)[(len(column) - 1) // 2]
        right = rows[:, dims[at]] > cuts[at]
        held[2 * at + 1], held[2 * at + 2] = rows[~right], rows[right]
    return dims, cuts


def cells_of(x: np.ndarray, dims: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    at = np.zeros(len(x), int)
    for _ in range(int(np.log2(len(dims) + 1))):
        at = 2 * at + 1 + (x[np.arange(len(x)), dims[at]] > cuts[at])
    return at - len(dims)


def _cells(usual: int, dims: np.ndarray, cuts: np.ndarray):
    def assign(batches):
        for frame in batches:
            for dim, rows in frame.groupby(frame["x"].map(len)):
                x = np.stack([np.asarray(v, np.int64) for v in rows["x"]])
                rows = rows.assign(dim=dim, cell=cells_of(x, dims, cuts) if dim == usual and len(dims) else 0,
                                   x=[packed(v) for v in x])
                yield rows[["row", "id", "nameless", "asks", "dim", "cell", "x"]]
    return assign


# --- a KD-tree per shard --------------------------------------------------------

def leaves_of(x: np.ndarray, ids: np.ndarray, leaf_rows: int) -> list:
    """Row numbers of each leaf, left to right; halves at the median, ties by id."""
    parts = [np.argsort(ids, kind="stable")]
    while len(parts[0]) > leaf_rows:
        halves = []
        for rows in parts:
            if x.shape[1]:
                spread = x[rows].max(axis=0).astype(np.float64) - x[rows].min(axis=0)
                order = rows[np.argsort(x[rows, spread.argmax()], kind="stable")]
            else:
                order = rows
            middle = (len(order) + 1) // 2
            # rows stay in the order of their ids within a half
            halves += [order[:middle][np.argsort(ids[order[:middle]], kind="stable")],
                       order[middle:][np.argsort(ids[order[middle:]], kind="stable")]]
        parts = halves
    return [p for p in parts if len(p)]


def _leaves(leaf_rows: int):
    def build(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        dim = key[0]
        x = _vectors(frame["x"], dim)
        ids = frame["id"].to_numpy(np.int64)
        row, nameless = frame["row"].to_numpy(np.int64), frame["nameless"].to_numpy(bool)
        out = []
        for n, at in enumerate(leaves_of(x, ids, leaf_rows)):
            out.append((*key, n, len(at), int(ids[at[0]]), packed(x[at].min(axis=0)) if dim else b"i1",
                        packed(x[at].max(axis=0)) if dim else b"i1", packed(x[at]), ids[at].tobytes(),
                        row[at].tobytes(), nameless[at].tobytes()))
        return pd.DataFrame(out, columns=[*SHARD, "leaf", "n", "least", "low", "high", "x", "ids", "rows", "nameless"])
    return build


LEAF = ("dim int, cell int, part int, leaf int, n int, least long, low binary, high binary, x binary, ids binary, "
        "rows binary, nameless binary")


def _vectors(rows, dim: int) -> np.ndarray:
    if not dim or not len(rows):
        return np.zeros((len(rows), dim), np.int64)
    return np.concatenate([unpacked(r, dim) for r in rows])


class Tree:
    """The written leaves of a shard, with the boxes of the nodes above them."""

    def __init__(self, leaves: pd.DataFrame, dim: int):
        leaves = leaves.sort_values("leaf")
        self.x = [unpacked(r, dim) if dim else np.zeros((n, 0), np.int64) for r, n in zip(leaves["x"], leaves["n"])]
        self.ids = [np.frombuffer(r, np.int64) for r in leaves["ids"]]
        self.rows = [np.frombuffer(r, np.int64) for r in leaves["rows"]]
        self.nameless = [np.frombuffer(r, bool) for r in leaves["nameless"]]
        level = (_vectors(leaves["low"], dim), _vectors(leaves["high"], dim), leaves["least"].to_numpy(np.int64))
        self.levels = [level]
        while len(level[2]) > 1:
            pairs = np.arange(0, len(level[2]), 2)
            level = (np.minimum.reduceat(level[0], pairs, axis=0), np.maximum.reduceat(level[1], pairs, axis=0),
                     np.minimum.reduceat(level[2], pairs))
            self.levels.append(level)

    def promising(self, q: np.ndarray, kth: np.ndarray, kth_id: np.ndarray) -> np.ndarray:
        """Bounds of the leaves per query, ``LOWEST`` and False where the way down was cut."""
        alive = np.ones((len(q), 1), bool)
        for low, high, least in reversed(self.levels):
            nodes = len(least)
            alive = np.repeat(alive, 2, axis=1)[:, :nodes] if nodes > 1 else alive
            bound = np.full((len(q), nodes), LOWEST)
            some, there = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
            if len(some) and len(there):
                bound[np.ix_(some, there)] = bounds(q[some], low[there], high[there])
            alive &= (bound > kth[:, None]) | ((bound == kth[:, None]) & (least[None, :] < kth_id[:, None]))
        return np.where(alive, bound, LOWEST), alive

    def search(self, q: np.ndarray, own: np.ndarray, k: int, kth: np.ndarray, kth_id: np.ndarray) -> tuple:
        """Per query the k best (score, id, nameless) better than (``kth``, ``kth_id``); unused places have no row.

        Leaves are visited best bound first, each query its own next one; the
        queries that visit the same leaf share one matrix product.
        """
        kth, kth_id = kth.copy(), kth_id.copy()
        bound, alive = self.promising(q, kth, kth_id)
        order = np.argsort(~bound, axis=1, kind="stable")
        m, least = len(q), self.levels[0][2]
        score, ids = np.full((m, k), LOWEST), np.full((m, k), HIGHEST)
        rows, nameless = np.full((m, k), -1), np.zeros((m, k), bool)
        for step in range(order.shape[1]):
            at = order[:, step]
            every = np.arange(m)
            best = bound[every, at]
            go = alive[every, at] & ((best > kth) | ((best == kth) & (least[at] < kth_id)))
            asking = np.flatnonzero(go)
            # all later leaves of a query have no larger bound; equal ones may still hold smaller ids
            if not len(asking) and not (alive[every, at] & (best >= kth)).any():
                break
            asking = asking[np.argsort(at[asking], kind="stable")]
            for group in np.split(asking, np.flatnonzero(np.diff(at[asking])) + 1):
                if not len(group):
                    continue
                leaf = at[group[0]]
                s, i, r = products(q[group], self.x[leaf]), self.ids[leaf], self.rows[leaf]
                good = (s > kth[group, None]) | ((s == kth[group, None]) & (i[None, :] < kth_id[group, None]))
                good &= r[None, :] != own[group, None]
                hit = good.any(axis=1)
                group, s, good = group[hit], s[hit], good[hit]
                if not len(group):
                    continue
                shape = s.shape
                all_s = np.concatenate([score[group], np.where(good, s, LOWEST)], axis=1)
                all_i = np.concatenate([ids[group], np.where(good, np.broadcast_to(i, shape), HIGHEST)], axis=1)
                all_r = np.concatenate([rows[group], np.where(good, np.broadcast_to(r, shape), -1)], axis=1)
                all_n = np.concatenate([nameless[group], np.broadcast_to(self.nameless[leaf], shape)], axis=1)
                # a place without a row sorts last; ~s reverses the order without overflow
                top = np.lexsort((all_i, ~all_s, all_r < 0), axis=1)[:, :k]
                line = np.arange(len(group))[:, None]
                score[group], ids[group] = all_s[line, top], all_i[line, top]
                rows[group], nameless[group] = all_r[line, top], all_n[line, top]
                full = group[rows[group, -1] >= 0]
                kth[full], kth_id[full] = score[full, -1], ids[full, -1]
        return score, ids, rows, nameless


FOUND = "row long, query_id long, score long, id long, nameless boolean"


def _search(k: int):
    def search(key: tuple, leaves: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        if not len(leaves) or not len(blocks):
            return pd.DataFrame({"row": [], "query_id": [], "score": [], "id": [], "nameless": []})
        dim = key[0]
        ask = [np.concatenate([np.frombuffer(r, np.int64) for r in blocks[c]])
               for c in ("rows", "ids", "kth", "kth_id")]
        q = _vectors(blocks["x"], dim) if dim else np.zeros((len(ask[0]), 0), np.int64)
        score, ids, rows, nameless = Tree(leaves, dim).search(q, ask[0], k, ask[2], ask[3])
        at, place = np.nonzero(rows >= 0)
        return pd.DataFrame({"row": ask[0][at], "query_id": ask[1][at], "score": score[at, place],
                             "id": ids[at, place], "nameless": nameless[at, place]})
    return search


# --- blocks of queries and the shards they go to --------------------------------

BLOCK = ("dim int, cell int, part int, block int, rows binary, ids binary, kth binary, kth_id binary, x binary")


def _block(shard: tuple, block: int, rows: pd.DataFrame, x: np.ndarray, at) -> tuple:
    return (*shard, block, *[rows[c].to_numpy(np.int64)[at].tobytes() for c in ("row", "id", "kth", "kth_id")],
            packed(x[at]))


COLUMNS = [*SHARD, "block", "rows", "ids", "kth", "kth_id", "x"]


def _to_home(batches):
    """Queries packed by their home shard."""
    for frame in batches:
        out = []
        for shard, rows in frame.groupby(SHARD):
            shard = tuple(map(int, shard))
            out.append(_block(shard, 0, rows, _vectors(rows["x"], shard[0]), slice(None)))
        yield pd.DataFrame(out, columns=COLUMNS)


def _to_others(usual: int, parts: dict, low: np.ndarray, high: np.ndarray, least: np.ndarray, cells: np.ndarray):
    """Queries packed by every shard that may still hold better rows than their k-th."""
    def send(batches):
        for n, frame in enumerate(batches):
            out = []
            for dim, rows in frame.groupby("dim"):
                dim = int(dim)
                x = _vectors(rows["x"], dim)
                home = list(zip(rows["cell"], rows["part"]))
                kth, kth_id = rows["kth"].to_numpy(np.int64)[:, None], rows["kth_id"].to_numpy(np.int64)[:, None]
                if dim == usual:
                    bound = bounds(x, low, high)
                    alive = (bound > kth) | ((bound == kth) & (least[None, :] < kth_id))
                    targets = cells
                else:
                    targets, alive = np.zeros(1, int), np.ones((len(x), 1), bool)
                home_cell, home_part = (np.array(h) for h in zip(*home))
                for column, cell in enumerate(targets):
                    if not alive[:, column].any():
                        continue
                    for part in range(parts.get((dim, int(cell)), 1)):
                        at = np.flatnonzero(alive[:, column] & ((home_cell != cell) | (home_part != part)))
                        if len(at):
                            out.append(_block((dim, int(cell), part), n, rows, x, at))
            yield pd.DataFrame(out, columns=COLUMNS)
    return send


def _boxes(batches):
    """Partial box of each cell in a batch of leaves."""
    for frame in batches:
        out = []
        for (dim, cell), rows in frame.groupby(["dim", "cell"]):
            dim = int(dim)
            out.append((dim, int(cell), _vectors(rows["low"], dim).min(axis=0).tolist(),
                        _vectors(rows["high"], dim).max(axis=0).tolist(), int(rows["least"].min())))
        yield pd.DataFrame(out, columns=["dim", "cell", "low", "high", "least"])


def _meet(leaves: DataFrame, blocks: DataFrame, k: int, block_rows: int, name: str) -> DataFrame:
    """Every shard with the blocks of queries sent to it, about ``block_rows`` queries a task."""
    blocks = materialise(blocks, f"{name}-blocks")
    sent = blocks.groupBy(*SHARD).agg(
        F.ceil(F.sum(F.octet_length("rows")) / 8 / block_rows).cast("int").alias("groups"))
    group = F.pmod(F.xxhash64("block", "rows"), F.col("groups")).cast("int").alias("group")
    place = [*SHARD, "group"]
    asked = blocks.join(sent, SHARD).select(*blocks.columns, group)
    held = leaves.join(sent, SHARD).withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    held = held.drop("groups")
    found = held.groupBy(*place).cogroup(asked.groupBy(*place)).applyInPandas(_search(k), FOUND)
    return materialise(found, f"{name}-found")


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
          shard_rows: int = 4096, leaf_rows: int = 64, block_rows: int = 4096, fit_rows: int = 20_000,
          most_cells: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of each query, the rows whose id ``every`` divides."""
    spark = vectors.sparkSession
    workers_import_package(spark)
    x = F.transform(F.col(quoted(vector_col)), lambda v: F.floor(v.cast("double") * 64).cast("long"))
    usable = F.forall(quoted(vector_col), lambda v: v.isNotNull() & ~F.isnan(v.cast("double"))
                      & (F.abs(v.cast("double")) < float("inf")))
    id_ = F.col(quoted(id_col)).cast("long")
    rows = vectors.where(F.coalesce(usable, F.lit(False))).select(
        F.coalesce(id_, F.lit(HIGHEST)).alias("id"), id_.isNull().alias("nameless"),
        F.coalesce(id_ % every == 0, F.lit(False)).alias("asks"), x.alias("x"),
        F.monotonically_increasing_id().alias("row"))
    rows = materialise(rows, "integer-vectors")

    counts = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    usual, many = (counts["dim"], counts["count"]) if counts else (0, 0)
    depth = max(0, min(most_cells.bit_length() - 1, int(np.ceil(np.log2(max(1, many / shard_rows))))))
    dims, cuts = np.zeros(0, int), np.zeros(0, np.int64)
    if depth and usual:
        sample = rows.where(F.size("x") == usual).select("x").sample(
            fraction=min(1.0, fit_rows / many), seed=11).limit(2 * fit_rows).collect()
        dims, cuts = median_splits(np.array([r[0] for r in sample], np.int64).reshape(-1, usual), depth)
    dealt = materialise(rows.mapInPandas(
        _cells(usual, dims, cuts), "row long, id long, nameless boolean, asks boolean, dim int, cell int, x binary"),
        "cell-rows")
    sizes = dealt.groupBy("dim", "cell").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("parts"))
    sizes = materialise(sizes, "cell-sizes")
    dealt = dealt.join(sizes, ["dim", "cell"]).withColumn(
        "part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")).drop("parts")
    dealt = materialise(dealt, "shard-rows")
    leaves = materialise(dealt.groupBy(*SHARD).applyInPandas(_leaves(leaf_rows), LEAF), "kd-leaves")

    asking = dealt.where("asks").select(*SHARD, "row", "id", "x")
    first = _meet(leaves, asking.withColumn("kth", F.lit(LOWEST)).withColumn("kth_id", F.lit(HIGHEST))
                  .mapInPandas(_to_home, BLOCK), k, block_rows, "home")
    # the k-th best (score, id) of each query so far; without k rows any row is better
    worst = F.min(F.struct("score", (-F.col("id")).alias("behind")))
    kth = first.groupBy("row").agg(worst.alias("worst"), F.count("*").alias("n")).where(F.col("n") == k).select(
        "row", F.col("worst.score").alias("kth"), (-F.col("worst.behind")).alias("kth_id"))
    asking = asking.join(kth, "row", "left").withColumn("kth", F.coalesce("kth", F.lit(LOWEST))).withColumn(
        "kth_id", F.coalesce("kth_id", F.lit(HIGHEST)))
    # boxes and parts of the cells: at most ``most_cells`` of the usual length, one of any other length
    boxes = leaves.where(F.col("dim") == usual).select("dim", "cell", "low", "high", "least").mapInPandas(
        _boxes, "dim int, cell int, low array<long>, high array<long>, least long").collect()
    low, high, least = {}, {}, {}
    for b in boxes:
        low[b.cell] = np.minimum(low[b.cell], b.low) if b.cell in low else np.array(b.low, np.int64)
        high[b.cell] = np.maximum(high[b.cell], b.high) if b.cell in high else np.array(b.high, np.int64)
        least[b.cell] = min(least.get(b.cell, HIGHEST), b.least)
    cells = sorted(low)
    parts = {(r.dim, r.cell): r.parts for r in sizes.where("parts > 1").collect()}
    second = _meet(leaves, asking.mapInPandas(_to_others(
        usual, parts, np.array([low[c] for c in cells], np.int64).reshape(len(cells), usual),
        np.array([high[c] for c in cells], np.int64).reshape(len(cells), usual),
        np.array([least[c] for c in cells], np.int64), np.array(cells, int)), BLOCK), k, block_rows, "other")
    best = Window.partitionBy("row").orderBy(F.desc("score"), "nameless", "id")
    return (first.union(second).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.when(~F.col("nameless"), F.col("id")).alias("vec_id"), "score"))


def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


OP11_SQL = """
with v as (
  select vec_id, [cast(floor(64 * cast(x as double)) as bigint) for x in embedding] as e from embeddings
  where embedding is not null and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id,
    cast(list_inner_product(cast(q.e as double[]), cast(c.e as double[])) as bigint) as score
  from v q join v c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id and len(c.e) = len(q.e))
select query_id, cast(row_number() over best as integer) as rank, vec_id, score from scored
window best as (partition by query_id order by score desc, vec_id)
qualify row_number() over best <= 20"""
