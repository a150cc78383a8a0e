"""L1, L2: K-Means per country as grouped Lloyd iterations on DataFrames.

All countries advance together, one distributed job per iteration:

* assign: every point is joined (on country) to ONE row holding that
  country's k centroids as an array, and picks the nearest with a JVM-side
  ``array_min`` over (rounded distance, cluster id): no k-fold row blow-up,
  no Python. The centroid table has countries x k rows; it is broadcast
  behind a size check.
* update: ``groupBy(country, cluster).avg(features)``: partial aggregation
  map-side, so a country with a third of all points is spread over tasks.
  An empty cluster keeps its centroid.

Iterations run until no centroid moves more than ``tol``; ``max_iterations``
is the usual library limit (100), a parameter. Points are materialised once in
the shared folder; centroids are checkpointed each iteration to cut lineage
(both survive executor loss). Deterministic: init = the first k distinct
vectors by spotifyId per country, or starts that lie apart, drawn by hashes
(``start="spread"``); distances rounded to 9 decimals, ties to the lowest cluster id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartstreak.functions import profile as pf
from chartstreak.functions.features import feature_columns
from chartstreak.schemas import FEATURE_NAMES, N_CLUSTERS
from chartstreak.session import materialise

OK, FAILED, NO_HITS = "OK", "FAILED", "NO_HITS"
CENTROID_BROADCAST_MAX_BYTES = 64 << 20


def _vec(cols=FEATURE_NAMES) -> Column:
    return F.array(*[F.col(c) for c in cols])


def kmeans_points(labelled: DataFrame, by: str = "country") -> DataFrame:
    """Hit rows as (by, spotifyId, snapshotDate, f: array<double>)."""
    return (labelled.where(F.col("hit"))
            .select(by, "spotifyId", "snapshotDate", *feature_columns())
            .select(by, "spotifyId", "snapshotDate", _vec().alias("f")))


def initial_centroids(points: DataFrame, k: int, by: str = "country") -> DataFrame:
    """The first k distinct vectors by (spotifyId, vector) per country -> (by, cluster, f)."""
    vectors = points.groupBy(by, "f").agg(F.min("spotifyId").alias("spotifyId"))
    w = Window.partitionBy(by).orderBy("spotifyId", "f")
    # rank <= k over a window: Spark plans a WindowGroupLimit before the
    # shuffle, so each map task keeps only k vectors per country.
    return (vectors.withColumn("cluster", F.row_number().over(w))
            .where(F.col("cluster") <= k)
            .select(by, "cluster", "f"))


# --- spread start: k-means|| for all countries at once ---------------------------

SEED, ROUNDS, RECLUSTER_ROUNDS = 7, 5, 5


def _draw(step: int, seed: int) -> Column:
    """A number in [0, 1) that hangs on the vector's name, the step and the seed alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}|{step}|"), F.col("name")), 256)
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(16 ** 13))


def _packed(chosen: DataFrame, by: str) -> DataFrame:
    """One row per country with its chosen vectors; broadcast behind a size check."""
    packed = materialise(chosen.groupBy(by).agg(F.array_sort(F.collect_list(F.struct("name", "f"))).alias("chosen")),
                         "chosen-starts")
    size = packed.agg(F.sum(F.octet_length(F.to_json(F.struct(*packed.columns))))).first()[0] or 0
    return F.broadcast(packed) if size <= CENTROID_BROADCAST_MAX_BYTES else packed


def _nearest_chosen(vectors: DataFrame, chosen: DataFrame, by: str) -> DataFrame:
    """``vectors`` with ``d`` and ``nearest``: squared distance to, and name of, the nearest chosen vector."""
    near = F.array_min(F.transform("chosen", lambda c: F.struct(
        F.round(_sq_dist(F.col("f"), c["f"]), 9).alias("d"), c["name"].alias("name"))))
    return (vectors.join(_packed(chosen, by), by).withColumn("near", near).drop("chosen")
            .withColumn("d", F.col("near.d")).withColumn("nearest", F.col("near.name")).drop("near"))


def spread_centroids(points: DataFrame, k: int, by: str = "country", seed: int = SEED, rounds: int = ROUNDS,
                     oversampling: float | None = None) -> DataFrame:
    """k starts per country that lie apart -> (by, cluster, f), one job per round for all countries.

    k-means||: the vector of the least draw starts; in each round every distinct
    vector is drawn with probability ``oversampling`` (2k) times its share of the
    cost, the squared distances to the vectors chosen so far weighted by their
    points. The candidates (about ``1 + rounds * oversampling`` a country) are weighted
    by the points nearest to them, and k of them are picked: the heaviest, then
    again and again the one of the largest weight times squared distance to those
    picked; ``RECLUSTER_ROUNDS`` weighted iterations over the candidates follow. A country with fewer than k candidates picks from all its vectors. Draws
    are hashes of a vector's first (song, day): a rerun or a lost task draws alike.
    """
    name = F.concat("spotifyId", F.lit("|"), F.date_format("snapshotDate", "yyyy-MM-dd"))
    vectors = materialise(points.withColumn("name", name).groupBy(by, "f").agg(
        F.min("name").alias("name"), F.count("*").alias("n")), "distinct-points")
    least = F.min(F.struct(_draw(0, seed).alias("u"), "name", "f"))
    chosen = vectors.groupBy(by).agg(least.alias("s")).select(by, "s.name", "s.f")
    share = float(oversampling or 2 * k)
    for step in range(1, rounds + 1):
        far = _nearest_chosen(vectors, chosen, by)
        cost = far.groupBy(by).agg(F.sum(F.col("n") * F.col("d")).alias("cost"))
        drawn = far.join(cost, by).where(_draw(step, seed) * F.col("cost") < share * F.col("n") * F.col("d"))
        chosen = materialise(chosen.union(drawn.select(by, "name", "f")), "starts")
    weights = _nearest_chosen(vectors, chosen, by).groupBy(by, F.col("nearest").alias("name")).agg(
        F.sum("n").alias("w"))
    few = chosen.groupBy(by).count().where(F.col("count") < k).select(by)
    pool = chosen.join(weights, [by, "name"]).join(few, by, "left_anti").select(by, "name", "f", "w").union(
        vectors.join(few, by, "left_semi").select(by, "name", "f", F.col("n").alias("w")))
    pool = materialise(pool, "start-pool")
    best = F.min(F.struct((-F.col("w")).cast("double").alias("score"), "name", "f"))
    picked = pool.groupBy(by).agg(best.alias("s")).select(by, F.lit(1).alias("cluster"), "s.name", "s.f")
    for cluster in range(2, k + 1):
        best = F.min(F.struct((-F.round(F.col("w") * F.col("d"), 6)).alias("score"), "name", "f"))
        following = _nearest_chosen(pool, picked, by).where("d > 0").groupBy(by).agg(best.alias("s")).select(
            by, F.lit(cluster).alias("cluster"), "s.name", "s.f")
        picked = materialise(picked.union(following), "picked-starts")
    # a few weighted iterations over the small pool, so that starts are middles of its parts, not its outermost vectors
    starts = picked.select(by, "cluster", "f")
    n = len(FEATURE_NAMES)
    for _ in range(RECLUSTER_ROUNDS):
        held = assign(pool, starts, by, broadcast=False)
        weight = F.sum("w")
        means = held.groupBy(by, "cluster").agg(
            *[(F.sum(F.col("w") * F.col("f")[i]) / weight).alias(f"m{i}") for i in range(n)]).select(
            by, "cluster", _vec([f"m{i}" for i in range(n)]).alias("nf"))
        starts = materialise(starts.join(means, [by, "cluster"], "left").select(
            by, "cluster", F.coalesce("nf", "f").alias("f")), "starts")
    return starts


def total_cost(points: DataFrame, centroids: DataFrame, by: str = "country") -> DataFrame:
    """(by, cost): the sum of squared distances of the points to their nearest centroid."""
    named = centroids.select(by, F.col("cluster").cast("string").alias("name"), "f")
    return _nearest_chosen(points, named, by).groupBy(by).agg(F.sum("d").alias("cost"))


def _sq_dist(p: Column, c: Column) -> Column:
    return F.aggregate(F.zip_with(p, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)


def assign(points: DataFrame, centroids: DataFrame, by: str = "country",
           broadcast: bool = True) -> DataFrame:
    """Nearest centroid per point -> points + ``cluster``.

    ``broadcast``: the caller has checked the centroid count (countries x k).
    """
    packed = centroids.groupBy(by).agg(F.collect_list(F.struct("cluster", "f")).alias("cents"))
    if broadcast:
        packed = F.broadcast(packed)
    nearest = F.array_min(F.transform(
        "cents", lambda c: F.struct(F.round(_sq_dist(F.col("f"), c["f"]), 9).alias("d"),
                                    c["cluster"].alias("cluster"))))
    return points.join(packed, by, "inner").withColumn("cluster", nearest["cluster"]).drop("cents")


def update(assigned: DataFrame, old: DataFrame, by: str = "country") -> DataFrame:
    """New centroid = mean of assigned points; an empty cluster keeps its centroid."""
    n = len(FEATURE_NAMES)
    means = (assigned.groupBy(by, "cluster")
             .agg(*[F.avg(F.col("f")[i]).alias(f"m{i}") for i in range(n)])
             .select(by, "cluster", _vec([f"m{i}" for i in range(n)]).alias("nf")))
    return (old.join(means, [by, "cluster"], "left")
            .select(by, "cluster", F.coalesce("nf", "f").alias("f")))


def grouped_kmeans(labelled: DataFrame, k: int = N_CLUSTERS, max_iterations: int = 100,
                   by: str = "country", tol: float = 1e-9, start: str = "first") -> tuple[DataFrame, DataFrame]:
    """Returns (centroids (by, cluster 1..k, f), status per country).

    ``start``: "first" takes the first k distinct vectors, "spread" those of ``spread_centroids``.

    A country with fewer than k distinct hit vectors gets status FAILED (the
    reference's clustering throws there) and no centroids; a country with no
    hit at all gets NO_HITS. One centroid-sized aggregate per iteration (the
    largest move) reaches the driver.
    """
    points = materialise(kmeans_points(labelled, by), "kmeans-points")
    if start not in ("first", "spread"):
        raise ValueError(f"start={start!r}")
    init = spread_centroids(points, k, by) if start == "spread" else initial_centroids(points, k, by)
    distinct = points.groupBy(by, "f").count().groupBy(by).agg(F.count("*").alias("distinctHits"))
    ok = distinct.where(F.col("distinctHits") >= k).select(by)
    cents = init.join(ok, by, "left_semi").checkpoint(eager=True)
    size = cents.agg(F.sum(F.octet_length(F.to_json(F.struct(*cents.columns))))).first()[0] or 0
    small = size <= CENTROID_BROADCAST_MAX_BYTES
    for _ in range(max_iterations if size else 0):
        new = update(assign(points, cents, by, small), cents, by).checkpoint(eager=True)
        moved = (new.alias("n").join(cents.alias("o"), [by, "cluster"])
                 .select(F.max(F.sqrt(_sq_dist(F.col("n.f"), F.col("o.f")))).alias("m"))
                 .first()["m"])
        cents = new
        if moved <= tol:
            break
    all_countries = labelled.groupBy(by).agg(F.count_if("hit").alias("hitRows"))
    status = (all_countries.join(distinct, by, "left")
              .select(by, F.when(F.col("hitRows") == 0, F.lit(NO_HITS))
                      .when(F.coalesce("distinctHits", F.lit(0)) < k, F.lit(FAILED))
                      .otherwise(F.lit(OK)).alias("kmeansStatus")))
    return cents, status


def cluster_profiles(centroids: DataFrame) -> DataFrame:
    """L2: per centroid its number, short summary and full profile."""
    return centroids.select("country", "cluster",
                            pf.short_summary(F.col("f")).alias("summary"),
                            *[c.alias(n) for n, c in pf.band_columns(F.col("f")).items()],
                            pf.profile_text(F.col("f")).alias("profile"))
