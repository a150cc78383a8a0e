"""Registered queries for clustering, classification and training reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartstreak.functions import profile as pf
from chartstreak.jobs import train_countries
from chartstreak.operators import forest, kmeans
from chartstreak.plans.common import flat, labelled_sql, with_chart
from chartstreak.plans.profile_queries import bands_sql, fsql, summary_sql
from chartstreak.plans.queries import labelled, register
from chartstreak.schemas import FEATURE_NAMES, N_CLUSTERS, RUN_DAYS, TOP_N
from chartstreak.session import shared_path

LAB = labelled_sql(TOP_N, RUN_DAYS)
ITERATIONS = 24   # of the oracle: beyond the fixed point, where further rounds change nothing
NF = len(FEATURE_NAMES)


def _r4(x):
    return f"floor({x} * 10000.0 + 0.5) / 10000.0"


def spread_sql(k: int, rounds: int = kmeans.ROUNDS, seed: int = kmeans.SEED) -> list[str]:
    """CTEs up to ``km_c0``: k-means|| starts by the same hash draws."""
    fl = ", ".join(f"f{i}" for i in range(NF))
    vl = ", ".join(f"v.f{i}" for i in range(NF))
    dist = " + ".join(f"(v.f{i} - c.f{i}) * (v.f{i} - c.f{i})" for i in range(NF))

    def draw(step):
        return f"cast(cast('0x' || substr(sha256('{seed}|{step}|' || name), 1, 13) as bigint) as double) / {16 ** 13}.0"

    def near(source, chosen, extra):
        return (f"select v.country, v.name, {vl}, {extra}, min(round({dist}, 9)) as d, "
                f"first(c.name order by round({dist}, 9), c.name) as nearest "
                f"from {source} v join {chosen} c using (country) group by all")
    ctes = [f"sp_v as (select country, min(spotifyId || '|' || cast(snapshotDate as varchar)) as name, count(*) as n, {fl} "
            f"from km_pts group by country, {fl})",
            f"sp_s0 as (select country, name, {fl} from (select *, row_number() over (partition by country order by "
            f"{draw(0)}, name) as r from sp_v) where r = 1)"]
    for t in range(1, rounds + 1):
        ctes += [f"sp_d{t} as ({near('sp_v', f'sp_s{t - 1}', 'v.n')})",
                 f"sp_s{t} as (select * from sp_s{t - 1} union all select country, name, {fl} from (select *, sum(n * d) "
                 f"over (partition by country) as cost from sp_d{t}) where {draw(t)} * cost < {2 * k} * n * d)"]
    ctes += [f"sp_w as (select country, nearest as name, sum(n) as w from ({near('sp_v', f'sp_s{rounds}', 'v.n')}) "
             "group by country, nearest)",
             f"sp_few as (select country from sp_s{rounds} group by country having count(*) < {k})",
             f"sp_pool as (select s.country, s.name, w, {fl} from sp_s{rounds} s join sp_w using (country, name) "
             f"where s.country not in (select country from sp_few) union all select country, name, n, {fl} from sp_v "
             "where country in (select country from sp_few))",
             f"sp_p1 as (select country, 1 as cluster, name, {fl} from (select *, row_number() over (partition by country "
             "order by w desc, name) as r from sp_pool) where r = 1)"]
    for j in range(2, k + 1):
        ctes.append(f"sp_p{j} as (select * from sp_p{j - 1} union all select country, {j}, name, {fl} from (select *, "
                    "row_number() over (partition by country order by round(w * d, 6) desc, name) as r from "
                    f"({near('sp_pool', f'sp_p{j - 1}', 'v.w')}) where d > 0) where r = 1)")
    last = f"sp_p{k}"
    for t in range(1, kmeans.RECLUSTER_ROUNDS + 1):
        ctes += [f"sp_a{t} as (select v.country, v.name, first(c.cluster order by round({dist}, 9), c.cluster) as cluster "
                 f"from sp_pool v join {last} c using (country) group by v.country, v.name)",
                 f"sp_m{t} as (select country, cluster, "
                 + ", ".join(f"sum(w * f{i}) / sum(w) as f{i}" for i in range(NF))
                 + f" from sp_a{t} join sp_pool using (country, name) group by country, cluster)",
                 f"sp_l{t} as (select o.country, o.cluster, "
                 + ", ".join(f"coalesce(m.f{i}, o.f{i}) as f{i}" for i in range(NF))
                 + f" from {last} o left join sp_m{t} m using (country, cluster))"]
        last = f"sp_l{t}"
    return [*ctes, f"km_c0 as (select country, cluster, {fl} from {last} where country in "
                   f"(select country from km_distinct where dh >= {k}))"]


def kmeans_sql(k: int = N_CLUSTERS, iterations: int = ITERATIONS, lab: str = LAB, spread: bool = False) -> str:
    """CTEs ``km_c{iterations}`` (centroids) and ``km_status``, unrolled Lloyd loop."""
    fcols = ", ".join(f"{fsql(n)} as f{i}" for i, n in enumerate(FEATURE_NAMES))
    fl = ", ".join(f"f{i}" for i in range(NF))
    ctes = [
        f"km_pts as (select country, spotifyId, snapshotDate, {fcols} from labelled where hit)",
        f"km_songs as (select country, min(spotifyId) as spotifyId, {fl} from km_pts group by country, {fl})",
        "km_distinct as (select country, count(*) as dh from km_songs group by country)",
        f"km_c0 as (select country, cluster, {fl} from (select *, row_number() over ("
        f"partition by country order by spotifyId, {fl}) as cluster from km_songs) "
        f"where cluster <= {k} and country in (select country from km_distinct where dh >= {k}))",
    ]
    if spread:
        ctes[-1:] = spread_sql(k)
    dist = " + ".join(f"(p.f{i} - c.f{i}) * (p.f{i} - c.f{i})" for i in range(NF))
    for it in range(1, iterations + 1):
        prev = f"km_c{it - 1}"
        ctes.append(f"km_d{it} as (select p.country, p.spotifyId, p.snapshotDate, c.cluster, round({dist}, 9) as d "
                    f"from km_pts p join {prev} c using (country))")
        ctes.append(f"km_a{it} as (select country, spotifyId, snapshotDate, first(cluster order by d, cluster) "
                    f"as cluster from km_d{it} group by country, spotifyId, snapshotDate)")
        ctes.append(f"km_m{it} as (select a.country, a.cluster, "
                    + ", ".join(f"avg(p.f{i}) as f{i}" for i in range(NF))
                    + f" from km_a{it} a join km_pts p using (country, spotifyId, snapshotDate) "
                      f"group by a.country, a.cluster)")
        ctes.append(f"km_c{it} as (select o.country, o.cluster, "
                    + ", ".join(f"coalesce(m.f{i}, o.f{i}) as f{i}" for i in range(NF))
                    + f" from {prev} o left join km_m{it} m using (country, cluster))")
    ctes.append(
        "km_status as (select l.country, case when count_if(l.hit) = 0 then 'NO_HITS' "
        f"when coalesce(max(d.dh), 0) < {k} then 'FAILED' else 'OK' end as kmeansStatus "
        "from labelled l left join km_distinct d using (country) group by l.country)")
    ctes = [c.replace(" as (", " as materialized (", 1) for c in ctes]
    return lab + ",\n" + ",\n".join(ctes)


KM = kmeans_sql()


WIDE = {"wide": True, "top_n": 10, "run": 2}       # song = user_id: the chart grows with the events
KM_WIDE = kmeans_sql(lab=labelled_sql(10, 2))


def _centroids_sql(wide: bool = False) -> str:
    return with_chart("select country, cluster, " + ", ".join(
        f"{_r4(f'f{i}')} as {n}" for i, n in enumerate(FEATURE_NAMES)) + f" from km_c{ITERATIONS}",
        wide=wide, extra=KM_WIDE if wide else KM)


def _centroids(cents):
    return cents.select("country", "cluster", *[
        (F.floor(F.col("f")[i] * 10000.0 + 0.5) / 10000.0).alias(n) for i, n in enumerate(FEATURE_NAMES)])


@register("grouped_kmeans", _centroids_sql())
def q_grouped_kmeans(spark, sf_dir):
    """L1: k=4 centroids per country, fixed init, to convergence, 4 decimals."""
    return _centroids(kmeans.grouped_kmeans(labelled(spark, sf_dir))[0])


@register("grouped_kmeans_wide", _centroids_sql(wide=True))
def q_grouped_kmeans_wide(spark, sf_dir):
    """L1 over the wide chart, runs of 2 days: every country clusters."""
    return _centroids(kmeans.grouped_kmeans(labelled(spark, sf_dir, **WIDE))[0])


SPREAD_ITERATIONS = 40
KM_SPREAD = kmeans_sql(iterations=SPREAD_ITERATIONS, lab=labelled_sql(10, 2), spread=True)
# four decimals, cut where means of four-decimal values do not end, so that the order of a sum moves none
CUT = 0.4567


@register("grouped_kmeans_spread_wide", with_chart("select country, cluster, " + ", ".join(
    f"floor(f{i} * 10000.0 + {CUT}) / 10000.0 as {n}" for i, n in enumerate(FEATURE_NAMES))
    + f" from km_c{SPREAD_ITERATIONS}", wide=True, extra=KM_SPREAD))
def q_grouped_kmeans_spread_wide(spark, sf_dir):
    """L1 with starts that lie apart, drawn for all countries in one job a round."""
    cents = kmeans.grouped_kmeans(labelled(spark, sf_dir, **WIDE), start="spread")[0]
    return cents.select("country", "cluster", *[
        (F.floor(F.col("f")[i] * 10000.0 + CUT) / 10000.0).alias(n) for i, n in enumerate(FEATURE_NAMES)])


def _fc(n):
    return f"f{FEATURE_NAMES.index(n)}"


@register("cluster_profiles", with_chart(
    f"select country, cluster, {summary_sql(_fc)} as summary, "
    + ", ".join(f"{v} as {k}" for k, v in bands_sql(_fc).items()) + f" from km_c{ITERATIONS}", extra=KM))
def q_cluster_profiles(spark, sf_dir):
    """L2: per centroid its summary and band words (profile text in the library)."""
    cents, _ = kmeans.grouped_kmeans(labelled(spark, sf_dir))
    return kmeans.cluster_profiles(cents).drop("profile")


@register("training_report", with_chart(
    """select g.country, g.records, g.hits, g.nonHits, s.kmeansStatus,
         case g.gate when 'TRAIN' then 'TRAINED' else g.gate end as classifierStatus
       from (select country, count(*) as records, count_if(hit) as hits, count_if(not hit) as nonHits,
               case when count(*) < 2 then 'TOO_FEW_ROWS'
                    when count_if(hit) = 0 or count_if(not hit) = 0 then 'SKIPPED_ONE_CLASS'
                    else 'TRAIN' end as gate
             from labelled group by country) g join km_status s using (country)""", extra=KM))
def q_training_report(spark, sf_dir):
    """One row per country from a real run of the training job: counts and outcomes."""
    report = train_countries(spark, labelled(spark, sf_dir), shared_path(spark, "training"))
    return report.select("country", "records", "hits", "nonHits", "kmeansStatus", "classifierStatus")


_runs: dict = {}


def _forest(spark, sf_dir):
    """The labelled chart and its trained forests; one training per application and table folder."""
    key = spark.sparkContext.applicationId, sf_dir
    lab = labelled(spark, sf_dir)
    if key not in _runs:
        _runs[key] = forest.train_per_country(spark, lab)
    return lab, _runs[key]


@register("forest_importance", None)
def q_forest_importance(spark, sf_dir):
    """L3 + L4: per-country forest importances in percent (seeded; rows-only check)."""
    _, run = _forest(spark, sf_dir)
    return forest.importances(spark, run)


@register("predict_samples", with_chart(
    """select country, sample, first(spotifyId order by snapshotDate, spotifyId) as spotifyId
       from (select *, 'any' as sample from labelled union all select *, 'hit' from labelled where hit)
       where country in (select country from labelled group by country having count(distinct hit) = 2)
       group by country, sample""", extra=LAB))
def q_predict_samples(spark, sf_dir):
    """L5 + F27: the samples that each trained country predicts (the predictions themselves: tests)."""
    lab, run = _forest(spark, sf_dir)
    return forest.predict_samples(spark, run, lab).where(
        F.col("predictionText").isNotNull()).select("country", "sample", "spotifyId")


@register("score_with_saved", with_chart(
    """select l.country, spotifyId, cast(snapshotDate as varchar) as snapshotDate, dailyRank,
         case when two then 'SCORED' else 'NO_MODEL' end as scoreStatus
       from labelled l join (select country, count(distinct hit) = 2 as two from labelled group by country)
       using (country)""", extra=LAB))
def q_score_with_saved(spark, sf_dir):
    """L6 + S9 + S10: per-country models are saved, loaded and score every row."""
    lab, run = _forest(spark, sf_dir)
    return flat(forest.score(spark, run.model_path, lab).select(
        "country", "spotifyId", "snapshotDate", "dailyRank", "scoreStatus"))


@register("score_equals_model", with_chart(
    """select country, count(*) as rows, count(*) as equalRows
       from labelled group by country having count(distinct hit) = 2""", extra=LAB))
def q_score_equals_model(spark, sf_dir):
    """Per trained country the rows whose prediction in the one pass is that of the saved model itself."""
    lab, run = _forest(spark, sf_dir)
    keys = ["country", "spotifyId", "snapshotDate", "dailyRank"]
    rows = forest.score(spark, run.model_path, lab).where("scoreStatus = 'SCORED'")
    model = None
    for country in sorted(run.models):
        one = forest.predicted_by_model(run.models[country], lab.where(F.col("country") == country))
        one = one.select(*keys, F.col("prediction").alias("modelPrediction"))
        model = one if model is None else model.unionByName(one)
    if model is None:
        return rows.groupBy("country").agg(F.count("*").alias("rows"), F.lit(0).cast("bigint").alias("equalRows"))
    same = F.col("prediction") == F.col("modelPrediction")
    return rows.join(model, keys).groupBy("country").agg(F.count("*").alias("rows"), F.count_if(same).alias("equalRows"))
