"""Registered queries for JSON I/O and importance documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartstreak.operators import importance as imp
from chartstreak.plans.common import flat, labelled_sql, with_chart
from chartstreak.plans.profile_queries import fsql
from chartstreak.plans.queries import _label_sql, labelled, register
from chartstreak.schemas import FEATURE_NAMES, RUN_DAYS, TOP_N
from chartstreak.session import shared_path
from chartstreak.sources import json_io

LAB = labelled_sql(TOP_N, RUN_DAYS)
SEARCH_TEXT = "I"
COMPARE = ["click", "view", "signup"]
CHARACTERISTIC = "energy"


@register("json_roundtrip", _label_sql("final", "annotate"))
def q_json_roundtrip(spark, sf_dir):
    """S4 then S3: labelled rows -> JSON lines (text) -> strict typed rows."""
    path = shared_path(spark, "labelled-jsonl")
    json_io.to_json_lines(labelled(spark, sf_dir)).write.mode("overwrite").text(path)
    return flat(json_io.from_json_lines(spark.read.text(path), strict=True))


@register("json_sink", _label_sql("final", "annotate"))
def q_json_sink(spark, sf_dir):
    """JSON file sink (rolled by record count), read back with a fixed schema."""
    path = json_io.write_json_lines(labelled(spark, sf_dir), shared_path(spark, "labelled-json"),
                                    max_records_per_file=500)
    return flat(json_io.read_labelled_json(spark, path))


def importance_long(spark, sf_dir):
    return imp.percent_normalise(imp.mean_gap_scores(labelled(spark, sf_dir)))


def importance_docs(spark, sf_dir):
    """Documents written per country (S8) and read back."""
    path = shared_path(spark, "importance")
    json_io.write_importance_docs(imp.to_documents(importance_long(spark, sf_dir)), path)
    return json_io.read_importance_docs(spark, path)


def _raw_sql():
    stats = ", ".join(
        f"avg(case when hit then {fsql(n)} end) as {n}__h, avg(case when not hit then {fsql(n)} end) as {n}__n, "
        f"max({fsql(n)}) - min({fsql(n)}) as {n}__r" for n in FEATURE_NAMES)
    raws = " union all ".join(
        f"select country, {i} as pos, '{n}' as feature, "
        f"coalesce(case when {n}__r > 0 then abs({n}__h - {n}__n) / {n}__r end, 0.0) as raw from imp_stats"
        for i, n in enumerate(FEATURE_NAMES))
    return f"""
    imp_stats as (select country, {stats} from labelled group by country),
    imp_raw as ({raws}),
    imp_pct as (select *, case when sum(raw) over (partition by country) <> 0
                          then raw / sum(raw) over (partition by country) * 100.0 end as pct from imp_raw),
    imp as (select country, pos, feature,
              case when pct is null or isnan(pct) then 0.0 else floor(pct * 100.0 + 0.5) / 100.0 end as importance
            from imp_pct)"""


IMP = LAB + "," + _raw_sql()


@register("percent_normalise", with_chart("select country, pos, feature, importance from imp", extra=IMP))
def q_percent_normalise(spark, sf_dir):
    """A5: raw scores -> percent of the country's total, 2 decimals half-up."""
    return importance_long(spark, sf_dir).select("country", "pos", "feature", "importance")


_DOC_JSON = "json_object(" + ", ".join(
    f"'{n}', max(case when feature = '{n}' then importance end)" for n in FEATURE_NAMES) + ")"


@register("importance_docs", with_chart(
    f"select country, cast({_DOC_JSON} as varchar) as featureImportances from imp group by country", extra=IMP))
def q_importance_docs(spark, sf_dir):
    """S8 + M4: nested documents, written per country and read back."""
    docs = importance_docs(spark, sf_dir)
    return docs.select("country", F.to_json("featureImportances").alias("featureImportances"))


@register("importance_read", with_chart(
    "select country, " + ", ".join(f"max(case when feature = '{n}' then importance end) as {n}"
                                   for n in FEATURE_NAMES) + " from imp group by country", extra=IMP))
def q_importance_read(spark, sf_dir):
    """All documents into one country -> characteristics lookup."""
    return imp.as_columns(importance_docs(spark, sf_dir))


@register("importance_unpivot", with_chart(
    "select country, pos, feature, importance from imp", extra=IMP))
def q_importance_unpivot(spark, sf_dir):
    """M1: document map -> (country, feature, importance) rows."""
    return imp.unpivot(importance_docs(spark, sf_dir))


@register("importance_keys", with_chart("select country, pos, feature from imp", extra=IMP))
def q_importance_keys(spark, sf_dir):
    """M2: characteristic names of every document."""
    return imp.keys(importance_docs(spark, sf_dir))


@register("country_search", with_chart(
    f"select distinct country from imp where contains(lower(country), lower('{SEARCH_TEXT}'))", extra=IMP))
def q_country_search(spark, sf_dir):
    """Case-insensitive substring search on the country code."""
    return imp.search(importance_docs(spark, sf_dir), SEARCH_TEXT).select("country")


@register("compare_countries", with_chart(
    "select pos, feature, " + ", ".join(f"max(case when country = '{c}' then importance end) as {c}"
                                        for c in COMPARE)
    + f" from imp where country in ({', '.join(repr(c) for c in COMPARE)}) group by pos, feature", extra=IMP))
def q_compare_countries(spark, sf_dir):
    """P9 + M3: selected countries side by side for every characteristic."""
    return imp.compare(importance_docs(spark, sf_dir), COMPARE)


@register("compare_characteristic", with_chart(
    f"select country, importance as {CHARACTERISTIC} from imp where feature = '{CHARACTERISTIC}' "
    f"and country in ({', '.join(repr(c) for c in COMPARE)})", extra=IMP))
def q_compare_characteristic(spark, sf_dir):
    """Selected countries x one characteristic (the bar chart's data)."""
    return imp.compare(importance_docs(spark, sf_dir), COMPARE, CHARACTERISTIC)
