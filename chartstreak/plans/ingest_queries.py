"""Registered queries for CSV ingest and cleaning.

The chart is written as CSV to the shared folder and read back through the
ingest; ``corrupt=True`` gives every row one defect by ``defect_code``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from chartstreak.functions.parse import java_trim
from chartstreak.operators import streaks
from chartstreak.plans.common import flat, hits_sql, with_chart
from chartstreak.plans.queries import register
from chartstreak.schemas import RUN_DAYS, TOP_N
from chartstreak.sources.chart import load_chart
from chartstreak.sources.chart_csv import defect_code_sql, write_chart_csv
from chartstreak.sources.csv_ingest import classify_lines, counters, ingest_chart_csv, read_lines

# Expected outcome by defect code, stated here anew (the codes are described in the fixture).
PARSED = [0, 1, 6, 10, 12, 14, 16, 18, 19]
VALID = sorted([*PARSED, 5, 9, 11, 13])


def _codes(ks) -> str:
    return ", ".join(str(k) for k in ks)


def _ingest(spark, sf_dir, corrupt):
    path = write_chart_csv(spark, load_chart(spark, sf_dir), corrupt=corrupt)
    return ingest_chart_csv(spark, path)


def _classified(spark, sf_dir):
    path = write_chart_csv(spark, load_chart(spark, sf_dir), corrupt=True)
    return classify_lines(read_lines(spark, path)).withColumn("lineCountry", F.col("fields")[6])


def _f(c: str) -> str:
    return f"cast(cast({c} as float) as double) as {c}"


# Expected parsed rows of the corrupted CSV, restated per defect code.
PARSED_CHART_SQL = f"""
    coded as (select *, {defect_code_sql()} as code from chart),
    parsed_chart as (
      select spotifyId,
        case code when 0 then name || ', Live' when 1 then name || ' "x"' else name end as name,
        dailyRank, country, snapshotDate, explicit, durationMs,
        case when code = 14 then cast('NaN' as double) else cast(cast(danceability as float) as double) end
          as danceability,
        {_f('energy')}, key, {_f('loudness')}, mode, {_f('speechiness')}, {_f('acousticness')},
        {_f('instrumentalness')}, {_f('liveness')}, {_f('valence')}, {_f('tempo')}, timeSignature
      from coded where code in ({_codes(PARSED)}))"""

_CLEAN_SQL = with_chart(f"""
    select spotifyId, name, dailyRank, country, cast(snapshotDate as varchar) as snapshotDate, explicit,
      durationMs, {_f('danceability')}, {_f('energy')}, key, {_f('loudness')}, mode, {_f('speechiness')},
      {_f('acousticness')}, {_f('instrumentalness')}, {_f('liveness')}, {_f('valence')}, {_f('tempo')},
      timeSignature
    from chart""")


@register("csv_ingest", _CLEAN_SQL)
def q_csv_ingest(spark, sf_dir):
    """S1 + P3: clean CSV round trip through the ingest."""
    return flat(_ingest(spark, sf_dir, corrupt=False).rows)


@register("strict_parse", with_chart(
    "select * replace (cast(snapshotDate as varchar) as snapshotDate) from parsed_chart",
    extra=PARSED_CHART_SQL))
def q_strict_parse(spark, sf_dir):
    """F2-F5 (+P4): rows of the corrupted CSV that parse strictly."""
    return flat(_ingest(spark, sf_dir, corrupt=True).rows)


# Outcome of every line, by defect code: (country seen on the line, reason, valid, parsed).
LINES_SQL = f"""
    coded as (select *, {defect_code_sql()} as code from chart),
    line_outcome as (
      select case when code in (8, 15, 17) then null else country end as lineCountry,
        case when code = 15 then 'empty_line' when code in (8, 17) then 'malformed_csv'
             when code in (2, 3, 4, 7) then 'blank_field' when code = 5 then 'too_few_columns'
             when code in (9, 11, 13) then 'bad_value' end as reason,
        code in ({_codes(VALID)}) as valid, code in ({_codes(PARSED)}) as parsed,
        case when code in (8, 15, 17) then null when code = 5 then 24 when code in (6, 7) then 26 else 25 end
          as nFields,
        code, dailyRank, name
      from coded)"""


@register("drop_blank_rows", with_chart(
    """select lineCountry, count(*) as lines, count_if(reason = 'blank_field') as blankDropped,
         count_if(valid) as kept
       from line_outcome group by lineCountry""", extra=LINES_SQL))
def q_drop_blank_rows(spark, sf_dir):
    """Lines dropped because a field (read, unread or extra) is blank."""
    return (_classified(spark, sf_dir).groupBy("lineCountry")
            .agg(F.count(F.lit(1)).alias("lines"),
                 F.count_if(F.col("reason") == "blank_field").alias("blankDropped"),
                 F.count_if("valid").alias("kept")))


@register("column_count_guard", with_chart(
    """select lineCountry, nFields, count(*) as lines, count_if(valid) as valid, count_if(parsed) as parsed
       from line_outcome group by lineCountry, nFields""", extra=LINES_SQL))
def q_column_count_guard(spark, sf_dir):
    """Short lines count as valid but are not parsed; long lines are kept."""
    return (_classified(spark, sf_dir).groupBy("lineCountry", "nFields")
            .agg(F.count(F.lit(1)).alias("lines"), F.count_if("valid").alias("valid"),
                 F.count_if("parsed").alias("parsed")))


@register("reject_rows", with_chart(
    """select lineCountry, reason, count(*) as lines from line_outcome
       where reason is not null group by lineCountry, reason""", extra=LINES_SQL))
def q_reject_rows(spark, sf_dir):
    """The rejects side output, counted by reason."""
    return (_classified(spark, sf_dir).where(F.col("reason").isNotNull())
            .groupBy("lineCountry", "reason").agg(F.count(F.lit(1)).alias("lines")))


@register("trim_fields", with_chart(
    """select lineCountry, case code when 0 then name || ', Live' when 1 then name || ' "x"' else name end
         as nameTrimmed,
       case code when 9 then case when dailyRank % 2 = 1 then cast(dailyRank as varchar) || '.0'
                                  else '2147483648' end
                 when 10 then '+' || cast(dailyRank as varchar) else cast(dailyRank as varchar) end as rankTrimmed
       from line_outcome where valid and nFields >= 25""", extra=LINES_SQL))
def q_trim_fields(spark, sf_dir):
    """Java trim of fields 1 and 3 on every valid line."""
    c = _classified(spark, sf_dir).where(F.col("valid") & (F.col("nFields") >= 25))
    return c.select("lineCountry", java_trim(F.col("fields")[1]).alias("nameTrimmed"),
                    java_trim(F.col("fields")[3]).alias("rankTrimmed"))


def counters_sql(top_n: int, run: int, wide: bool = False) -> str:
    parsed = PARSED_CHART_SQL.replace("coded as", "coded2 as").replace("from coded where", "from coded2 where")
    return with_chart(
        """select l.lines, l.validRecords, l.parsedRecords, h.hitSongsRecords
           from (select count(*) as lines, count_if(valid) as validRecords, count_if(parsed) as parsedRecords
                 from line_outcome) l,
                (select count(*) as hitSongsRecords from hits) h""",
        wide=wide, extra=LINES_SQL + "," + parsed + "," + hits_sql(top_n, run, "parsed_chart"))


def counted(ing, top_n: int, run: int):
    """One row: lines, valid, parsed, and hits detected on the parsed rows."""
    hits = streaks.detect_hits(ing.rows, top_n, run).agg(F.count(F.lit(1)).alias("hitSongsRecords"))
    names = ["lines", "validRecords", "parsedRecords", "hitSongsRecords"]
    both = counters(ing.lines).unionByName(hits, allowMissingColumns=True)
    return both.agg(*[F.sum(n).alias(n) for n in names])


@register("pipeline_counters", counters_sql(TOP_N, RUN_DAYS))
def q_pipeline_counters(spark, sf_dir):
    """A1: lines, valid, parsed, and hits detected on the parsed rows."""
    return counted(_ingest(spark, sf_dir, corrupt=True), TOP_N, RUN_DAYS)
