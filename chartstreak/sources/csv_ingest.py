"""Read position-addressed chart CSV with row-level cleaning.

One line is one record (no quoted newlines). Per line:

1. empty line                                   -> no record
2. not valid CSV (unterminated quote, text after a closing quote)
                                                -> dropped, not counted
3. any field blank (also unread and extra ones) -> dropped, not counted
4. otherwise counted *valid*; fewer than 25 fields, or a field that does not
   parse strictly                               -> dropped (reason kept)
5. otherwise *parsed*: the 19 typed fields of ``CHART_SCHEMA``.

Fields are split JVM-side with one regular expression (comma separator,
``"`` quotes, ``""`` escape), so every step is a column expression in one
whole-stage-codegen pass over the lines; nothing runs in Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from chartstreak.functions.parse import (is_blank, java_bool, java_trim, strict_date,
                                          strict_float, strict_int)
from chartstreak.schemas import CHART_FIELDS, CSV_POSITIONS, MIN_CSV_COLUMNS
from chartstreak.session import materialise

# --- fixed values: CSV field grammar (comma, double quote, doubled-quote escape)
_QUOTED = r'"(?:[^"]++|"")*+"[ \t\x0B\f\r\x1C-\x1F]*+'   # blanks may follow a closing quote
_PLAIN = r'[^,"][^,]*+'
# possessive throughout: the match is a loop, however many fields a line has
LINE_PATTERN = rf"^(?:,(?:{_QUOTED}|{_PLAIN}|))++$"     # applied to ',' + line
FIELD_PATTERN = rf",({_QUOTED}|{_PLAIN}|)"               # one field per match
# ---------------------------------------------------------------------------

_PARSERS = {"string": java_trim, "int": strict_int, "float": strict_float,
            "bool": java_bool, "date": strict_date}


def _unquote(tok: Column) -> Column:
    """A quoted field loses its outer quotes and ``""`` becomes ``"``."""
    inner = F.regexp_replace(F.regexp_replace(F.substring(tok, 2, 1 << 30), r'"[ \t\x0B\f\r\x1C-\x1F]*+\z', ""),
                             '""', '"')
    return F.when(tok.startswith('"'), inner).otherwise(tok)


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns whose expressions are evaluated once per row.

    A one-element ``inline`` keeps the optimizer from copying the expressions
    into every filter and column that uses them.
    """
    values = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline(F.array(values)))


def classify_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Add ``fields``, ``valid``, ``parsed``, ``reason`` and the 19 typed columns."""
    line = F.col(line_col)
    prefixed = F.concat(F.lit(","), line)
    well_formed = prefixed.rlike(LINE_PATTERN)
    raw = F.regexp_extract_all(prefixed, F.lit(FIELD_PATTERN), 1)
    fields = F.transform(raw, _unquote)
    df = _once(lines, _empty=line == "", _wf=well_formed)
    df = _once(df, fields=F.when(F.col("_wf") & ~F.col("_empty"), fields))
    any_blank = F.exists("fields", lambda v: is_blank(v))
    typed = {}
    for pos, name, kind in CSV_POSITIONS:
        v = F.when(F.size("fields") >= MIN_CSV_COLUMNS, F.col("fields")[pos])
        typed[name] = _PARSERS[kind](v)
    df = _once(df, nFields=F.size("fields"), _blank=any_blank, **typed)
    all_parsed = F.lit(True)
    for name in CHART_FIELDS:
        all_parsed = all_parsed & F.col(name).isNotNull()
    reason = (F.when(F.col("_empty"), "empty_line")
              .when(~F.col("_wf"), "malformed_csv")
              .when(F.col("_blank"), "blank_field")
              .when(F.col("nFields") < MIN_CSV_COLUMNS, "too_few_columns")
              .when(~all_parsed, "bad_value"))
    df = _once(df, reason=reason)
    return (df.withColumn("valid", F.coalesce(~F.col("reason").isin("empty_line", "malformed_csv", "blank_field"),
                                              F.lit(True)))
              .withColumn("parsed", F.col("reason").isNull())
              .drop("_empty", "_wf", "_blank"))


@dataclass
class Ingest:
    lines: DataFrame        # every non-header line, classified
    rows: DataFrame         # parsed chart rows (CHART_SCHEMA)
    rejects: DataFrame      # (line, reason) for every dropped line
    counters: Observation   # validRecords, parsedRecords (filled by an action on ``rows``)


HEADER_BROADCAST_MAX_BYTES = 64 << 20


def read_lines(spark: SparkSession, path: str, header: bool | str = True) -> DataFrame:
    """Text lines of the CSV file(s).

    ``header=True`` leaves out the first line of every file, whatever it
    holds, and no other line. A string leaves out the lines equal to it.
    """
    lines = spark.read.text(path)
    if isinstance(header, str):
        return lines.where(F.col("value") != F.lit(header)).select("value")
    if not header:
        return lines.select("value")
    # Rows are numbered within the scan's partitions; both scans below have the same splits. A file's first line is
    # the smallest number in its first block.
    numbered = lines.select("value", F.col("_metadata.file_path").alias("_file"),
                            F.col("_metadata.file_block_start").alias("_block"),
                            F.monotonically_increasing_id().alias("_row"))
    first = materialise(numbered.where("_block = 0").groupBy("_file").agg(F.min("_row").alias("_first")), "csv-headers")
    size = first.agg(F.sum(F.octet_length("_file") + 8)).first()[0] or 0
    first = F.broadcast(first) if size <= HEADER_BROADCAST_MAX_BYTES else first
    return numbered.join(first, "_file", "left").where(
        F.col("_first").isNull() | (F.col("_row") != F.col("_first"))).select("value")


def ingest_chart_csv(spark: SparkSession, path: str, header: bool | str = True,
                     name: str = "chart_ingest") -> Ingest:
    classified = classify_lines(read_lines(spark, path, header))
    obs = Observation(name)
    observed = classified.observe(obs, F.count_if("valid").alias("validRecords"),
                                  F.count_if("parsed").alias("parsedRecords"))
    rows = observed.where("parsed").select(*CHART_FIELDS)
    rejects = classified.where(~F.col("parsed")).select(F.col("value").alias("line"), "reason")
    return Ingest(classified, rows, rejects, obs)


def counters(classified: DataFrame) -> DataFrame:
    """A1 as a one-row DataFrame: lines, valid, parsed (one aggregation pass)."""
    return classified.agg(F.count(F.lit(1)).alias("lines"),
                          F.count_if("valid").alias("validRecords"),
                          F.count_if("parsed").alias("parsedRecords"))
