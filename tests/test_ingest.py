"""Malformed-CSV corpus: each line alone, 25 columns unless said."""

import math

import pytest
from pyspark.sql import functions as F

from chartstreak.schemas import CHART_SCHEMA
from chartstreak.sources.chart_csv import HEADER, chart_csv_lines, write_chart_csv
from chartstreak.sources.csv_ingest import classify_lines, ingest_chart_csv


def line(**over):
    f = ["id1", "Song A", "Artist", "5", "0", "1", "US", "2024-01-05", "80", "false", "200000", "Album",
         "2023-01-01", "0.712", "0.5", "7", "-6.5", "1", "0.05", "0.1", "0.0", "0.12", "0.65", "120.0", "4"]
    for k, v in over.items():
        f[int(k[1:])] = v
    return ",".join(f)


CLEAN = line()
CASES = [
    ("clean", CLEAN, True, True),
    ("quoted comma", line(p1='"Song, A"'), True, True),
    ("doubled quote", line(p1='"Song ""A"""'), True, True),
    ("unread empty", line(p2=""), False, False),
    ("unread quoted blank", line(p2='" "'), False, False),
    ("unread tab", line(p4="\t"), False, False),
    ("unread empty quotes", line(p5='""'), False, False),
    ("24 columns", ",".join(CLEAN.split(",")[:24]), True, False),
    ("26 columns", CLEAN + ",x", True, True),
    ("26 columns last blank", CLEAN + ",", False, False),
    ("open quote middle", line(p8='"80'), False, False),
    ("open quote last", line(p24='"4'), False, False),
    ("text after closing quote", line(p1='"Song"A'), False, False),
    ("rank 5.0", line(p3="5.0"), True, False),
    ("rank abc", line(p3="abc"), True, False),
    ("rank overflow", line(p3="2147483648"), True, False),
    ("rank +5", line(p3="+5"), True, True),
    ("rank padded", line(p3=" 5 "), True, True),
    ("date 2024-1-5", line(p7="2024-1-5"), True, False),
    ("date 2024-01", line(p7="2024-01"), True, False),
    ("date 2024-02-30", line(p7="2024-02-30"), True, False),
    ("date with time", line(p7="2024-01-05T10:00"), True, False),
    ("explicit TRUE", line(p9="TRUE"), True, True),
    ("explicit yes", line(p9="yes"), True, True),
    ("dance inf", line(p13="inf"), True, False),
    ("dance Infinity", line(p13="Infinity"), True, True),
    ("dance NaN", line(p13="NaN"), True, True),
    ("dance 1.0f", line(p13="1.0f"), True, True),
    ("empty line", "", False, False),
    ("blank line", "   ", False, False),
    ("blank after closing quote", line(p1='"Song A" \t'), True, True),
    ("blank then text after closing quote", line(p1='"Song A" x'), False, False),
    ("2,000 extra fields", CLEAN + ",x" * 2_000, True, True),
    ("100,000 extra fields", CLEAN + ",x" * 100_000, True, True),
    ("100,000 fields, the last open", CLEAN + ",x" * 100_000 + ',"', False, False),
    ("50,000 doubled quotes", line(p1='"' + '""' * 50_000 + '"'), True, True),
]


@pytest.fixture(scope="module")
def classified(spark):
    df = spark.createDataFrame([(c[0], c[1]) for c in CASES], "case string, value string")
    return {r["case"]: r for r in classify_lines(df).collect()}


@pytest.mark.parametrize("case,text,valid,parsed", CASES, ids=[c[0] for c in CASES])
def test_corpus(classified, case, text, valid, parsed):
    r = classified[case]
    assert (r["valid"], r["parsed"]) == (valid, parsed), r["reason"]


def test_values(classified):
    assert classified["quoted comma"]["name"] == "Song, A"
    assert classified["doubled quote"]["name"] == 'Song "A"'
    assert classified["rank +5"]["dailyRank"] == 5
    assert classified["rank padded"]["dailyRank"] == 5
    assert classified["explicit TRUE"]["explicit"] is True
    assert classified["explicit yes"]["explicit"] is False
    assert math.isnan(classified["dance NaN"]["danceability"])
    assert classified["clean"]["danceability"] == pytest.approx(0.7120000123977661, abs=0)
    assert classified["clean"]["durationMs"] == 200000
    assert classified["blank after closing quote"]["name"] == "Song A"
    assert classified["100,000 extra fields"]["nFields"] == 100_025


def test_counters_and_header(spark, tmp_path):
    p = tmp_path / "songs.csv"
    lines = ["h0,h1,h2", CLEAN, line(p2=""), ",".join(CLEAN.split(",")[:24]), line(p3="x"), line(p1="B")]
    p.write_text("\n".join(lines) + "\n")
    ing = ingest_chart_csv(spark, str(p))
    rows = ing.rows.collect()
    assert len(rows) == 2
    c = ing.counters.get
    assert (c["validRecords"], c["parsedRecords"]) == (4, 2)
    reasons = sorted(r["reason"] for r in ing.rejects.collect())
    assert reasons == ["bad_value", "blank_field", "too_few_columns"]


def test_one_line_is_left_out_per_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join(["head a", CLEAN, "head a", CLEAN]) + "\n")
    (tmp_path / "b.csv").write_text("\n".join(["another head", line(p1="B")]) + "\n")
    (tmp_path / "c.csv").write_text("\n".join([line(p1="first"), line(p1="C")]) + "\n")
    (tmp_path / "d.csv").write_text("")
    ing = ingest_chart_csv(spark, str(tmp_path))
    assert sorted(r["name"] for r in ing.rows.collect()) == ["B", "C", "Song A", "Song A"]
    assert [r["line"] for r in ing.rejects.collect()] == ["head a"]


def test_fields_are_split_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join(["head", CLEAN]) + "\n")
    ing = ingest_chart_csv(spark, str(tmp_path))
    for df in (ing.rows, ing.rejects):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_extract_all(") == 1


def chart_rows(spark, n):
    """Rows of a chart; every one's defect code is 15 (an empty line) where ``id % 4`` is 0."""
    values = {"string": F.lit("S"), "integer": F.lit(1), "bigint": F.lit(1), "double": F.lit(0.5),
              "boolean": F.lit(True), "date": F.lit("2024-01-08").cast("date")}
    cols = [values[f.dataType.typeName().replace("long", "bigint")].cast(f.dataType).alias(f.name)
            for f in CHART_SCHEMA if f.name not in ("name", "dailyRank")]
    rank = F.when(F.col("id") % 4 == 0, 1).otherwise(4).cast("int")
    return spark.range(0, n, 1, 9).select(
        F.concat(F.lit("Song "), F.col("id")).alias("name"), rank.alias("dailyRank"), *cols).select(*CHART_SCHEMA.names)


@pytest.mark.parametrize("corrupt", [False, True])
def test_each_task_writes_its_lines_as_a_file_with_a_header(spark, tmp_path, corrupt):
    chart = chart_rows(spark, 900)
    path = write_chart_csv(spark, chart, corrupt=corrupt, path=str(tmp_path / "csv"))
    files = [f.read_text().split("\n")[:-1] for f in (tmp_path / "csv").rglob("*.txt")]
    assert len(files) == 9                           # as many as the chart has partitions, not a fixed number
    assert all(f[0] == HEADER and HEADER not in f[1:] and len(f) == 101 for f in files)
    want = sorted(r[0] for r in chart_csv_lines(chart, corrupt).collect())
    assert sorted(v for f in files for v in f[1:]) == want
    assert sum(not v for v in want) == (225 if corrupt else 0)
    ing = ingest_chart_csv(spark, path)
    assert sorted(r[0] for r in ing.lines.select("value").collect()) == want


def test_no_shuffle_gathers_the_lines(spark, tmp_path):
    jvm = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("csv-write", "csv")
    try:
        write_chart_csv(spark, chart_rows(spark, 900), path=str(tmp_path / "csv"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [jvm.getStageInfo(s).numTasks for j in jvm.getJobIdsForGroup("csv-write") for s in jvm.getJobInfo(j).stageIds]
    assert stages == [9]


def test_empty_chart(spark, tmp_path):
    path = write_chart_csv(spark, chart_rows(spark, 0), path=str(tmp_path / "csv"))
    assert ingest_chart_csv(spark, path).lines.count() == 0
