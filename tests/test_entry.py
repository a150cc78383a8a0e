"""Driver contract and a sample of query/oracle pairs at sf0.01, where rule (10, 14) gives hits."""

import duckdb
import pytest

import __spark_entry__ as entry

SF01 = "/root/testdata/sf0.01"
TABLES = ["events"]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "hit" in df.columns and "consecutiveHitDaysList" in df.columns
    assert df.where("hit").count() > 0


def test_oracles_are_subset():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 45


FAST = ["top_rank_filter", "longest_streak", "hit_detect", "label_final", "label_causal", "label_replace",
        "describe_bands", "short_summary", "song_profile", "percent_normalise", "strict_parse", "reject_rows",
        "hit_detect_retract", "hit_detect_auto", "hit_detect_wide", "label_final_wide", "class_balance_wide"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if v != v else round(v, 6)
    return v


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF01}/{t}.parquet')")
    df = entry.queries()[name](spark, SF01)
    assert not df.isEmpty()
    cols = df.columns
    s = sorted((tuple(_norm(r[c]) for c in sorted(cols)) for r in df.collect()), key=repr)
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == sorted(cols)
    idx = [ocols.index(c) for c in sorted(cols)]
    o = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert s == o


def _registered(tmp_path, prepare):
    """Number of queries that a copy of the repository registers, and what it says."""
    import os
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.abspath(entry.__file__))
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "tests"))
    prepare(copy)
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()))"], cwd=copy,
                          capture_output=True, text=True, timeout=120)
    return done


def test_other_queries_stay_without_the_operators_or_their_libraries(tmp_path):
    import shutil

    def without(copy):
        shutil.rmtree(copy / "chartstreak" / "llm", ignore_errors=True)
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    alone = _registered(tmp_path / "a", without)
    assert int(alone.stdout) >= 61
    assert not (tmp_path / "a" / "copy" / "chartstreak" / "llm").exists()

    def library(copy):
        package = copy / "chartstreak" / "llm"
        package.mkdir(exist_ok=True)
        (package / "__init__.py").write_text("")
        (package / "queries.py").write_text("import a_library_that_is_not_there\n")
    missing = _registered(tmp_path / "b", library)
    assert missing.stdout == alone.stdout and "a_library_that_is_not_there" in missing.stderr

    def mistyped(copy):
        package = copy / "chartstreak" / "llm"
        package.mkdir(exist_ok=True)
        (package / "__init__.py").write_text("")
        (package / "queries.py").write_text("import chartstreak.llm.mistyped\n")
    assert _registered(tmp_path / "c", mistyped).returncode != 0
