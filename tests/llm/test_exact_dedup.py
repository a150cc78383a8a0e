import hashlib
import random

from chartstreak.llm import exact_dedup as op

SCHEMA = "doc_id long, text string, digest string, run int, kept_id string"


def rows_of(n=400, seed=5):
    rng = random.Random(seed)
    texts = ["", None, "a", "a ", "Ä", "hot"] + [f"t{i}" for i in range(60)] + ["long " * 60_000]
    return [(i, "hot" if rng.random() < 0.4 else rng.choice(texts), "x", i, "y") for i in range(n)]


def brute(rows, keep=max):
    groups = {}
    for i, text, *_ in rows:
        groups.setdefault(text or "", []).append(i)
    return {i: (keep(groups[t or ""]), len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest())
            for i, t, *_ in rows}


def test_groups_match_brute_force(spark):
    rows = rows_of()
    for keep, pick in (("largest", max), ("smallest", min)):
        out = op.exact_dedup(spark.createDataFrame(rows, SCHEMA), keep=keep, fan_in=4, rounds=3).collect()
        assert len(out) == len(rows)
        want = brute(rows, pick)
        for r in out:
            assert (r.keep_id, r.group_size, r.text_sha256) == want[r.doc_id]
            assert r.kept == (r.doc_id == r.keep_id)


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "a"), (1, "a"), (None, "a"), (None, "b"), (None, "b"), (2, "c"), (2, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = op.exact_dedup(df).collect()
    assert len(out) == 7 and sum(r.kept for r in out) == 4
    assert {r.keep_id for r in out if r.group_size == 3} == {1}
    kept = sorted(op.drop_exact_copies(df).collect(), key=str)
    assert kept == sorted([(1, "a"), (None, "b"), (2, "c"), (2, "d")], key=str)


def test_columns_pass_through(spark):
    df = spark.createDataFrame(rows_of(50), SCHEMA)
    out = op.drop_exact_copies(df)
    assert out.columns == df.columns
    assert out.count() == len({r[1] or "" for r in rows_of(50)})


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert op.exact_dedup(df).collect() == [] and op.drop_exact_copies(df).collect() == []


def test_columns_that_look_like_its_own(spark):
    from chartstreak.llm.exact_dedup import drop_exact_copies
    schema = "doc_id long, text string, kept_sha256 string, kept_sha256_ string, own_sha256 int, kept_id long"
    rows = [(1, "a", "x", "y", 1, 1), (2, "a", "x", "y", 1, 1), (3, None, None, None, None, None)]
    out = drop_exact_copies(spark.createDataFrame(rows, schema))
    assert out.columns == [f.split()[0] for f in schema.split(", ")]
    assert sorted(tuple(r) for r in out.collect()) == [rows[1], rows[2]]
