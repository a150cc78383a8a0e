import hashlib
import random
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from chartstreak.llm import substring_dedup as op

SCHEMA = "doc_id long, text string, runs int, cut_text string"


def corpus(seed=2):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    sentence = lambda: " ".join(word() for _ in range(rng.randint(1, 30))).capitalize() + rng.choice(".!?")
    passages = [" ".join(sentence() for _ in range(6)) + " " + " ".join(word() for _ in range(40)) + "." for _ in range(5)]
    rows = []
    for i in range(80):
        parts = [sentence() for _ in range(rng.randint(0, 12))]
        for p in rng.sample(passages, rng.choice([0, 0, 1, 2])):
            parts.insert(rng.randint(0, len(parts)), f"\n{p}\n")
        rows.append((i, rng.choice([" ", "  ", "\n"]).join(parts), 1, "x"))
    common = "Common line here. Two more. Three."
    rows = [(i, t + "\n" + common if i % 3 else t, r, x) for i, t, r, x in rows]
    return rows + [(200, None, 1, "x"), (201, "", 1, "x"), (202, "   \n ", 1, "x"), (203, "Same. " * 20_000, 1, "x")], passages


def brute(rows, span=3, least=32):
    first, covered = {}, defaultdict(set)
    for i, text in sorted((r[0], r[1] or "") for r in rows):
        units = [tuple(w) for _, w in op.sentences(text)]
        for at in range(len(units) - span + 1):
            run = tuple(units[at:at + span])
            if first.setdefault(run, (i, at)) != (i, at):
                covered[i].add(at)
    return {r[0]: op.without(r[1] or "", sorted(covered[r[0]]), span, least)[0] if covered[r[0]] else r[1] or ""
            for r in rows}


def test_passages_go_from_all_but_the_first(spark):
    rows, passages = corpus()
    out = {r.doc_id: r.text for r in op.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out == brute(rows)
    for p in passages:
        assert sum(p in t for t in out.values()) == 1
    untouched = [r for r in rows if r[1] and not any(p in r[1] for p in passages) and r[0] < 200]
    assert untouched and all(out[i] == t for i, t, *_ in untouched)


def test_columns_counts_and_repeated_rows(spark):
    rows, _ = corpus()
    df = spark.createDataFrame(rows + [rows[3], (None, rows[4][1], 1, "x")], SCHEMA)
    out = op.remove_repeats(df, counts=True)
    assert out.columns == df.columns + ["removed_sentences", "removed_words"]
    got = out.collect()
    assert len(got) == len(rows) + 2
    assert len({r.text for r in got if r.doc_id == rows[3][0]}) == 1


def test_passages_inside_a_sentence_fall_into_step(spark):
    """All word windows that repeat, by brute force: but for the ends of a passage they are found wherever it begins."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    words = lambda n: [word() for _ in range(n)]
    passage = words(120)
    texts = [words(k) + passage + words(rng.randint(3, 30)) for k in (5, 8, 17, 18, 29, 40, 0)] + [words(90), words(400)]
    rows = [(i, " ".join(t), 1, "x") for i, t in enumerate(texts)]
    out = {r.doc_id: r for r in op.remove_repeats(spark.createDataFrame(rows, SCHEMA), counts=True).collect()}
    seen, most = set(), op.NEAR + op.LONGEST
    for i, t in enumerate(texts):
        windows = [tuple(t[k:k + 32]) for k in range(len(t) - 31)]
        again = {k + j for k, w in enumerate(windows) if w in seen for j in range(32)}
        seen.update(windows)
        assert len(again) - 2 * most <= out[i].removed_words <= len(again), i
        kept = out[i].text.split()
        assert kept[:min(again, default=0)] == t[:min(again, default=0)] and (again or out[i].text == rows[i][1])
        assert [w for w in t if w not in passage] == [w for w in kept if w not in passage]
    assert out[1].removed_words >= 80


def test_empty_table(spark):
    assert op.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab .!?\n\t é", max_size=200))
def test_sentences_cover_the_text(text):
    units = list(op.sentences(text))
    assert [w for _, words in units for w in words] == text.split()
    assert [s for s, _ in units] == sorted({s for s, _ in units})
    assert op.without(text, [], 3, 1) == (text, 0, 0)


def test_texts_of_equal_32_bit_hash_keep_their_own_cuts(spark):
    """Two rows without an id, one with a repeated passage and one all its own, whose 32-bit hashes are equal."""
    from pyspark.sql import functions as F
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    passage, own = " ".join(word() for _ in range(120)), " ".join(word() for _ in range(120))
    ids = spark.range(400_000)
    a = ids.select(F.concat(F.lit(passage + " "), F.col("id").cast("string")).alias("a")).withColumn("h", F.hash("a"))
    b = ids.select(F.concat(F.lit(own + " "), F.col("id").cast("string")).alias("b")).withColumn("h", F.hash("b"))
    digest = lambda t: hashlib.sha256(t.encode()).digest()  # noqa: E731  rows without an id come by it
    pair = next(p for p in a.join(b, "h").collect() if digest(p.a) > digest(passage))
    rows = [(None, passage, 1, "x"), (None, pair.a, 1, "x"), (None, pair.b, 1, "x")]
    out = [r.text for r in op.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert pair.b in out and pair.a not in out


def test_clashing_names_and_names_in_capitals(spark):
    rows, _ = corpus()
    named = "doc_id long, Text string, removed_sentences int, run_code string"
    df = spark.createDataFrame(rows, named)
    out = op.remove_repeats(df, counts=True)
    assert out.columns == df.columns + ["removed_sentences_", "removed_words"]
    assert {r.doc_id: r.Text for r in out.collect()} == brute(rows)


def test_shortest_stretches_go_too(spark):
    rows, _ = corpus(5)
    out = {r.doc_id: r.text for r in op.remove_repeats(spark.createDataFrame(rows, SCHEMA), least_words=1).collect()}
    assert out == brute(rows, least=1) != brute(rows)


def test_runs_are_shuffled_once(spark):
    rows, _ = corpus()
    runs = op.repeated_runs(spark.createDataFrame(rows, SCHEMA), "doc_id", "text", 3)
    plan = runs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(span#") == 1


def test_a_run_of_many_texts_leaves_its_batch_once():
    import pandas as pd
    text = "One two three. Four five. Six. " * 3
    frame = pd.DataFrame({"doc_id": [5, 4, 0, 4], "has_id": [True, True, False, True], "code": [b""] * 4,
                          "number": [0, 1, 2, 3], "text": [text, text, text, "Alone here. " + text]})
    out, = op._hashes(3)([frame])
    runs = [list(zip(*both)) for both in zip(out["spans"], out["more"])]
    # the row without an id comes first; its first three runs repeat inside it
    assert [list(p) for p in out["places"]] == [[], [], [0, 1, 2], [0]]
    assert [list(k) for k in out["known"]] == [[*range(7)], [*range(7)], [3, 4, 5, 6], [*range(1, 8)]]
    assert len({r for here in runs for r in here}) == sum(map(len, runs)) == 4


def test_order_of_rows_does_not_hang_on_batches(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    sentence = lambda: " ".join(word() for _ in range(8)) + "."
    passage = "\n".join(sentence() for _ in range(8))
    big = 1 << 60
    ids = [big + 2, 7, big + 1, None, -5, big + 2]
    own = [sentence() for _ in ids]
    rows = [(i, f"{o}\n{passage}", 1, "x") for i, o in zip(ids, own)] + [(7, f"{own[1]}\n{passage}", 1, "x")]
    conf, before = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get(
        "spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in (1, 2, 1000):
            spark.conf.set(conf, size)
            for keep in (rows, rows[:3] + rows[4:]):
                out = op.remove_repeats(spark.createDataFrame(keep, SCHEMA).coalesce(1)).collect()
                with_passage = [r.doc_id for r in out if passage in r.text]
                assert with_passage == ([None] if keep is rows else [-5]), size
                assert sorted(r.text.split("\n")[0] for r in out) == sorted(r[1].split("\n")[0] for r in keep)
    finally:
        spark.conf.set(conf, before)
