import binascii

import numpy as np

from chartstreak.llm import language_id as op

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {r.doc_id: r for r in op.op10_language_id(spark, SF).collect()}
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [i for i in lang if binascii.crc32(str(i).encode()) % 4 == 2]
    assert len(out) == len(lang) and {i for i, r in out.items() if r.held_out} == set(held)
    assert np.mean([out[i].lang_pred == lang[i] for i in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in out.values())


def test_defined_results(spark):
    rows = [(i, "the cat and the dog were there", "en") for i in range(20)]
    rows += [(100 + i, "der hund und die katze waren da", "de") for i in range(20)]
    rows += [(300, None, "en"), (301, "", "de"), (302, "12 34 !?", None), (None, "the cat", "xx"), (303, "die katze", None),
             (304, "the dog " * 50_000, None), (305, "die katze", "en"), (306, "日本語", None)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as score", "2 as lang_pred", "'x' as `draw`")
    model = op.learn(df)
    assert model.languages == ["de", "en"]
    got = {r.doc_id: r for r in op.identify(df, model).collect()}
    assert [got[i].lang_pred for i in (300, 301, 302, 303, 304, 305)] == ["und", "und", "und", "de", "en", "de"]
    assert got[303].score == got[305].score and got[300].score == 0 and got[306].score < 0.05
    assert got[None].held_out is False
    kept = op.keep_known_languages(df, model)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, *_ in rows} - {300, 301, 302, 306}


def test_empty_and_unlabelled_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert op.identify(empty, op.learn(empty)).collect() == []
    plain = spark.createDataFrame([(1, "word", None)], SCHEMA)
    assert [r.lang_pred for r in op.identify(plain, op.learn(plain)).collect()] == ["und"]


def _exact(rows, text, languages):
    """(language, score) by the exact n-gram sets of each language."""
    sets = {n: set().union(*[op.grams(t).tolist() for _, t, l in rows if l == n]) for n in languages}
    found = op.grams(text).tolist()
    if not found:
        return op.UNKNOWN, 0.0
    shares = [sum(g in sets[n] for g in found) / len(found) for n in languages]
    best = int(np.argmax(shares))
    return languages[best], shares[best]


def _random_rows(languages, texts):
    """Labelled texts of words over overlapping alphabets, so that most n-grams belong to several languages."""
    rng = np.random.default_rng(5)
    rows = []
    for l in range(languages):
        letters = [chr(97 + (l + k) % 26) for k in range(9)] + [chr(0xe0 + l % 20)]
        rows += [(len(rows) + i, " ".join("".join(rng.choice(letters, rng.integers(2, 8))) for _ in range(12)), f"l{l:02d}")
                 for i in range(texts)]
    return rows


def test_equals_exact_sets(spark):
    """Every n-gram of the sample is in the filter, the rare ones too: the counts are those of exact sets."""
    rows = _random_rows(4, 15)
    model = op.fit(spark.createDataFrame(rows, SCHEMA))
    probes = [t for _, t, _ in _random_rows(7, 10)] + [t for _, t, _ in rows] + ["", "77", None, "x"]
    assert any(0.1 < _exact(rows, t, model.languages)[1] < 0.9 for t in probes)
    for t in probes:
        language, score = _exact(rows, t, model.languages)
        got = model.predict(t)
        assert abs(got[1] - score) < 0.01
        if sorted([_exact(rows, t, [n])[1] for n in model.languages])[-2:][0] < score - 0.02:
            assert got[0] == language


def test_full_filter_loses_no_gram(spark):
    """Beyond its largest size the filter gets fuller; a language's own texts still hit in full."""
    rows = _random_rows(3, 40)
    model = op.fit(spark.createDataFrame(rows, SCHEMA), cell_bits=(8, 12))
    assert model.cells.shape == (1, 1 << 12) and max(model.false_positive) > 0.01
    for _, t, l in rows:
        got = model.predict(t)
        assert got[1] > 1 - 1e-9
    far = model.predict("".join(chr(0x4e00 + k) for k in range(5000)))      # 10,000 n-grams, none of them learned
    assert far[1] < 0.05


def test_ties_go_to_the_first_language(spark):
    rows = [(1, "same words here", "b"), (2, "same words here", "a"), (3, "other", "c"), (4, "other", None)]
    model = op.fit(spark.createDataFrame(rows, SCHEMA))
    assert model.predict("same words here") == ("a", 1.0)


def test_rows_per_language_bound(spark):
    rows = [(i, f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}", "en" if i % 2 else "de")
            for i in range(2000)]
    df = spark.createDataFrame(rows, SCHEMA)
    few, all_ = op.fit(df, rows_per_language=100), op.fit(df)
    assert max(few.false_positive) < min(all_.false_positive) / 20


def test_many_languages_in_as_many_jobs(spark):
    """Two words of masks; the number of jobs does not hang on the number of languages."""
    def jobs(languages):
        rows = [(i, "".join(chr(0x4e00 + 30 * i + k) for k in range(20)), f"l{i:02d}") for i in range(languages)]
        df = spark.createDataFrame(rows, SCHEMA)
        spark.sparkContext.setJobGroup(f"languages-{languages}", "")
        model = op.fit(df)
        for _, t, n in rows:
            assert model.predict(t)[0] == n
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"languages-{languages}"))
    few, many = jobs(5), jobs(70)
    assert 0 < many <= few + 1


def test_without_a_language_texts_with_a_letter_stay(spark):
    texts = ["some words", "Ä", "123 !", "", None]
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    assert {r.doc_id for r in op.keep_known_languages(df, op.learn(df)).collect()} == {0, 1}
