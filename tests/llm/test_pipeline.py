import random

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(9)
    vocabulary = {"en": ["the", "house", "with", "river", "and", "night", "light", "thing", "under", "water"],
                  "de": ["der", "strasse", "und", "nicht", "auch", "wasser", "licht", "unter", "über", "schön"]}

    def text(lang, n):
        words = [rng.choice(vocabulary[lang]) + rng.choice(["", "s", "er", "ing"]) for _ in range(n)]
        return " ".join(w + ("." if rng.random() < 0.1 else "") for w in words) + "."
    rows = [(i, text("en" if i % 3 else "de", rng.randint(5, 200)), "en" if i % 3 else "de") for i in range(120)]
    passage = text("en", 80)
    rows += [(200 + i, text("en", 60) + "\n" + passage + "\n" + text("en", 60), "en") for i in range(5)]
    rows += [(300 + i, rows[7][1], "en") for i in range(4)]
    long = text("en", 400)
    rows += [(400 + i, long.replace(" ", "  ", i) + (" extra" if i else ""), "en") for i in range(3)]
    rows += [(500, None, "en"), (501, "", None), (502, "123 456 !", "de"), (503, text("en", 9000), "en")]
    return [(i, t, lang, "s", len(t or "")) for i, t, lang in rows], passage


def stages(spark, df):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, "")
        out.append((name, df))
    return dict(out)


def test_stages_take_effect(spark):
    rows, passage = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    out = stages(spark, df)
    ids = {name: {r.doc_id for r in d.select("doc_id").collect()} for name, d in out.items()}
    every = {r[0] for r in rows}
    assert ids["language_id"] == every - {500, 501, 502}
    assert ids["exact_dedup"] == ids["language_id"] - {7, 300, 301, 302}
    assert ids["minhash_near_dedup"] == ids["exact_dedup"] - {401, 402}
    texts = {r.doc_id: r for r in out["substring_dedup"].collect()}
    assert ids["substring_dedup"] == ids["minhash_near_dedup"]
    assert sum(passage in r.text for r in texts.values()) == 1
    original = {r[0]: r[1] for r in rows}
    assert all(r.text == original[i] for i, r in texts.items() if i < 200 or i > 300)
    assert all(r.n_chars == len(r.text) for r in texts.values())
    for name in list(out)[:-1]:
        assert out[name].columns == df.columns
    assert ids["best_fit_packing"] == ids["substring_dedup"]


def test_empty_table(spark):
    out = stages(spark, spark.createDataFrame([], SCHEMA))
    assert all(d.collect() == [] for d in out.values())


def test_run_matches_brute_force(spark):
    """Every stage done again without Spark's operators, over all documents of the smallest scale."""
    import zlib

    import numpy as np
    import public_tokenizers
    import test_minhash_dedup
    import test_substring_dedup
    from tokenizers import Tokenizer

    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    docs = [(i, t) for i, t in docs if any(c.isalpha() for c in t or "")]
    last = {t: i for i, t in sorted(docs)}
    docs = [(i, t) for i, t in docs if last[t] == i]
    near = test_minhash_dedup.brute(docs, 80)
    docs = [(i, t) for i, t in docs if near[i][2]]
    texts = test_substring_dedup.brute(docs)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = set()
    for i, text in texts.items():
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [1], "<u4")
        for n, at in enumerate(range(0, len(ids), 4096)):
            piece = ids[at:at + 4096]
            want.add((i, n, at, len(piece), zlib.crc32(piece.tobytes())))
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = out.collect()
    assert {tuple(r)[:5] for r in rows} == want and len(rows) == len(want)
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 4096 and len(ends) <= -(-sum(r.length for r in rows) // 4096) + 1
