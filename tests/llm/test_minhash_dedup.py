import random
import re
from collections import defaultdict

import numpy as np
import pytest

from chartstreak.llm import minhash_dedup as op

SCHEMA = "doc_id long, text string, id int, bands string, kept_id int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def corpus(seed=1, groups=12, hot=150):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    rows = []
    for g in range(groups):
        base = [word() for _ in range(rng.choice([6, 30, 200, 800]))]
        for _ in range(hot if g == 0 else rng.choice([1, 2, 5])):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(text) // rng.choice([15, 40, 80])))):
                text[rng.randrange(len(text))] = word()
            rows.append(rng.choice([" ", "\n", " \t"]).join(text))
    rows += ["", None, "  \n", "one", "One", "one two three", "ONE two\tthree", "Ä b", "ä b", "a\xa0b", "word " * 30_000]
    rows += ["x y z w v u " * 3] * 40
    return [(i * 3, t, 1, "b", 2) for i, t in enumerate(rows)]


def brute(rows, percent):
    sets = {}
    for i, text, *_ in rows:
        words = WORD.findall((text or "").translate(LOWER))
        n = min(5, len(words))
        sets[i] = {tuple(words[k:k + n]) for k in range(len(words) - n + 1)} if words else set()
    near = defaultdict(set)
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    near[a].add(b)
                    near[b].add(a)
    component = {}
    for i in sorted(sets):
        todo = [] if i in component else [i]
        while todo:
            x = todo.pop()
            if x not in component:
                component[x] = i
                todo += near[x]
    return {i: (len(sets[i]), component[i], component[i] == i) for i in sets}


@pytest.mark.parametrize("percent,block", [(85, 512), (80, 16)])
def test_components_match_brute_force(spark, monkeypatch, percent, block):
    monkeypatch.setattr(op, "BLOCK", block)
    rows = corpus()
    out = op.near_duplicates(spark.createDataFrame(rows, SCHEMA), percent=percent).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out}
    assert got == brute(rows, percent) and len(out) == len(rows)


def test_one_of_each_group_stays_with_its_columns(spark):
    rows = corpus(7, groups=5, hot=10)
    df = spark.createDataFrame(rows, SCHEMA)
    out = op.drop_near_duplicates(df, percent=85)
    want = {i for i, (_, _, kept) in brute(rows, 85).items() if kept}
    assert out.columns == df.columns and {r.doc_id for r in out.collect()} == want


def test_null_ids_and_repeated_rows(spark):
    text = "a b c d e f g h"
    rows = [(None, text, 1, "", 1), (4, text, 1, "", 1), (4, text, 1, "", 1), (None, "alone", 1, "", 1)]
    out = op.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in out) == [
        ("4", "4", True), ("4", "4", True), ("None", "4", False), ("None", "None", True)]


def test_documents_without_an_id_are_not_one_document(spark):
    rng = random.Random(4)
    text = lambda: " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(60))
    near, hidden, reused, alone = text(), text(), text(), [text() for _ in range(20)]
    # a null-id near copy of 5, near copies and copies without any id, unrelated ones, and an id used for two texts
    rows = [(5, near), (None, near + " more"), (None, hidden), (None, hidden + " more"), (None, hidden)]
    rows += [(None, t) for t in alone] + [(7, reused), (7, alone[0] + " more"), (8, reused + " more"), (None, None)]
    df = spark.createDataFrame([(i, t, 1, "", 1) for i, t in rows], SCHEMA)
    out = op.near_duplicates(df).collect()
    assert len(out) == len(rows)
    by = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in out)
    assert by == sorted([("5", "5", True), ("None", "5", False), ("None", "None", False), ("None", "None", False),
                         ("None", "None", True), ("7", "7", True), ("7", "7", True), ("8", "7", False),
                         ("None", "7", False)] + [("None", "None", True)] * 20)
    left = [(r.doc_id, r.text) for r in op.drop_near_duplicates(df, percent=85).collect()]
    hidden_left = [t for i, t in left if t and t.startswith(hidden)]
    assert len(hidden_left) == 1
    want = [(5, near), (7, reused), (7, alone[0] + " more"), (None, None)] + [(None, t) for t in alone[1:]]
    assert sorted(map(str, left)) == sorted(map(str, want + [(None, hidden_left[0])]))


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert op.near_duplicates(df).collect() == [] and op.drop_near_duplicates(df).collect() == []


def test_odd_sketches_estimate_similarity():
    rng = np.random.default_rng(5)
    for similarity in (0.8, 0.9, 0.97):
        found = []
        for _ in range(60):
            common = rng.integers(0, 1 << 63, int(1000 * similarity), dtype=np.uint64)
            rest = rng.integers(0, 1 << 63, (2, (1000 - len(common)) // 2), dtype=np.uint64)
            a, b = (np.frombuffer(op.odd_sketch(op.minhash(np.concatenate([common, r]))), np.uint64)[None] for r in rest)
            found.append(op.estimate(op.differing(a, b))[0, 0])
        assert abs(np.mean(found) - similarity) < 0.03 and min(found) > op.ADMIT
