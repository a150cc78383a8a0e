"""Exact top-k search against brute force in whole numbers."""

import math
import random

import numpy as np

from chartstreak.llm import topk_search as tk

SCHEMA = "vec_id long, embedding array<double>, label int"


def expected(data, k=20, every=20):
    rows = []
    for vec, e, *_ in data:
        if e is not None and all(x is not None and math.isfinite(x) for x in e):
            rows.append((vec, [max(tk.LOWEST, min(tk.HIGHEST, math.floor(64 * x))) for x in e]))
    out = []
    for n, (query, q) in enumerate(rows):
        if query is None or query % every:
            continue
        scored = [(-max(tk.LOWEST, min(tk.HIGHEST, sum(a * b for a, b in zip(q, x)))), vec is None, vec or 0)
                  for m, (vec, x) in enumerate(rows) if m != n and len(x) == len(q)]
        out += [(query, r, None if none else vec, -score)
                for r, (score, none, vec) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def result(spark, data, schema=SCHEMA, **how):
    return sorted((tuple(r) for r in tk.top_k(spark.createDataFrame(data, schema), **how).collect()), key=repr)


def clustered(rng, n, dim=8):
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(12)]
    return [(i, [x + rng.gauss(0, 0.1) for x in rng.choice(centres)], 0) for i in range(n)]


def test_equals_brute_force_with_copies_and_ties(spark):
    rng = random.Random(11)
    data = clustered(rng, 700)
    copies = [(1000 + i, data[5][1], 1) for i in range(350)]      # a third of all rows, all of equal score
    coarse = [(2000 + i, [float(rng.randint(0, 1)) for _ in range(8)], 2) for i in range(150)]
    data += copies + coarse
    rng.shuffle(data)
    for how in ({"shard_rows": 64, "leaf_rows": 8, "block_rows": 16}, {}):
        assert result(spark, data, **how) == expected(data), how


def test_nulls_lengths_repeats_and_large_numbers(spark):
    rng = random.Random(4)
    data = clustered(rng, 80, 3)
    data += [(None, [0.5, 0.5, 0.5], 0), (None, [9.0, 9.0, 9.0], 0), (40, data[3][1], 0), (40, data[40][1], 0)]
    data += [(100, None, 0), (120, [1.0, None, 2.0], 0), (140, [float("nan")] * 3, 0), (160, [float("inf"), 0.0, 0.0], 0)]
    data += [(180, [1.0, 2.0], 0), (200, [], 0), (220, [], None), (300, [1e30, -1e30, 1.0], 0), (301, [1e12, 1.0, 2.0], 0),
             (320, [5.0], 0)]
    for how in ({"shard_rows": 16, "leaf_rows": 4, "block_rows": 4}, {}):
        assert result(spark, data, **how) == expected(data), how


def test_empty_small_and_extra_columns(spark):
    assert result(spark, []) == []
    assert result(spark, [(1, [1.0], 0)]) == []
    data = [(i, [float(i), 1.0], 0, "x", i, b"z", 5) for i in range(30)]
    extra = SCHEMA + ", id string, `row` int, x binary, kth int"
    assert result(spark, data, extra, k=3) == expected(data, k=3)
    assert len(result(spark, data[:3], extra)) == 2    # fewer candidates than k


def test_subtrees_are_left_out(spark):
    """Clustered rows: most leaves are never scored, and results are those of all leaves."""
    rng = np.random.default_rng(5)
    x = np.floor(64 * (rng.normal(0, 1, (16, 8)).repeat(256, 0) + rng.normal(0, .05, (4096, 8)))).astype(np.int64)
    ids = np.arange(4096)
    leaves = tk._leaves(32)((8, 0, 0), __import__("pandas").DataFrame({
        "x": [tk.packed(r) for r in x], "id": ids, "row": ids, "nameless": False}))
    tree, q = tk.Tree(leaves, 8), x[::100]
    scores = q @ x.T
    scores[np.arange(len(q)), ids[::100]] = tk.LOWEST
    kth = np.sort(scores, axis=1)[:, -20]
    _, alive = tree.promising(q, kth, np.zeros(len(q), np.int64))
    assert alive.mean() < 0.3
    start = np.full(len(q), tk.LOWEST), np.full(len(q), tk.HIGHEST)
    got, got_ids, _, _ = tree.search(q, ids[::100], 20, *start)
    want = np.lexsort((np.broadcast_to(ids, scores.shape), ~scores), axis=1)[:, :20]
    assert (got_ids == want).all() and (got == np.take_along_axis(scores, want, 1)).all()
