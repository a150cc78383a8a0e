import numpy as np
import pytest

from chartstreak.llm import embedding_dedup as op

SCHEMA = "vec_id long, embedding array<double>, label int"


def vectors(seed=3):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(20, 8))
    rows = []
    for i in range(900):
        v = base[rng.integers(20)] if rng.random() < 0.8 else rng.normal(size=8)
        v = v + rng.normal(size=8) * rng.choice([0, 0.05, 0.12, 0.25])
        rows.append((i, v.tolist(), int(rng.integers(2)) if rng.random() < 0.97 else None))
    return rows + [(2000, None, 1), (2001, [0.0] * 8, 1), (2002, [float("nan")] + [1.0] * 7, 1), (2003, [1.0, 2.0], 1),
                   (2004, [1.0, 2.0], 1), (2005, [], 1), (2006, [None] + [1.0] * 7, 1), (2007, [float("inf")] * 8, 0),
                   (2008, [1e300] * 8, 1), (2009, [2e300] * 8, 1)]


def brute(rows, threshold=0.93):
    near = {r[0]: set() for r in rows}
    usable = [(i, np.array(v, float), n) for i, v, n in rows
              if n is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    units = [(i, v / abs(v).max() / np.linalg.norm(v / abs(v).max()), n) for i, v, n in usable]
    for a, x, p in units:
        for b, y, q in units:
            if a != b and p == q and len(x) == len(y) and x @ y >= threshold:
                near[a].add(b)
    component = {}
    for i in sorted(near):
        todo = [] if i in component else [i]
        while todo:
            x = todo.pop()
            if x not in component:
                component[x] = i
                todo += near[x]
    return {i: (len(near[i]), component[i], component[i] == i) for i in near}


@pytest.mark.parametrize("sizes", [{}, {"cell_rows": 40, "block_rows": 32}, {"cell_rows": 100}])
def test_links_match_brute_force(spark, sizes):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as id", "2 as n", "3 as `left`", "4 as component")
    out = op.link_vectors(df, **sizes).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out} == brute(rows)


def test_copies_repeats_and_null_ids(spark):
    v = [1.0, 0.0, 0.5]
    rows = [(i, v, 1) for i in range(50)] + [(7, v, 1), (None, v, 1), (None, [0.0, 1.0, 0.0], 1)]
    out = op.link_vectors(spark.createDataFrame(rows, SCHEMA), block_rows=8).collect()
    assert len(out) == 53
    assert all(r.n_links == 51 and r.component_id == 0 for r in out if r.vec_id is not None)
    assert sorted((r.n_links, str(r.component_id)) for r in out if r.vec_id is None) == [(0, "None"), (51, "0")]


def test_vectors_without_an_id_are_not_one_vector(spark):
    rows = [(5, [1.0, 0.0, 0.0, 0.0], 1), (None, [1.0, 0.01, 0.0, 0.0], 1), (None, [0.0, 1.0, 0.0, 0.0], 1),
            (None, [0.0, 0.0, 1.0, 0.0], 1), (None, [0.0, 0.0, 1.0, 0.01], 1), (6, [0.0, 0.0, 0.0, 1.0], 1),
            (6, [0.0, -1.0, 0.0, 0.0], 1), (7, [0.0, -1.0, 0.01, 0.0], 1)]
    out = op.link_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in out) == [
        ("5", 1, "5", True), ("6", 0, "6", True), ("6", 1, "6", True), ("7", 1, "6", False),
        ("None", 0, "None", True), ("None", 1, "5", False), ("None", 1, "None", False), ("None", 1, "None", True)]


def test_empty_table(spark):
    assert op.link_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def test_every_link_meets_in_a_cell():
    rng = np.random.default_rng(9)
    x = op.unit_rows(list(rng.normal(size=(600, 6))))
    centres = op.spherical_kmeans(x, 12)
    home, guest = op.cells_of(x, centres, 0.8)
    a, b = np.nonzero(np.triu(x @ x.T >= 0.8, 1))
    assert ((home[a] == home[b]) | guest[a, home[b]] | guest[b, home[a]]).all()
