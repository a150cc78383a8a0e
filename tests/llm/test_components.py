import random

from chartstreak.llm.components import connected_components


def test_components_match_brute_force(spark):
    rng = random.Random(6)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    links += [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2400)] + [(5, 5), (7, 8), (8, 7)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for a, b in links:
        if a != b:
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    out = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in out} == {x: root(x) for x in list(up)}
    assert len(out) == len(up)


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
