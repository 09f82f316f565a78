"""Components of random graphs, paths, stars and degenerate edges."""

import random

from ledgerspark.llm.components import connected_components


def brute(edges):
    nodes = {x for e in edges for x in e}
    comp = {x: x for x in nodes}
    for _ in nodes:
        for a, b in edges:
            comp[a] = comp[b] = min(comp[a], comp[b])
    return comp


def test_graphs(spark):
    rng = random.Random(4)
    path = [(i, i + 1) for i in range(40)]
    rng.shuffle(path)
    for edges in (path, [(0, i) for i in range(1, 50)] + [(60, 61)], [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(5, 5), (-7, 3), (3, -7)]):
        loose = [e for e in edges if e[0] != e[1]]
        got = {r.node: r.component for r in connected_components(spark.createDataFrame([*edges, (None, 3)], "a long, b long")).collect()}
        assert got == brute(loose)


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([(2, 2)], "a long, b long")).count() == 0
