from __future__ import annotations

import random

from quotalake.llm.components import connected_components


def test_components_of_paths_stars_and_noise(spark):
    rnd = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 200)]
    edges += [(rnd.randrange(2000, 2400), rnd.randrange(2000, 2400)) for _ in range(250)] + [(-5, -5), (-9, 3), (1001, 1000)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    df = spark.createDataFrame([*edges, (None, 4)], "a long, b long").repartition(5)
    got = {r.node: r.root for r in connected_components(df).collect()}
    assert got == {v: find(v) for v in parent if find(v) != v}
    assert connected_components(df.where("false")).count() == 0
