import random

from skylake.llm.graph import components


def brute(edges):
    label = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for u, v in edges:
            least = min(label[u], label[v])
            for x in (u, v):
                if label[x] != least:
                    label[x], changed = least, True
    return label


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(300, 420)] + [(1, 1), (2, 1), (1, 2)]
    edges += [(rng.randrange(1000, 1300), rng.randrange(1000, 1300)) for _ in range(160)]
    frame = spark.createDataFrame([*edges, (None, 3), (4, None)], "u bigint, v bigint")
    got = {r.node: r.component for r in components(frame).collect()}
    assert got == brute([e for e in edges if e[0] != e[1]])


def test_nothing(spark):
    assert components(spark.createDataFrame([], "u string, v string")).count() == 0
