import random

from reviewlake.operators.graph import connected_components


def brute(pairs):
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_components_match_union_find(spark):
    r = random.Random(3)
    pairs = [(a, b) for a, b in ((r.randrange(120), r.randrange(120)) for _ in range(90)) if a != b]
    pairs += [(200 + i, 201 + i) for i in range(30)]
    got = {x.node: x.component for x in connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == brute(pairs)


def test_empty_and_self_loops(spark):
    assert connected_components(spark.createDataFrame([(1, 1), (None, 2)], "u long, v long")).count() == 0
