import random

import pytest

from siftlane.operators.components import connected_components


def plain(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


@pytest.mark.parametrize("kind", ["random", "chain", "star", "loops", "empty"])
def test_components(spark, kind):
    rng = random.Random(7)
    edges = {
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(None, 3), (3, None)],
        "chain": [(i, i + 1) for i in range(120)] + [(500 - i, 501 - i) for i in range(60)],
        "star": [(0, i) for i in range(1, 300)] + [(i, 0) for i in range(1, 300)],
        "loops": [(1, 1), (2, 3), (3, 2), (2, 3)],
        "empty": [],
    }[kind]
    got = connected_components(spark.createDataFrame(edges, "src long, dst long"))
    assert dict(map(tuple, got.collect())) == plain(edges)
    assert got.count() == len(plain(edges))


def test_components_over_several_tasks(spark, monkeypatch):
    """The same with tasks of few edges, so that stars alternate over what they leave; names as nodes, too."""
    from siftlane.operators import components

    monkeypatch.setattr(components, "TASK_EDGES", 40)
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(1000, 1100)] + [(2000, 2000 + i) for i in range(100)] + [(5, 5)]
    rng.shuffle(edges)
    assert dict(map(tuple, connected_components(spark.createDataFrame(edges, "src long, dst long")).collect())) == plain(edges)
    named = [(f"n{a:05d}", f"n{b:05d}") for a, b in edges]
    assert dict(map(tuple, connected_components(spark.createDataFrame(named, "a string, b string"), "a", "b").collect())) == plain(named)
