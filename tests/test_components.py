"""Connected components: against union-find, and no rounds where none are needed."""

import random

from permaway.operators import components


def test_components_match_union_find(spark):
    rnd = random.Random(3)
    for pairs in ([(i, i + 1) for i in range(50)], [(rnd.randrange(300), rnd.randrange(300)) for _ in range(160)], [(0, i) for i in range(1, 40)], [(5, 5), (None, 3)], []):
        parent = {}

        def find(x, parent=parent):
            while parent.setdefault(x, x) != x:
                x = parent[x]
            return x

        for a, b in pairs:
            if a is not None and a != b:
                a, b = find(a), find(b)
                parent[max(a, b)] = min(a, b)
        out = components.connected_components(spark.createDataFrame(pairs, "src bigint, dst bigint")).collect()
        assert sorted((r.node, r.component) for r in out) == sorted((x, find(x)) for x in list(parent))


def test_stars_take_no_round(spark, monkeypatch):
    def star(*_):
        raise AssertionError("a round")

    monkeypatch.setattr(components, "_star", star)
    edges = spark.createDataFrame([(i, i % 10) for i in range(10, 100)], "src bigint, dst bigint")
    out = components.connected_components(edges).collect()
    assert sorted((r.node, r.component) for r in out) == [(i, i % 10) for i in range(100)]


def test_few_edges_are_solved_at_once_and_rounds_agree(spark, monkeypatch):
    rnd = random.Random(9)
    pairs = [(i, i + 1) for i in range(40)] + [(rnd.randrange(1000, 1300), rnd.randrange(1000, 1300)) for _ in range(170)] + [(1 << 60, -5), (None, 3), (7, 7)]
    edges = spark.createDataFrame(pairs, "src bigint, dst bigint")
    monkeypatch.setattr(components, "LOCAL", 0)
    rounds = sorted(map(tuple, components.connected_components(edges).collect()))

    def star(*_):
        raise AssertionError("a round")

    monkeypatch.undo()
    monkeypatch.setattr(components, "_star", star)
    assert sorted(map(tuple, components.connected_components(edges).collect())) == rounds
    # Ends that are no longs have rounds of their own.
    monkeypatch.undo()
    named = spark.createDataFrame([("b", "c"), ("c", "a"), ("a", "d")], "src string, dst string")
    assert {tuple(r) for r in components.connected_components(named).collect()} == {(x, "a") for x in "abcd"}
