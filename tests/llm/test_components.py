import random

from recordgate.llm import components


def _truth(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(parent)}


def test_components_join_an_edge_only_while_it_is_needed(spark, monkeypatch):
    draw = random.Random(3)
    # a group with many links between its members, stars around their greatest node, a chain in no order, and pairs at random
    group = [(a, b) for a in range(40) for b in range(a)]
    star = [(1000 + i, 1999) for i in range(60)]
    order = draw.sample(range(3000, 4000), 120)
    edges = [*group, *star, *zip(order, order[1:]), *((draw.randrange(-9000, -8900), draw.randrange(-9000, -8900)) for _ in range(80))]
    edges = [(a, b) for a, b in edges if a != b]
    kept, write = [], components.materialise

    def counted(df):
        out = write(df)
        if df.columns == ["src", "dst"]:
            kept.append(out.count())
        return out

    monkeypatch.setattr(components, "materialise", counted)
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == _truth(edges)
    # what the rounds join: each edge once, and of later rounds only what still lies between different roots
    assert kept[0] == len({(min(e), max(e)) for e in edges}) and sum(kept) < 1.2 * len(edges) and kept[-1] == 0


def test_components_of_no_edges(spark):
    assert components.connected_components(spark.createDataFrame([(1, 1)], "src long, dst long")).count() == 0
