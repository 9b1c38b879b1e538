import random

import pytest

from sigil.operators import graph


def union(nodes, edges):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in edges:
        a, b = root(i), root(j)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("seed", range(4))
def test_components(spark, seed):
    random.seed(seed)
    nodes = list(range(60))
    edges = [(random.randrange(60), random.randrange(60)) for _ in range(10 + 15 * seed)]
    if seed == 3:
        edges = [(i, i + 1) for i in range(39)]  # a chain
    df = spark.createDataFrame([(min(e), max(e)) for e in edges], "i long, j long")
    found = graph.components(df, spark.createDataFrame([(n,) for n in nodes], "node long"))
    want = union(nodes, edges)
    assert {r.node: r.comp for r in found.collect()} == want
    numbers = {c: k + 1 for k, c in enumerate(sorted(set(want.values())))}
    assert {r.node: r.group_id for r in graph.numbered_groups(found).collect()} == {n: numbers[c] for n, c in want.items()}


def linked(edges, k, m):
    near = {}
    for i, j, s, _ in edges:
        near.setdefault(i, []).append((-s, j))
        near.setdefault(j, []).append((-s, i))
    top = {n: [x for _, x in sorted(v)] for n, v in near.items()}
    out = {}
    for i, j, _, mono in edges:
        mk = j in top[i][:k] and i in top[j][:k]
        tri = (set(top[i][:m]) & set(top[j][:m])) - {i, j}
        rule = ("mono_mutual_knn" if mono else "mutual_knn") if mk else "triangle" if tri and not mono else None
        if rule:
            out[i, j] = rule
    return out


@pytest.mark.parametrize("seed", range(3))
def test_rules(spark, seed):
    random.seed(seed)
    pairs = random.sample([(i, j) for i in range(25) for j in range(i + 1, 25)], 120)
    edges = [(i, j, random.randrange(5) / 4, random.random() < 0.3) for i, j in pairs]
    df = spark.createDataFrame(edges, "i long, j long, rank_score double, mono boolean")
    assert {(r.i, r.j): r.rule for r in graph.linked(df, 2, 3).collect()} == linked(edges, 2, 3)


def test_group_reports(spark):
    groups = spark.createDataFrame([(1, "b", 1), (2, "a", 1), (3, "c", 2)], "node long, site string, group_id int")
    assert {r.group_id: r.members for r in graph.group_members(groups).collect()} == {1: ["a", "b"], 2: ["c"]}
    assert [tuple(r) for r in graph.group_sizes(groups).collect()] == [(1, 2), (2, 1)]
    links = spark.createDataFrame([(1, 2, "mutual_knn"), (2, 3, "triangle")], "i long, j long, rule string")
    assert graph.group_edges(links, groups, 1).count() == 1
