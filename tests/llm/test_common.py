from __future__ import annotations

import random

from feedloom.llm.common import connected_components, numbered, sized_join
from feedloom.workspace import settle


def brute_components(edges):
    leader = {}

    def find(node):
        while leader.setdefault(node, node) != node:
            node = leader[node]
        return node

    for a, b in edges:
        one, two = find(a), find(b)
        leader[max(one, two)] = min(one, two)
    return {node: find(node) for node in leader}


def test_components_of_random_graphs_chains_and_stars(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(220)]
    edges += [(n, n + 1) for n in range(1000, 1300)] + [(2000, n) for n in range(2001, 2300)] + [(-5, 1000)]
    edges = [edge for edge in edges if edge[0] != edge[1]]
    rng.shuffle(edges)
    found = connected_components(spark.createDataFrame(edges + edges[:50], "a bigint, b bigint")).collect()
    assert {row["node"]: row["component"] for row in found} == brute_components(edges)
    assert len(found) == len({row["node"] for row in found})


def test_no_edges_no_components(spark):
    assert connected_components(spark.createDataFrame([(1, 1)], "a bigint, b bigint")).collect() == []


def test_numbers_are_gapless_in_every_group(spark):
    rows = [(n % 3 if n % 2 else 0, n) for n in range(5000)] + [(1, 7)] * 20 + [(2, None)] * 5
    table = settle(spark.createDataFrame(rows, "g int, n bigint"), "rows")
    found = numbered(table, ["g"], ["n"], rows=100).collect()
    assert len(found) == len(rows)
    for group in range(3):
        slots = sorted(row["slot"] for row in found if row["g"] == group)
        assert slots == list(range(len(slots)))


def test_sized_join_takes_either_way(spark):
    rows = spark.range(100).withColumnRenamed("id", "k")
    lookup = settle(spark.range(0, 100, 3).withColumnRenamed("id", "k"), "lookup")
    for limit in (0, 1 << 20):
        assert sized_join(rows, lookup, "k", "left_semi", limit).count() == 34
