import random

import pytest

from hustings.llm.components import components, joined_components


def reach(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_random_graphs(spark, frame, seed):
    random.seed(seed)
    nodes = random.sample(range(10_000), 300)
    links = [(random.choice(nodes), random.choice(nodes)) for _ in range(220)]
    chain = [(20_000 + i, 20_001 + i) for i in range(40)]
    hub = [(30_500, 30_000 + i) for i in range(50)]
    links = [(a, b) for a, b in links + chain + hub if a != b]
    ddl = "a bigint, b bigint"
    got = {r.node: r.label for r in components(frame(links, ddl)).collect()}
    assert got == reach(links)
    half = len(links) // 2
    first = components(frame(links[:half], ddl))
    both = {r.node: r.label for r in joined_components(first, frame(links[half:], ddl)).collect()}
    assert both == reach(links)


def test_no_links(spark, frame):
    assert components(frame([], "a bigint, b bigint")).collect() == []
