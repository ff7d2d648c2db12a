import random

from dealreports.llm.graph import components


def test_components_of_a_random_graph_and_a_long_chain(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(1000 + i, 1001 + i) for i in range(60)]
    links += [(2000, 2000 + i) for i in range(1, 50)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len({r[0] for r in found}) == len(found)
    assert dict(map(tuple, found)) == {x: root(x) for a, b in links for x in (a, b) if a != b}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
