import random

import pytest

from adstream.llm.components import components


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_random_links(spark, seed):
    draw = random.Random(seed)
    links = [(draw.randrange(60), draw.randrange(60)) for _ in range(45)]
    links += [(k, k + 1) for k in range(100, 112)] + [(5, None), (200, 200), (7, 7)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if None not in (a, b) and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    made = components(spark.createDataFrame(links, "a long, b long"))
    assert sorted(tuple(r) for r in made.collect()) == sorted((x, find(x)) for x in root)


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
