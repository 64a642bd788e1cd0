import random

import numpy as np
import pytest

from pagelens.llm import groups


def plain(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


draw = random.Random(3)
GRAPHS = {
    "none": [],
    "loops only": [(4, 4), (4, 4)],
    "chain": [(i, i + 1) for i in draw.sample(range(-60, 60), 120)],
    "star": [(7, i) for i in range(8, 60)] + [(8, 7), (0, 59)],
    "random": [(draw.randrange(-(1 << 63), 1 << 63) // 10**17, draw.randrange(-90, 90)) for _ in range(150)],
    "classes": [(10 * c + draw.randrange(10), 10 * c + draw.randrange(10)) for c in range(-20, 20) for _ in range(6)],
}


@pytest.mark.parametrize("chunk", [5, 500_000])
@pytest.mark.parametrize("name", GRAPHS)
def test_components_are_those_of_a_plain_search(spark, monkeypatch, name, chunk):
    monkeypatch.setattr(groups, "CONTRACTED", chunk)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", min(chunk, 10_000))
    edges = spark.createDataFrame(GRAPHS[name], "a long, b long").repartition(3)
    got = [(r.node, r.component) for r in groups.components(edges).collect()]
    assert len(got) == len(dict(got))
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert dict(got) == plain(GRAPHS[name])


def test_few_edges_need_no_rounds(spark, monkeypatch):
    """One contraction of all: no shuffles round by round."""
    names = []
    written = groups.shared.written
    monkeypatch.setattr(groups.shared, "written", lambda df, name, *a, **b: names.append(name) or written(df, name, *a, **b))
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long").repartition(8)
    assert {r.component for r in groups.components(edges).collect()} == {0}
    assert names == ["components"]


def test_roots_are_those_of_a_plain_search():
    r = np.random.default_rng(1)
    for n, m in ((40, 30), (300, 290), (2000, 2100)):
        a, b = r.integers(0, n, m), r.integers(0, n, m)
        want = plain(list(zip(a.tolist(), b.tolist(), strict=True)))
        assert groups.roots(n, a, b).tolist() == [want.get(i, i) for i in range(n)]
