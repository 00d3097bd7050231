"""Connected components, and how much the driver has to plan and keep for them."""

import random
import uuid

from tidemark.llm.components import _forests, components


def plain(edges):
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {x: find(x) for x in root}


def graph(rng):
    path = list(range(-200, 200))
    rng.shuffle(path)
    edges = [*zip(path, path[1:])] + [(1000 + i, 2000) for i in range(300)]  # a long path; a star of its largest node
    edges += [(rng.randrange(3000, 3600), rng.randrange(3000, 3600)) for _ in range(400)]
    edges = [(a, b) for a, b in edges if a != b]
    rng.shuffle(edges)
    return edges + edges[:50] + [(b, a) for a, b in edges[:50]]


def test_components_of_many_parts(spark):
    edges = graph(random.Random(3))
    rows = components(spark.createDataFrame(edges, "a long, b long").repartition(16)).collect()
    assert len(rows) == len({r["node"] for r in rows})
    assert {r["node"]: r["root"] for r in rows} == plain(edges)


def test_forests_that_a_task_cannot_hold(spark):
    edges = graph(random.Random(4))
    out = [tuple(r) for r in _forests(spark.createDataFrame(edges, "a long, b long").repartition(3), nodes=10).collect()]
    assert plain(out) == plain(edges) and all(b < a for a, b in out)


def test_a_path_takes_the_driver_few_stages(spark):
    sc, group = spark.sparkContext, uuid.uuid4().hex
    path = list(range(400))
    random.Random(5).shuffle(path)
    edges = spark.createDataFrame([*zip(path, path[1:])], "a long, b long").repartition(8).localCheckpoint()
    sc.setJobGroup(group, "components")
    try:
        rows = components(edges).collect()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    jobs = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup(group)]
    assert {r["root"] for r in rows} == {0} and len(rows) == 400
    assert sum(len(j.stageIds) for j in jobs) <= 100
