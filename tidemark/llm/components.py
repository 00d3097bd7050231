"""Connected components of a graph given as edges."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved

NODES = 1 << 18  # that a task holds at a time
EDGES = 1 << 16  # that a task is dealt; fewer only if there would be under TASKS tasks
TASKS = 4


def _forests(edges: DataFrame, nodes: int = NODES) -> DataFrame:
    """Edges ``(a, b)`` with the same components: every task hangs its nodes below the least they reach over its own edges.

    A forest of as many nodes as a task may hold is given out, and the next one begins.
    """
    def hung(batches):
        up: dict[int, int] = {}

        def top(node):
            while up[node] != node:
                up[node] = up[up[node]]
                node = up[node]
            return node

        def given():
            below = [(node, root) for node in up if (root := top(node)) != node]
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in below], pa.int64()) for i in (0, 1)], ["a", "b"])

        for batch in batches:
            for a, b in zip(*(batch.column(c).to_pylist() for c in ("a", "b"))):
                up.setdefault(a, a)
                up.setdefault(b, b)
                one, two = top(a), top(b)
                up[max(one, two)] = min(one, two)
            if len(up) >= nodes:
                yield given()
                up.clear()
        yield given()

    return edges.select("a", "b").mapInArrow(hung, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(a, b)``, ``root`` the least node it can reach.

    Large and small stars in turn: nodes hang themselves below the least neighbour until all are stars,
    in rounds logarithmic in the number of nodes. Each round is two grouped minima and two joins. Before
    each, tasks make forests of their own edges, so few rounds are left to do.
    """
    edges = saved(_forests(edges.where("a <> b")), "edges")
    parts = max(TASKS, -(-edges.count() // EDGES))
    edges = saved(_forests(edges.coalesce(parts)), "edges")
    while True:
        # Edges lead to the lesser node: ``m`` is the least neighbour, or the node itself if it is less than all.
        ends = edges.unionByName(edges.select(F.col("b").alias("a"), "b"))
        least = ends.groupBy("a").agg(F.min("b").alias("m"), F.max("b").alias("most"))
        if least.where("m <> most").isEmpty():
            return least.select(F.col("a").alias("node"), F.col("m").alias("root"))
        # Dealt out once, and with the filters that both uses need: the second one reads the first one's shuffle.
        large = edges.join(least.select(F.col("a").alias("b"), "m"), "b").select("a", F.col("m").alias("b")).where(
            "a IS NOT NULL AND b IS NOT NULL").repartition("a")
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # A round makes no more edges than there were, so as many tasks do.
        edges = saved(_forests(small.unionByName(lower.select("a", F.col("m").alias("b"))).coalesce(parts)), "edges")
