"""Connected components of an undirected graph given as links.

Nodes take the smallest neighbour as parent, chains of parents are followed to
their ends, and links are redrawn between the ends, until the graph is small
enough for one task or has no links. A node with very many links is one row of
a pre-aggregated minimum, and a skewed join's partition, which adaptive
execution splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, materialize

#: Up to so many links (16 bytes each) one task finds the components.
ONE_TASK_LINKS = 500_000


def union_find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node and component of the links (a, b) of one task; a component is named by its smallest node."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[p]
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    for at in range(0, len(nodes), 50_000):
        part = nodes[at : at + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([root(x) for x in part], pa.int64())], ["node", "component"])


def _contract(links: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """The end that each node's chain of smallest neighbours leads to, and the links between ends."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    parents = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("parent")), "parents", 2 * n)
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        joined = parents.join(up, "parent").select("node", F.col("above").alias("parent"), (F.col("above") < F.col("parent")).alias("moved"))
        parents = materialize(joined, "parents", 2 * n)
        if not parents.where("moved").limit(1).count():
            break
        parents = parents.drop("moved")
    parents = parents.select("node", "parent")
    of = lambda name: parents.select(F.col("node").alias(name), F.col("parent").alias(f"{name}_end"))
    ends = links.join(of("a"), "a").join(of("b"), "b").where("a_end <> b_end")
    redrawn = ends.select(F.least("a_end", "b_end").alias("a"), F.greatest("a_end", "b_end").alias("b")).distinct()
    return parents, materialize(redrawn, "links", n)


def components(links: DataFrame, one_task_links: int = ONE_TASK_LINKS) -> DataFrame:
    """node and component (its smallest node) of each node of the materialized links (a, b), which are longs."""
    arrow_rows(links.sparkSession, 10_000)
    levels = []
    while (n := links.count()) > one_task_links:
        parents, links = _contract(links, n)
        levels.append(parents)
    labels = None
    if n:
        labels = materialize(links.select("a", "b").repartition(1).mapInArrow(union_find, "node long, component long"), "components")  # one file
    for parents in reversed(levels):
        if labels is None:
            labels = parents.select("node", F.col("parent").alias("component"))
        else:
            above = labels.select(F.col("node").alias("parent"), "component")
            labels = parents.join(above, "parent", "left").select("node", F.coalesce("component", "parent").alias("component"))
    if labels is None:
        return links.sparkSession.createDataFrame([], "node long, component long")
    return materialize(labels, "components") if levels else labels
