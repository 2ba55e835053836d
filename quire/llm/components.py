"""Connected components of a distributed edge list, by joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import discard, written

#: Edges of a task that are gathered before they are contracted.
EDGES = 1 << 20
#: Rows of a batch that goes back to the JVM.
OUT_ROWS = 1 << 13


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(v, m): each node of the edges (a, b) and the least one that these connect it to, if another."""
    nodes, number = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = number[:len(a)], number[len(a):]
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low < high
        if not apart.any():
            break
        np.minimum.at(root, high[apart], low[apart])
        while (root[root] != root).any():
            root = root[root]
    v = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[v], nodes[root[v]]


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What connects the nodes of a task's edges, in as few edges (v, m) as there are nodes."""
    v = m = np.empty(0, dtype=np.int64)
    more, total = [], 0

    def contracted():
        return forest(np.concatenate([v, *(x for x, _ in more)]), np.concatenate([m, *(y for _, y in more)]))

    for batch in batches:
        more.append(tuple(c.to_numpy() for c in batch.columns))
        total += batch.num_rows
        if total > max(EDGES, len(v)):
            v, m = contracted()
            more, total = [], 0
    v, m = contracted()
    for i in range(0, len(v), OUT_ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(v[i:i + OUT_ROWS]), pa.array(m[i:i + OUT_ROWS])], ["v", "m"])


def contracted(edges: DataFrame) -> DataFrame:
    """``edges`` (v, m), those of each task replaced by as few that connect the same nodes."""
    return edges.mapInArrow(_forests, "v long, m long")


def are_stars(edges: DataFrame) -> bool:
    """Whether every node of ``edges`` (v, m) either leads to one other node or is led to."""
    ends = edges.select(F.col("v").alias("node"), "m", F.lit(False).alias("centre"))
    centres = edges.select(F.col("m").alias("node"), F.lit(None).cast("long").alias("m"), F.lit(True).alias("centre"))
    return (ends.unionByName(centres).groupBy("node")
            .agg(F.min("m").alias("lo"), F.max("m").alias("hi"), F.max("centre").alias("centre"))
            .filter("lo < hi or lo is not null and centre").isEmpty())


def components(edges: DataFrame) -> DataFrame:
    """(node, component): each node of ``edges`` (a, b) and the least node it is connected to.

    Large stars and small stars in turn: every node links its greater neighbours, then its
    smaller ones and itself, to the least node it knows. Rounds grow with the logarithm of the
    nodes; they end when all edges lead to the least node. Before each round every task contracts the
    edges that it reads, which saves rounds. A hub's neighbours are aggregated before they are
    shuffled, and each round is a written table.
    """
    now = written(contracted(edges.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m"))), "edges")
    while not are_stars(now):
        few = written(contracted(now), "edges")
        discard(now)
        both = few.unionByName(few.select(F.col("m").alias("v"), F.col("v").alias("m")))
        least = both.groupBy("v").agg(F.min("m").alias("least")).withColumn("least", F.least("least", "v"))
        stars = both.filter("m > v").join(least, "v").select(F.col("m").alias("v"), F.col("least").alias("m"))
        least = stars.groupBy("v").agg(F.min("m").alias("least"))
        links = stars.join(least, "v").select("least", F.explode(F.array("v", "m")).alias("v"))
        now = written(links.filter("v > least").select("v", F.col("least").alias("m")), "stars")
        discard(few)
    now = now.distinct()
    roots = now.select(F.col("m").alias("node"), F.col("m").alias("component")).distinct()
    return now.select(F.col("v").alias("node"), F.col("m").alias("component")).unionByName(roots)
