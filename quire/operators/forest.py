"""Random forest by level-wise histograms.

Features become quantile bins once. Each level of all trees is one job: a task sends the rows of its
partition down the trees grown so far and adds up weights by (tree, node, feature, bin, class); only
these sums are shuffled, never a document with its vector. Gini scores are running integer sums over
a feature's bins (windows by node and feature), and the best split of each node is an aggregate.

* Bins: a feature's range is cut into ``CELLS`` equal cells; cell counts, summed up in order, give
  the cells at which a new quantile begins. All of it is integers, so any engine gets the same bins.
* Bootstrap: a row's weight in a tree is a Poisson(1) count read off a hash of seed, tree and key.
  The same rows weigh the same whatever the files, partitions and cores.
* A node tries ``ceil(sqrt(features))`` features, those with the least hashes of seed, tree, node and
  feature. Equal scores go to the lower feature, then the lower bin.
* A leaf gives each class its share of the leaf's weight, in units of 2^-32; a document gets the
  class with the largest sum, of equal ones the most frequent.

The model, one row for each split and each (leaf, class), is held by the driver, as in any forest
estimator; its size is bounded by trees, depth and classes, not by the documents.

Edge cases: rows without a vector do not train and are predicted like a vector of least values; a
null or NaN entry counts as the feature's least value; a missing label is ``""``, a class of its own;
without training rows there is no model (an error); a tree whose bootstrap is empty has no vote.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.labels import label_text

#: Equal cells of a feature's range, from which quantiles are read.
CELLS = 1024
BINS = 32
#: A split must beat its node by so much (in units of weight).
MIN_GAIN = 1e-9
#: Poisson(1): a hash of 16 bits below the i-th bound counts i times.
POISSON = tuple(round(65536 * s) for s in np.cumsum(np.exp(-1) / np.cumprod([1.0, 1, 2, 3, 4, 5, 6])))
VOTE = 1 << 32
#: Sums that a task holds before it hands them on.
HELD = 1 << 21


@dataclass
class Tree:
    """Splits by ascending node: feature, and the last bin that goes left (to node 2i, else 2i + 1)."""

    node: list[int] = field(default_factory=list)
    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    #: leaf -> votes by class
    leaves: dict[int, np.ndarray] = field(default_factory=dict)


@dataclass
class Forest:
    labels: list[str]
    low: np.ndarray
    high: np.ndarray
    edges: list[np.ndarray]
    trees: list[Tree]
    depth: int


def bootstrap_weights(key: Column, trees: int, seed: int) -> Column:
    """The weight of a row in each tree."""
    def weight(t: Column) -> Column:
        digest = F.md5(F.concat(F.lit(f"{seed}:"), t.cast("string"), F.lit(":"), key.cast("string")))
        u = F.conv(F.substring(digest, 1, 4), 16, 10).cast("int")
        return sum((F.when(u >= b, 1).otherwise(0) for b in POISSON), F.lit(0))

    return F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), weight)


def tried_features(tree: int, node: int, features: int, seed: int) -> list[int]:
    names = sorted((hashlib.md5(f"{seed}:{tree}:{node}:{f}".encode()).hexdigest(), f) for f in range(features))
    return sorted(f for _, f in names[:ceil(sqrt(features))])


def _cells(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    x = np.where(np.isnan(x), low, np.clip(x, low, high))
    span = np.where(high > low, high - low, 1.0)
    return np.clip(np.floor((x - low) * CELLS / span), 0, CELLS - 1).astype(np.int32)


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    rows = [v if v is not None and len(v) == width else [None] * width for v in column.to_pylist()]
    return np.array(rows, dtype=float).reshape(-1, width)


def _binned(x: np.ndarray, low, high, edges) -> np.ndarray:
    cells = _cells(x, low, high)
    out = np.empty(cells.shape, dtype=np.uint8)
    for f, e in enumerate(edges):
        out[:, f] = np.searchsorted(e, cells[:, f], side="right")
    return out


def quantile_edges(rows: DataFrame, features: str, bins: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Least and largest value of each feature, and the cells at which its bins from the second on
    begin: at most ``bins - 1`` numbers a feature."""
    long = rows.select(F.posexplode(features).alias("f", "x")).withColumn("x", F.nanvl(F.col("x").cast("double"), F.lit(None)))
    stats = {r.f: r for r in long.groupBy("f").agg(F.min("x").alias("low"), F.max("x").alias("high"), F.count("*").alias("n")).collect()}
    width = len(stats)
    bound = lambda name: np.array([getattr(stats[f], name) or 0.0 for f in range(width)])
    low, high = bound("low"), bound("high")
    n = max((r.n for r in stats.values()), default=0)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((width, CELLS), dtype=np.int64)
        for batch in batches:
            c = _cells(_vectors(batch.column(0), width), low, high)
            for f in range(width):
                count[f] += np.bincount(c[:, f], minlength=CELLS)
        f, cell = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(f.astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(count[f, cell])],
                                         ["f", "cell", "n"])

    counts = rows.select(features).mapInArrow(cells, "f int, cell int, n long").groupBy("f", "cell").agg(F.sum("n").alias("n"))
    before = F.sum("n").over(Window.partitionBy("f").orderBy("cell")) - F.col("n")
    quantile = counts.select("f", "cell", F.floor(before * bins / F.lit(n)).alias("q")).filter("q > 0")
    found = quantile.groupBy("f", "q").agg(F.min("cell").alias("cell")).collect()
    edges = [np.array(sorted(r.cell for r in found if r.f == f), dtype=np.int32) for f in range(width)]
    return low, high, edges


def _route(bins: np.ndarray, tree: Tree, depth: int) -> np.ndarray:
    """The node that each row reaches."""
    at = np.ones(len(bins), dtype=np.int64)
    if not tree.node:
        return at
    node, feature, last = np.array(tree.node), np.array(tree.feature), np.array(tree.bin)
    for _ in range(depth):
        i = np.minimum(np.searchsorted(node, at), len(node) - 1)
        inner = np.flatnonzero(node[i] == at)
        if not len(inner):
            break
        i = i[inner]
        at[inner] = 2 * at[inner] + (bins[inner, feature[i]] > last[i])
    return at


def _rows(batch: pa.RecordBatch, width: int, trees: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bins = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=np.uint8).reshape(-1, width)
    weights = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, trees)
    return bins, weights, batch.column(2).to_numpy(zero_copy_only=False)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, weights = (np.concatenate(x) for x in zip(*parts, strict=True))
    codes, number = np.unique(codes, return_inverse=True)
    return codes, np.bincount(number, weights, minlength=len(codes)).astype(np.int64)


def _sums(forest: Forest, frontier: list[tuple[int, int]], tried: np.ndarray | None, bins: int) -> Callable:
    """Weights by (frontier node, tried feature, bin, class); without ``tried`` by leaf and class."""
    width, classes, n_trees = len(forest.edges), len(forest.labels), len(forest.trees)
    nodes = [np.array([n for t, n in frontier if t == tree], dtype=np.int64) for tree in range(n_trees)]
    first = np.cumsum([0, *(len(x) for x in nodes)])
    trees, depth = forest.trees, forest.depth

    def emitted(parts) -> Iterator[pa.RecordBatch]:
        codes, weights = _summed(parts)
        for at in range(0, len(codes), 1 << 16):
            c = codes[at:at + (1 << 16)]
            cols = [c // classes // bins // max(1, 0 if tried is None else tried.shape[1])]
            if tried is not None:
                j = c // classes // bins % tried.shape[1]
                cols += [tried[cols[0], j], c // classes % bins]
            cols = [pa.array(x.astype(np.int32)) for x in (*cols, c % classes)]
            names = ["i", "f", "bin", "k"] if tried is not None else ["i", "k"]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(weights[at:at + (1 << 16)])], [*names, "w"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            x, weights, k = _rows(batch, width, n_trees)
            for t, tree in enumerate(trees):
                rows = np.flatnonzero(weights[:, t])
                if not len(rows) or not len(nodes[t]):
                    continue
                at = _route(x[rows], tree, depth)
                i = np.minimum(np.searchsorted(nodes[t], at), len(nodes[t]) - 1)
                here = nodes[t][i] == at
                rows, i = rows[here], i[here] + first[t]
                if tried is None:
                    code = (i * bins * classes + k[rows])[:, None]
                else:
                    cell = (i[:, None] * tried.shape[1] + np.arange(tried.shape[1])) * bins + x[rows[:, None], tried[i]]
                    code = cell * classes + k[rows][:, None]
                parts.append((code.ravel(), np.repeat(weights[rows, t], code.shape[1]).astype(float)))
                held += code.size
                if held > HELD:
                    parts = [_summed(parts)]
                    held = len(parts[0][0])
                    if held > HELD // 2:
                        yield from emitted(parts)
                        parts, held = [], 0
        if parts:
            yield from emitted(parts)

    return run


def best_splits(sums: DataFrame) -> DataFrame:
    """(i, f, bin) of each node's best split from (i, f, bin, k, w): the largest sum over both sides
    of squared class weights over weight. Squares are kept as running sums of their changes."""
    along = Window.partitionBy("i", "f", "k").orderBy("bin")
    whole = Window.partitionBy("i", "f", "k")
    left, total = F.sum("w").over(along), F.sum("w").over(whole)
    change = sums.select("i", "f", "bin", "w", left.alias("l"), total.alias("t"))
    before = F.col("l") - F.col("w")
    steps = change.groupBy("i", "f", "bin").agg(
        F.sum("w").alias("w"), F.sum(F.col("l") * F.col("l") - before * before).alias("dl"),
        F.sum((F.col("t") - F.col("l")) * (F.col("t") - F.col("l")) - (F.col("t") - before) * (F.col("t") - before)).alias("dr"))
    along, whole = Window.partitionBy("i", "f").orderBy("bin"), Window.partitionBy("i", "f")
    # the right side's squares fall to 0 over all bins, so their whole fall is the node's own sum
    run = steps.select("i", "f", "bin", F.sum("w").over(along).alias("l"), F.sum("w").over(whole).alias("t"),
                       F.sum("dl").over(along).alias("sl"), (F.sum("dr").over(along) - F.sum("dr").over(whole)).alias("sr"),
                       (-F.sum("dr").over(whole)).alias("st")).filter("l < t")
    d = lambda c: F.col(c).cast("double")
    scored = run.select("i", "f", "bin", (d("sl") / d("l") + d("sr") / (d("t") - d("l"))).alias("score"), (d("st") / d("t")).alias("own"))
    best = F.min(F.struct((-F.col("score")).alias("s"), "f", "bin")).alias("best")
    return scored.filter(F.col("score") > F.col("own") + MIN_GAIN).groupBy("i").agg(best).select("i", "best.f", "best.bin")


def forest_fit(rows: DataFrame, key: str, features: str, label: str, trees: int = 20, depth: int = 30, bins: int = BINS,
               seed: int = 1234, labels: list[str] | None = None) -> Forest:
    """A forest on ``rows``; ``labels``, most frequent first, are those of the rows unless given."""
    rows = rows.filter(F.col(features).isNotNull())
    if labels is None:
        labels = ordered_labels(rows, label)
    low, high, edges = quantile_edges(rows, features, bins)
    if not len(low):
        raise ValueError("no training rows")
    forest = Forest(labels, low, high, edges, [Tree() for _ in range(trees)], depth)
    width = len(edges)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {x: i for i, x in enumerate(labels)}
        for batch in batches:
            b = _binned(_vectors(batch.column(0), width), low, high, edges)
            k = pa.array([number[x] for x in batch.column(2).to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in b], pa.binary()), batch.column(1), k], ["bins", "weights", "k"])

    known = rows.select(features, bootstrap_weights(F.col(key), trees, seed).alias("weights"), label_text(label).alias("label"))
    known = known.filter(F.col("label").isin(labels))
    # a byte a feature: small enough to keep for one pass a level; lost parts are computed again
    table = known.mapInArrow(encode, "bins binary, weights array<int>, k int").persist()
    try:
        frontier = [(t, 1) for t in range(trees)]
        for _ in range(depth):
            tried = np.array([tried_features(t, n, width, seed) for t, n in frontier])
            # tasks have added up their rows already; dealt by node and feature once, for all steps of best_splits
            sums = table.mapInArrow(_sums(forest, frontier, tried, bins), "i int, f int, bin int, k int, w long")
            sums = sums.repartition("i", "f").groupBy("i", "f", "bin", "k").agg(F.sum("w").alias("w"))
            splits = sorted((frontier[r.i], r.f, r.bin) for r in best_splits(sums).collect())
            if not splits:
                break
            for (t, n), f, b in splits:
                tree = forest.trees[t]
                at = int(np.searchsorted(tree.node, n))
                tree.node.insert(at, n)
                tree.feature.insert(at, f)
                tree.bin.insert(at, b)
            frontier = sorted((t, child) for (t, n), _, _ in splits for child in (2 * n, 2 * n + 1))
        leaves = [(t, n) for t, tree in enumerate(forest.trees)
                  for n in sorted({1, *(c for n in tree.node for c in (2 * n, 2 * n + 1))} - set(tree.node))]
        counts = table.mapInArrow(_sums(forest, leaves, None, bins), "i int, k int, w long")
        for r in counts.groupBy("i", "k").agg(F.sum("w").alias("w")).collect():
            t, n = leaves[r.i]
            forest.trees[t].leaves.setdefault(n, np.zeros(len(labels), dtype=np.int64))[r.k] = r.w
    finally:
        table.unpersist()
    for tree in forest.trees:
        for n, w in tree.leaves.items():
            tree.leaves[n] = w * VOTE // w.sum()
    return forest


def ordered_labels(rows: DataFrame, label: str) -> list[str]:
    """The classes, most frequent first: a model's output, one row a class."""
    counts = rows.groupBy(label_text(label).alias("label")).agg(F.count("*").alias("n"))
    return [r.label for r in sorted(counts.collect(), key=lambda r: (-r.n, r.label.encode()))]


def forest_predict(rows: DataFrame, forest: Forest, features: str, columns: list[str]) -> DataFrame:
    """``columns``, ``predicted`` and ``share``, the predicted class's part of the votes; one pass, no shuffle."""
    kept = rows.select(*columns, features)
    names = [*columns, "predicted", "share"]
    width = len(forest.edges)
    tables = []
    for tree in forest.trees:
        leaf = np.array(sorted(tree.leaves), dtype=np.int64)
        tables.append((leaf, np.array([tree.leaves[n] for n in leaf.tolist()], dtype=np.int64).reshape(len(leaf), -1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _binned(_vectors(batch.column(batch.num_columns - 1), width), forest.low, forest.high, forest.edges)
            votes = np.zeros((len(x), len(forest.labels)), dtype=np.int64)
            for tree, (leaf, share) in zip(forest.trees, tables, strict=True):
                if len(leaf):
                    at = _route(x, tree, forest.depth)
                    i = np.minimum(np.searchsorted(leaf, at), len(leaf) - 1)
                    votes += np.where((leaf[i] == at)[:, None], share[i], 0)
            best = votes.argmax(1) if len(x) else np.zeros(0, dtype=int)
            share = votes.max(1, initial=0) / (len(tables) * VOTE)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([forest.labels[i] for i in best], pa.string()), pa.array(share)], names)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]]
    return kept.mapInArrow(run, ", ".join([*fields, "predicted string", "share double"]))
