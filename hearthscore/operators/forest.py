"""Random forests over binned columns, any number of fits in the same passes.

Rows lie in the blocks of ``boosting``.  A pass adds, per tree, node of a level and
column drawn for the node, the sums of every bin; they are combined per tree where the
best splits are chosen, so the driver gets one line per node.  How often a tree draws a
row, and which columns a node may use, follow from hashes and seeds, not from partitions.
"""

from __future__ import annotations

import json
import math
import operator
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import RDD, inheritable_thread_target
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthscore.config import ForestSettings
from hearthscore.operators.boosting import (
    BINS,
    BLOCKS,
    THREADS,
    Block,
    _binned,
    _blocks,
    _edges,
    _hashed,
    _kept,
    _staged,
    _tasks,
    settled,
)
from hearthscore.session import scratch_path

GROUP_BYTES = 32 << 20  # most sums a task holds at once; more trees take another pass, between which boosting gets cores
#: Chances that a row is drawn at most 0, 1, ... times, of 2^64.
DRAWN = np.array(
    [int(math.exp(-1) * sum(1 / math.factorial(j) for j in range(k + 1)) * 2**64) for k in range(12)], dtype=np.uint64
)
NODE = (
    "treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>,"
    " rawCount bigint, gain double, leftChild int, rightChild int,"
    " split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"
)


@dataclass
class Forest:
    """Trees in heap order, a line each; ``sums`` holds rows, weight, label and squared label of the nodes."""

    edges: list[np.ndarray]
    column: np.ndarray  # -1: no split
    cut: np.ndarray  # bins up to the cut go left
    gain: np.ndarray
    sums: np.ndarray
    open: np.ndarray  # nodes that may be split

    @classmethod
    def empty(cls, edges: list[np.ndarray], trees: int, depth: int) -> Forest:
        shape = (trees, 2 ** (depth + 1) - 1)
        first = np.zeros(shape, dtype=bool)
        first[:, 0] = bool(edges)
        return cls(edges, np.full(shape, -1, np.int16), np.zeros(shape, np.uint8), np.zeros(shape), np.zeros((*shape, 4)), first)


@dataclass
class Layout:
    """Where the sums of a tree's open nodes lie: a cell per node, drawn column and bin."""

    nodes: np.ndarray
    columns: np.ndarray  # a line per node
    starts: np.ndarray
    sizes: np.ndarray
    cells: int
    whole: bool = False  # every node has all columns

    @classmethod
    def of(cls, nodes: np.ndarray, bins: np.ndarray, share: str, seed: Sequence[int]) -> Layout:
        n, first = len(bins), 2 ** int(nodes[0] + 1).bit_length() // 2 - 1
        if share == "all":
            columns = np.tile(np.arange(n), (len(nodes), 1))
        else:
            size = max(1, math.ceil(math.sqrt(n) if share == "sqrt" else float(share) * n))
            # A line for every node of the level: a node's columns do not depend on which others are open.
            drawn = np.random.default_rng(seed).random((first + 1, n))
            columns = np.sort(np.argsort(drawn, axis=1)[:, :size], axis=1)[nodes - first]
        sizes = bins[columns]
        ends = sizes.ravel().cumsum()
        return cls(nodes, columns, (ends - sizes.ravel()).reshape(sizes.shape), sizes, int(ends[-1]), share == "all")


def _times(u: np.ndarray, draw: int) -> np.ndarray:
    """How often a tree draws each row: Poisson numbers of mean 1 from the row's hash."""
    return np.searchsorted(DRAWN, _hashed(u, draw), "right")


def _sums(b: Block, cells: np.ndarray, f: tuple[np.ndarray, np.ndarray], layout: Layout, level: int, draw: int, plain: bool) -> np.ndarray:
    """Sums of one tree over a block; ``cells`` holds the bins by row."""
    column, cut = f
    width = len(b.bins)
    times = _times(b.u, draw)
    rows = np.flatnonzero(times)
    at = np.zeros(len(rows), dtype=np.intp)
    for _ in range(level):
        c = column[at]
        split = c >= 0
        rows, at, c = rows[split], at[split], c[split]
        at = 2 * at + 1 + (cells[rows * width + c] > cut[at])
    slot = np.full(len(column), -1)
    slot[layout.nodes] = np.arange(len(layout.nodes))
    node = slot[at]
    rows, node = rows[node >= 0], node[node >= 0]
    if layout.whole:
        return _column_sums(b, rows, times[rows], node, layout, plain)
    found = (layout.starts[node] + cells[(rows * width)[:, None] + layout.columns[node]]).ravel()
    n, per = times[rows].astype(float), layout.columns.shape[1]
    w = n * b.w[rows]
    wy = w * b.y[rows]
    values = [n, w, wy] if plain else [n, w, wy, wy * b.y[rows]]
    return np.array([np.bincount(found, np.repeat(v, per), layout.cells) for v in values])


def _column_sums(b: Block, rows: np.ndarray, times: np.ndarray, node: np.ndarray, layout: Layout, plain: bool) -> np.ndarray:
    """The same sums where every node has drawn all columns: column by column, as they are stored."""
    n, w, y = times.astype(float), b.w[rows], b.y[rows]
    weighted = bool((w != 1.0).any())
    wy = n * w * y
    values = [n, *([n * w] if weighted else []), wy, *([] if plain else [wy * y])]
    nodes = len(layout.nodes)
    out = np.zeros((len(values), nodes, layout.cells // nodes))
    for lines, start, size in zip(b.bins, layout.starts[0].tolist(), layout.sizes[0].tolist()):
        at = node * size + lines[rows]
        for i, v in enumerate(values):
            out[i, :, start : start + size] = np.bincount(at, v, nodes * size).reshape(nodes, size)
    out = out.reshape(len(values), -1)
    return out if weighted else out[[0, *range(len(values))]]  # of weight 1: as many as there are


def _best(sums: np.ndarray, layout: Layout, least: int) -> tuple[np.ndarray, ...]:
    """Per node its sums, best column, cut and gain, and the sums of the left child; no gain: no split.

    Gains are compared in nine digits: sums differ in the last ones from run to run.
    """
    k, per = layout.columns.shape
    wide = np.zeros((len(sums), k, per, BINS))
    wide[:, np.arange(BINS) < layout.sizes[:, :, None]] = sums
    total = wide[:, :, 0].sum(axis=2)
    left = wide.cumsum(axis=3)[:, :, :, :-1]
    right = total[:, :, None, None] - left

    def score(x):
        return x[2] ** 2 / np.maximum(x[1], 1e-300)

    whole = score(total)
    gain = score(left) + score(right) - whole[:, None, None]
    gain = np.where((left[0] >= least) & (right[0] >= least), gain, 0.0).reshape(k, -1)
    top = gain.max(axis=1)
    place = (gain >= top[:, None] * (1 - 1e-9)).argmax(axis=1)
    drawn, cut = np.divmod(place, BINS - 1)
    nodes = np.arange(k)
    top = np.where(top > 1e-9 * np.maximum(whole, 1e-300), top, 0.0)
    return total, layout.columns[nodes, drawn], cut, top, left[:, nodes, drawn, cut]


def fit_forests(tables: Sequence[DataFrame], key: str, s: ForestSettings, seed: int, classify: bool) -> list[Forest]:
    """One forest per table (key, features, label and, where given, weight), all in the same passes.

    Trees see rows as often as a Poisson number says, nodes a new draw of columns; the
    best split is that of the Gini impurity or the variance.  ``min_rows`` bounds the
    drawn rows of a child.  A table without rows gives trees without splits.
    """
    if not tables:
        return []
    spark = tables[0].sparkSession

    def begun(table: DataFrame) -> tuple[int, list[np.ndarray]]:
        n = table.count()
        return n, _edges(table, key) if n else []

    with ThreadPoolExecutor(THREADS) as pool:
        counted = list(pool.map(inheritable_thread_target(spark)(begun), tables))
    models, parts, rows = [Forest.empty(edges, s.trees, s.depth) for _, edges in counted], [], sum(n for n, _ in counted)
    width = max([1, *(len(m.edges) for m in models)])
    for fit, (table, model) in enumerate(zip(tables, models)):
        if model.edges:
            parts.append(_binned(table, key, fit, 0.0, model.edges, width))
    if not parts:
        return models
    cores = max(1, spark.sparkContext.defaultParallelism)
    binned = reduce(DataFrame.unionByName, parts).repartition(_tasks(rows * width, spark), "u")
    blocks = _kept(_staged(binned.mapInArrow(_blocks, BLOCKS), spark))
    few = blocks.coalesce(2 * cores) if blocks.getNumPartitions() > 2 * cores else blocks  # each task sends sums of all trees
    for level in range(s.depth):
        group: dict[tuple[int, int], Layout] = {}
        held = 0
        for fit, m in enumerate(models):
            bins = np.array([len(e) + 1 for e in m.edges])
            for tree in range(s.trees):
                nodes = np.flatnonzero(m.open[tree, 2**level - 1 : 2 ** (level + 1) - 1]) + 2**level - 1
                if not len(nodes):
                    continue
                layout = Layout.of(nodes, bins, s.columns, (seed, tree, level))
                size = layout.cells * (24 if classify else 32)
                if group and held + size > GROUP_BYTES:
                    _split(few, models, group, level, s, seed, classify)
                    group, held = {}, 0
                group[fit, tree] = layout
                held += size
        if group:
            _split(few, models, group, level, s, seed, classify)
    blocks.unpersist()
    return models


def _split(blocks: RDD, models: list[Forest], group: dict[tuple[int, int], Layout], level: int, s: ForestSettings, seed: int, classify: bool) -> None:
    """Split the open nodes of the group's trees."""
    names = list(group)
    trees = [(models[f].column[t], models[f].cut[t]) for f, t in names]
    layouts = list(group.values())
    shared = blocks.context.broadcast((names, trees, layouts))

    def partial(mine: Iterator[Block]) -> Iterator[tuple[int, np.ndarray]]:
        names, trees, layouts = shared.value
        sums: dict[int, np.ndarray] = {}
        for b in settled(mine):
            cells = np.ascontiguousarray(b.bins.T).ravel()
            for i, (fit, tree) in enumerate(names):
                if fit == b.fit:
                    found = _sums(b, cells, trees[i], layouts[i], level, seed + 104729 * (tree + 1), classify)
                    if i in sums:
                        sums[i] += found
                    else:
                        sums[i] = found
        yield from sums.items()

    def best(item: tuple[int, np.ndarray]):
        return item[0], _best(item[1], shared.value[2][item[0]], s.min_rows)

    added = blocks.mapPartitions(partial).reduceByKey(operator.iadd, blocks.getNumPartitions(), int)
    for i, (total, column, cut, gain, left) in added.map(best).collect():
        fit, tree = names[i]
        m, nodes, n = models[fit], layouts[i].nodes, len(total)
        if level == 0:
            m.sums[tree, nodes, :n] = total.T
        split = gain > 0
        at, low, high = nodes[split], left[:, split], (total - left)[:, split]
        m.column[tree, at], m.cut[tree, at], m.gain[tree, at] = column[split], cut[split], gain[split]
        for child, part in ((2 * at + 1, low), (2 * at + 2, high)):
            m.sums[tree, child, :n] = part.T
            m.open[tree, child] = part[0] >= 2 * s.min_rows
    shared.unpersist()


def _nodes(model: Forest, classify: bool) -> pa.Table:
    """The nodes that the trees have, in ``NODE`` form: by tree and place, numbered within the tree."""
    split = model.column >= 0
    held = np.zeros(split.shape, dtype=bool)
    held[:, 0] = True
    for at in range((held.shape[1] - 1) // 2):  # parents come before their children
        held[:, 2 * at + 1] = held[:, 2 * at + 2] = held[:, at] & split[:, at]
    place = held.cumsum(axis=1) - 1
    tree, at = np.nonzero(held)
    n, w, wy, wyy = model.sums[tree, at].T
    column, cut, inner = model.column[tree, at], model.cut[tree, at], split[tree, at]
    some = np.where(w != 0, w, 1.0)
    mean = np.where(w != 0, wy / some, 0.0)
    impurity = 2 * mean * (1 - mean) if classify else np.where(w != 0, wyy / some - mean**2, 0.0)
    stats = np.array([w - wy, wy] if classify else [w, wy, wyy]).T
    gain = np.where(inner, model.gain[tree, at] / some * (2 if classify else 1), -1.0)
    below = [np.where(inner, place[tree, np.where(inner, 2 * at + side, 0)], -1) for side in (1, 2)]
    cuts = np.array([model.edges[c][j] for c, j in zip(column[inner].tolist(), cut[inner].tolist())], dtype=float)
    splits = pa.StructArray.from_arrays(
        [
            pa.array(column, pa.int32()),
            pa.ListArray.from_arrays(pa.array(np.concatenate(([0], inner.cumsum())), pa.int32()), pa.array(cuts)),
            pa.array(np.full(len(at), -1), pa.int32()),
        ],
        ["featureIndex", "leftCategoriesOrThreshold", "numCategories"],
    )
    each = pa.array(np.arange(len(at) + 1) * stats.shape[1], pa.int32())
    nodes = pa.StructArray.from_arrays(
        [
            pa.array(place[tree, at], pa.int32()),
            pa.array((mean > 0.5).astype(float) if classify else mean),
            pa.array(impurity),
            pa.ListArray.from_arrays(each, pa.array(stats.ravel())),
            pa.array(n.astype(np.int64)),
            pa.array(gain),
            *[pa.array(b, pa.int32()) for b in below],
            splits,
        ],
        ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"],
    )
    return pa.table({"treeID": pa.array(tree, pa.int32()), "nodeData": nodes})


def to_spark(spark: SparkSession, model: Forest, s: ForestSettings, seed: int, classify: bool):
    """The same forest as a Spark ML model, read from the form in which Spark saves one."""
    kind, single = ("RandomForest", "DecisionTree")
    task = "classification.{}ClassificationModel" if classify else "regression.{}RegressionModel"
    params = {"impurity": "gini" if classify else "variance", "maxDepth": s.depth, "minInstancesPerNode": s.min_rows, "seed": seed}
    more = {"numFeatures": len(model.edges), **({"numClasses": 2} if classify else {})}

    def described(name: str, **extra) -> str:
        return json.dumps({
            "class": "org.apache.spark.ml." + task.format(name), "timestamp": 0, "sparkVersion": spark.version,
            "uid": f"{name}_{uuid.uuid4().hex[:12]}", "paramMap": {**params, **extra}, "defaultParamMap": {}, **more,
            **({"numTrees": len(model.column)} if name == kind else {}),
        })

    path = scratch_path(spark, "forest")
    spark.createDataFrame([(described(kind, numTrees=len(model.column)),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    each = [(t, described(single), 1.0) for t in range(len(model.column))]
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame(_nodes(model, classify), NODE).write.parquet(f"{path}/data")
    return (RandomForestClassificationModel if classify else RandomForestRegressionModel).load(path)
