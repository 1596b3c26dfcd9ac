"""Boosted trees over binned columns, any number of fits in the same passes.

Columns are cut into bins once and kept as bytes, in blocks of rows with one line of
bytes per column.  A pass over the blocks adds gradients and curvatures per fit, tree
node, column and bin; the sums alone decide the splits of a level.  Of two children only
the lighter is summed, the other is what its parent has besides.  All fits grow their
trees level by level together, so products share passes, and a pass moves a histogram
per node, never rows.
"""

from __future__ import annotations

import gc
import math
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, inheritable_thread_target
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from hearthscore.config import BoostSettings
from hearthscore.session import scratch_path

BINS = 32
EDGE_ROWS = 10_000  # rows that bin edges are read from; every pass reads all rows
RESTAGE = 25  # rounds after which the rows' margins are written again
REKEEP = 5  # rounds after which the kept rows' margins are brought up to date
TASK_BYTES = 16 << 20  # most binned bytes per task
LEAST_TASK_BYTES = 1 << 20  # smaller tasks would be mostly latency
PASS_PARTITIONS = 4  # reducers of a pass
FEW_TASKS = 16  # up to these, their histograms are added without a shuffle
BLOCK = 16384  # rows of one fit that are handled at once
THREADS = 4  # driver threads that read the tables' means and bin edges
STATE = "fit int, y double, w double, u bigint, margin double, bins binary"
BLOCKS = "fit int, y binary, w binary, u binary, margin binary, bins binary"
_settled = False  # in a worker: whether its modules are left out of the search for cycles


@dataclass
class Tree:
    """A binary tree in heap order: children of node i are 2i + 1 and 2i + 2."""

    column: np.ndarray  # -1: no split
    cut: np.ndarray  # bins up to the cut go left
    gain: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1), np.zeros(n, dtype=int), np.zeros(n), np.zeros(n))

    def place(self, bins: np.ndarray) -> np.ndarray:
        """The last node each row reaches; ``bins`` holds a line per column."""
        at = np.zeros(bins.shape[1], dtype=np.uint8 if len(self.column) <= 256 else np.int32)
        reached = {0: np.ones(bins.shape[1], dtype=bool)}
        for node in np.flatnonzero(self.column >= 0).tolist():  # parents come before their children
            here = reached.pop(node)
            right = here & (bins[self.column[node]] > int(self.cut[node]))
            reached[2 * node + 1], reached[2 * node + 2] = here ^ right, right
            at += here * at.dtype.type(node + 1)  # on to the left child,
            at += right  # or the one after it
        return at


@dataclass
class Boosted:
    """A fitted sum of trees: ``base`` plus ``step`` times each tree's value."""

    base: float
    step: float
    edges: list[np.ndarray]
    trees: list[Tree] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        bins = np.array([np.searchsorted(e, x[:, i], "left") for i, e in enumerate(self.edges)])
        return self.base + self.step * sum((t.value[t.place(bins)] for t in self.trees), np.zeros(len(x)))


def _edges(df: DataFrame, key: str) -> list[np.ndarray]:
    """Upper bounds of all bins but the last, per column, from the smallest key hashes.

    A column with few values has its edges halfway between them.
    """
    rows = df.orderBy(F.xxhash64(key), key).limit(EDGE_ROWS).select(vector_to_array("features").alias("x"))
    found = np.array([r.x for r in rows.collect()])
    out = []
    for column in found.T:
        values = np.unique(column)
        if len(values) > BINS:
            values = np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1), method="lower"))
        out.append(np.unique((values[:-1] + values[1:]) / 2)[: BINS - 1])
    return out


def _binned(df: DataFrame, key: str, fit: int, base: float, edges: list[np.ndarray], width: int) -> DataFrame:
    """Rows of one fit in ``STATE`` form; columns beyond the fit's own are bin 0."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, len(edges))
            bins = np.zeros((n, width), dtype=np.uint8)
            for i, e in enumerate(edges):
                bins[:, i] = np.searchsorted(e, x[:, i], "left")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, fit, dtype=np.int32)),
                    *[batch.column(c) for c in ("y", "w", "u")],
                    pa.array(np.full(n, base)),
                    pa.array([b.tobytes() for b in bins], pa.binary()),
                ],
                ["fit", "y", "w", "u", "margin", "bins"],
            )

    weight = F.col("weight") if "weight" in df.columns else F.lit(1.0)
    rows = df.select(
        vector_to_array("features").alias("x"),
        F.col("label").cast("double").alias("y"),
        weight.cast("double").alias("w"),
        F.xxhash64(key).alias("u"),
    )
    return rows.mapInArrow(cut, STATE)


def _hashed(u: np.ndarray, draw: int) -> np.ndarray:
    """64 bits from the row's own hash and the draw's number."""
    z = u.astype(np.uint64) + np.uint64(draw * 0x9E3779B97F4A7C15 % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return z ^ (z >> np.uint64(31))


def _drawn(u: np.ndarray, draw: int, share: float) -> np.ndarray:
    """Rows of a round's sample: a hash of the row's own hash and the draw's number."""
    if share >= 1.0:
        return np.ones(len(u), dtype=bool)
    return _hashed(u, draw) < np.uint64(int(share * 2**64))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in ``STATE`` form as blocks in ``BLOCKS`` form."""
    waiting: dict[int, list[pa.RecordBatch]] = {}

    def packed(fit: int, rows: pa.Table) -> pa.RecordBatch:
        lines = np.frombuffer(b"".join(rows["bins"].to_pylist()), dtype=np.uint8).reshape(rows.num_rows, -1)
        columns = [rows[c].to_numpy().tobytes() for c in ("y", "w", "u", "margin")]
        cells = [*columns, np.ascontiguousarray(lines.T).tobytes()]
        return pa.RecordBatch.from_arrays(
            [pa.array([fit], pa.int32()), *[pa.array([c], pa.binary()) for c in cells]],
            ["fit", "y", "w", "u", "margin", "bins"],
        )

    for batch in batches:
        fits = batch.column("fit").to_numpy()
        for fit in np.unique(fits).tolist():
            mine = waiting.setdefault(fit, [])
            mine.append(batch.filter(pa.array(fits == fit)))
            if sum(b.num_rows for b in mine) >= BLOCK:
                yield packed(fit, pa.Table.from_batches(waiting.pop(fit)))
    for fit, mine in waiting.items():
        yield packed(fit, pa.Table.from_batches(mine))


@dataclass
class Block:
    """Rows of one fit; ``bins`` holds a line per column."""

    fit: int
    y: np.ndarray
    w: np.ndarray
    u: np.ndarray
    margin: np.ndarray
    bins: np.ndarray

    @classmethod
    def of(cls, row: Row) -> Block:
        y, w, u, margin = (np.frombuffer(row[c], t) for c, t in (("y", "f8"), ("w", "f8"), ("u", "i8"), ("margin", "f8")))
        return cls(row["fit"], y, w, u, margin, np.frombuffer(row["bins"], np.uint8).reshape(-1, len(y)))

    def advanced(self, trees: list[list[Tree]], step: float) -> np.ndarray:
        """Margins after the trees that are not in the table yet."""
        margin = self.margin.copy()
        for tree in trees[self.fit]:
            margin += step * tree.value[tree.place(self.bins)]
        return margin


def settled(mine: Iterator) -> Iterator:
    """The same rows; spares a reused worker the search for cycles among all modules after every task.

    That search takes longer than a short pass itself.  What tasks make later is still searched.
    """
    global _settled
    if not _settled:
        gc.freeze()
        _settled = True
    return mine


def _histograms(
    blocks: RDD, trees: list[list[Tree]], growing: list[Tree], columns: list[np.ndarray], level: int,
    logistic: bool, s: BoostSettings, draw: int, above: dict[tuple[int, int], np.ndarray], width: int,
) -> dict[tuple[int, int], np.ndarray]:
    """Gradient and curvature sums (2 x columns x bins) per fit and node of ``level``.

    Of the columns only the first, whose sum is the node's, and the tree's own are filled.
    ``above`` holds the sums of the level before: only the lighter child of a split is
    summed over the rows, its sibling has the rest.
    """
    first, nodes = 2**level - 1, 2**level
    wanted = [np.union1d(c, [0]).astype(int) for c in columns]
    counts = np.zeros((len(growing), nodes), dtype=bool)
    counts[:, 0] = level == 0
    pairs = []  # fit, parent, lighter child, its sibling
    for (fit, parent), sums in above.items():
        tree, node = growing[fit], (first - 1) // 2 + parent
        if tree.column[node] >= 0:
            curves = sums[1, tree.column[node]]
            right = int(2 * curves[: tree.cut[node] + 1].sum() > curves.sum())
            pairs.append((fit, parent, 2 * parent + right, 2 * parent + 1 - right))
            counts[fit, 2 * parent + right] = True

    def partial(mine: Iterator[Block]) -> Iterator[tuple[int, np.ndarray]]:
        sums: dict[int, np.ndarray] = {}
        for b in settled(mine):
            margin = b.advanced(trees, s.step)
            if logistic:
                p = 1 / (1 + np.exp(-margin))
                g, h = b.w * (p - b.y), b.w * p * (1 - p)
            else:
                g, h = b.w * (margin - b.y), b.w
            node = growing[b.fit].place(b.bins).astype(np.intp) - first
            counted = np.flatnonzero(_drawn(b.u, draw, s.row_share) & (node >= 0) & counts[b.fit, np.maximum(node, 0)])
            g, h, start = g[counted], h[counted], node[counted] * BINS
            total = sums.setdefault(b.fit, np.zeros((2, len(wanted[b.fit]), nodes * BINS)))
            for i, c in enumerate(wanted[b.fit]):
                at = start + b.bins[c][counted]
                total[0, i] += np.bincount(at, g, nodes * BINS)
                total[1, i] += np.bincount(at, h, nodes * BINS)
        for fit, total in sums.items():
            lines = total.reshape(2, -1, nodes, BINS)
            for i in np.flatnonzero(lines.any(axis=(0, 1, 3))).tolist():
                yield fit * nodes + i, np.ascontiguousarray(lines[:, :, i])

    lines = blocks.mapPartitions(partial)
    if blocks.getNumPartitions() > FEW_TASKS:
        lines = lines.reduceByKey(np.add, PASS_PARTITIONS, int)
    summed: dict[int, np.ndarray] = {}
    for i, line in lines.collect():
        summed[i] = summed[i] + line if i in summed else line
    found = {}
    for i, line in summed.items():
        fit, node = divmod(i, nodes)
        found[fit, node] = np.zeros((2, width, BINS))
        found[fit, node][:, wanted[fit]] = line
    for fit, parent, lighter, other in pairs:
        whole = above[fit, parent]
        rest = whole - found[fit, lighter] if (fit, lighter) in found else whole.copy()
        rest[:, rest[1] <= 1e-12 * whole[1]] = 0.0  # no row there, but for rounding
        found[fit, other] = rest
    return found


def _value(g: float, h: float, ridge: float) -> float:
    return -g / (h + ridge) if h + ridge > 0 else 0.0


def _grow(tree: Tree, node: int, sums: np.ndarray, columns: np.ndarray, ridge: float, least: float) -> None:
    """Give ``node`` its best split and its children their values, or leave it a leaf.

    Gains are compared in nine digits: sums differ in the last ones from run to run.
    """
    total = sums[:, 0, :].sum(axis=1)
    tree.value[node] = _value(*total, ridge)
    left = sums.cumsum(axis=2)[:, :, :-1]
    right = total[:, None, None] - left

    def score(x):
        return x[0] ** 2 / np.maximum(x[1] + ridge, 1e-300)

    gain = score(left) + score(right) - score(total)
    own = np.zeros((gain.shape[0], 1), dtype=bool)
    own[columns] = True
    allowed = (left[1] >= least) & (right[1] >= least) & own
    gain = np.where(allowed, gain, 0.0)
    top = gain.max(initial=0.0)
    if top <= 1e-9 * max(score(total), 1e-300):
        return
    column, cut = np.unravel_index(np.argmax(gain >= top * (1 - 1e-9)), gain.shape)
    tree.column[node], tree.cut[node], tree.gain[node] = column, cut, top
    for child, part in ((2 * node + 1, left), (2 * node + 2, right)):
        tree.value[child] = _value(part[0, column, cut], part[1, column, cut], ridge)


def _columns(n: int, share: str, seed: int) -> np.ndarray:
    """The columns a tree may split on."""
    if share == "all":
        return np.arange(n)
    part = math.sqrt(n) / n if share == "sqrt" else float(share)
    size = max(1, round(n * part))
    return np.random.default_rng(seed).choice(n, size, replace=False)


def fit_boosted(
    tables: Sequence[DataFrame], key: str, s: BoostSettings, seed: int, logistic: bool
) -> list[Boosted]:
    """One model per table (key, features, label and, where given, weight), all in the same passes.

    A leaf's value is the Newton step of its rows, with a penalty of 1 for the logistic
    loss and none for the squared one; ``min_rows`` bounds a child's curvature (for
    the squared loss: its weight).  Rows are sampled per round, columns per tree.  A
    table without rows gives a model without trees.
    """
    if not tables:
        return []
    ridge = 1.0 if logistic else 0.0
    spark = tables[0].sparkSession

    def begun(table: DataFrame) -> tuple[int, float | None, list[np.ndarray]]:
        weight = F.col("weight") if "weight" in table.columns else F.lit(1.0)
        n, mean = table.agg(F.count(F.lit(1)), F.try_divide(F.sum(weight * F.col("label")), F.sum(weight))).first()
        return n, mean, _edges(table, key) if n else []

    models, parts, rows = [], [], 0
    with ThreadPoolExecutor(THREADS) as pool:
        counted = list(pool.map(inheritable_thread_target(spark)(begun), tables))
    for n, mean, edges in counted:
        mean = mean or 0.0
        if logistic:
            mean = min(max(mean, 1e-9), 1 - 1e-9)
            mean = math.log(mean / (1 - mean))
        models.append(Boosted(mean, s.step, edges))
        rows += n
    width = max(1, *(len(m.edges) for m in models))
    for fit, (table, model) in enumerate(zip(tables, models)):
        if model.edges:
            parts.append(_binned(table, key, fit, model.base, model.edges, width))
    if not parts:
        return models
    binned = reduce(DataFrame.unionByName, parts).repartition(_tasks(rows * width, spark), "u")
    table = _staged(binned.mapInArrow(_blocks, BLOCKS), spark)
    blocks = _kept(table)
    recent: list[list[Tree]] = [[] for _ in models]  # since the table was written
    pending: list[list[Tree]] = [[] for _ in models]  # since the kept rows were brought up to date
    replaced = None
    for turn in range(s.rounds):
        growing = [Tree.empty(s.depth) for _ in models]
        columns = [_columns(len(m.edges), s.column_share, seed + 7919 * turn + i) if m.edges else np.arange(0)
                   for i, m in enumerate(models)]
        found: dict[tuple[int, int], np.ndarray] = {}
        for level in range(s.depth):
            found = _histograms(blocks, pending, growing, columns, level, logistic, s, seed + turn, found, width)
            if replaced:
                replaced = replaced.unpersist() and None
            for (fit, node), sums in found.items():
                _grow(growing[fit], 2**level - 1 + node, sums, columns[fit], ridge, s.min_rows)
            if not any((t.column[2**level - 1 : 2 ** (level + 1) - 1] >= 0).any() for t in growing):
                break
        for i, (model, tree) in enumerate(zip(models, growing)):
            model.trees.append(tree)
            recent[i].append(tree)
            pending[i].append(tree)
        if turn + 1 == s.rounds:
            break
        if (turn + 1) % RESTAGE == 0:
            table = _staged(_moved(table, recent, s.step), spark)
            blocks.unpersist()
            blocks, recent, pending = _kept(table), [[] for _ in models], [[] for _ in models]
        elif (turn + 1) % REKEEP == 0:
            replaced, blocks = blocks, _advanced(blocks, pending, s.step)
            pending = [[] for _ in models]
    blocks.unpersist()
    return models


def _tasks(size: int, spark: SparkSession) -> int:
    """Tasks of a pass over ``size`` bytes: few, or whole rounds of all cores."""
    cores = max(1, spark.sparkContext.defaultParallelism)
    if size < cores * LEAST_TASK_BYTES:
        return size // LEAST_TASK_BYTES + 1
    return cores * math.ceil(size / (cores * TASK_BYTES))


def _staged(df: DataFrame, spark: SparkSession) -> DataFrame:
    """Written for recovery."""
    path = scratch_path(spark, "binned")
    df.write.parquet(path)
    return spark.read.schema(BLOCKS).parquet(path)


def _kept(table: DataFrame) -> RDD:
    """Kept on the executors for speed; passes over an RDD need no planning."""
    return table.rdd.map(Block.of).persist(StorageLevel.MEMORY_AND_DISK)


def _advanced(blocks: RDD, trees: list[list[Tree]], step: float) -> RDD:
    """The kept rows with the trees in their margins, kept as well."""
    moved = blocks.map(lambda b: replace(b, margin=b.advanced(trees, step)))
    return moved.persist(StorageLevel.MEMORY_AND_DISK)


def _moved(table: DataFrame, trees: list[list[Tree]], step: float) -> DataFrame:
    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = [Block.of(row).advanced(trees, step).tobytes() for row in batch.to_pylist()]
            at = batch.schema.get_field_index("margin")
            yield batch.set_column(at, "margin", pa.array(margins, pa.binary()))

    return table.mapInArrow(move, BLOCKS)


def to_spark(spark: SparkSession, model: Boosted, logistic: bool):
    """The same model as a Spark ML stage, saved, loaded and applied like a fitted one.

    Spark's classifier doubles the sum of its trees before the logistic function.
    """
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    nodes, tree_of = jvm.org.apache.spark.ml.tree, jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    half = 0.5 if logistic else 1.0
    one = gateway.new_array(jvm.double, 3)
    one[0] = 1.0
    count = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(one, 1)

    def leaf(value: float):
        return nodes.LeafNode(float(value * half), 0.0, count)

    def build(tree: Tree, at: int):
        if tree.column[at] < 0:
            return leaf(tree.value[at])
        column = int(tree.column[at])
        split = nodes.ContinuousSplit(column, float(model.edges[column][tree.cut[at]]))
        value, gain = float(tree.value[at] * half), float(tree.gain[at])
        return nodes.InternalNode(value, 0.0, gain, build(tree, 2 * at + 1), build(tree, 2 * at + 2), split, count)

    roots = [leaf(model.base), *(build(t, 0) for t in model.trees)]
    trees = gateway.new_array(tree_of, len(roots))
    weights = gateway.new_array(jvm.double, len(roots))
    for i, root in enumerate(roots):
        trees[i] = tree_of(f"dtr_{i}", root, len(model.edges))
        weights[i] = float(model.step if i else 1.0)
    name = f"boosted_{uuid.uuid4().hex[:12]}"
    if logistic:
        made = jvm.org.apache.spark.ml.classification.GBTClassificationModel(
            name, trees, weights, len(model.edges), 2
        )
        return GBTClassificationModel(made)
    return GBTRegressionModel(
        jvm.org.apache.spark.ml.regression.GBTRegressionModel(name, trees, weights, len(model.edges))
    )
