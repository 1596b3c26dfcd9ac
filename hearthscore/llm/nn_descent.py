"""Embedding near-duplicates by NN-descent.

Every vector keeps a list of neighbours.  Lists start from neighbours in the sort
order of random sign codes and are refined by joins of neighbours' neighbours:
the vectors of a node's list and of the lists that hold it meet in one task, and
a pair enters a list if it beats that list's last entry.  A list whose entries
all reach the threshold is saturated; it is enlarged and then keeps a uniform
sample of its links.  Links among the saturated nodes of a group are counted
exactly without listing them: vectors within half the threshold's angle of a
common centre are all linked to each other, and the others are compared with
their group in blocks.  A sample of queries against all rows audits the result;
while it misses links, new codes and further joins follow.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearthscore.llm.common import batch_of, lookup, pylists
from hearthscore.llm.components import components
from hearthscore.session import stage_table

CODE_BITS = 62
ROUNDING = 0.002  # cosines of half-precision unit vectors are off by less than this
ANGLE_SLACK = 1e-6  # radians; far above the rounding of an arc cosine


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.9
    list_size: int = 12
    enlarged: int = 48  # links a saturated list keeps; the rest is counted by group
    met: int = 32  # neighbours of a node that meet in one join
    codes: int = 8  # sort orders the lists start from
    ahead: int = 3  # neighbours taken in each of them
    joins: int = 12  # at most so many joins of neighbours' neighbours in a row
    gain: float = 0.001  # a join that adds a smaller share of links is the last one
    audited: int = 1024  # queries of the audit
    recall: float = 0.98  # below this the search goes on with new codes,
    searches: int = 4  # at most so often
    block: int = 512  # vectors compared at once


# --- vectors --------------------------------------------------------------------

VECTOR = pa.schema(
    [
        ("id", pa.int64()),
        ("key", pa.binary()),
        ("d", pa.int32()),
        ("exact", pa.list_(pa.float64())),
        ("unit", pa.binary()),
    ]
)
VECTOR_DDL = "id long, key binary, d int, exact array<double>, unit binary"


def _unit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, vector in pylists(batch):
            row = (doc, None, None, None, None)
            if vector and None not in vector:
                v = np.array(vector, dtype=float) + 0.0  # one zero, not two
                top = np.abs(v).max()
                if np.isfinite(top) and top > 0:
                    unit = v / top
                    unit /= np.linalg.norm(unit)
                    digest = hashlib.sha256(v.tobytes()).digest()
                    row = (doc, digest, len(v), unit, unit.astype(np.float16).tobytes())
            rows.append(row)
        yield batch_of(VECTOR, rows)


def nodes_of(rows: DataFrame) -> DataFrame:
    """Staged, one row per distinct vector: node, key, least id, copies, d, exact, unit."""
    classes = rows.where("key is not null").groupBy("key").agg(
        F.min("id").alias("least"),
        F.count(F.lit(1)).alias("copies"),
        F.first("d").alias("d"),
        F.first("exact").alias("exact"),
        F.first("unit").alias("unit"),
    )
    return stage_table(classes.withColumn("node", F.monotonically_increasing_id()), "vectors")


def _units(column: pa.Array, d: int) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, dtype=np.float16).reshape(-1, d).astype(np.float32)


# --- lists ----------------------------------------------------------------------

PAIR = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("s", pa.float32()), ("h", pa.int64())])
PAIR_DDL = "u long, v long, s float, h long"


def _mix(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Pseudo-random order of a node's links: a hash of the ordered pair."""
    x = u.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ v.astype(np.uint64)
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(factor)
    return (x >> np.uint64(1)).astype(np.int64)


def _pairs(u: np.ndarray, v: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(u), pa.array(v), pa.array(s.astype(np.float32)), pa.array(_mix(u, v))]
    return pa.RecordBatch.from_arrays(columns, schema=PAIR)


def seeds(nodes: DataFrame, s: Settings, search: int) -> DataFrame:
    """Neighbours in the sort orders of random sign codes, both directions.

    A range exchange deals out every order; the vectors at its borders merely
    miss a few neighbours there.
    """
    codes, ahead = s.codes, s.ahead

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            at = {}
            for i, d in enumerate(batch.column("d").to_pylist()):
                at.setdefault(d, []).append(i)
            for d, places in at.items():
                if d not in planes:
                    shape = (d, codes * CODE_BITS)
                    planes[d] = np.random.default_rng([search, d]).standard_normal(shape).astype(np.float32)
                part = batch.take(pa.array(places))
                bits = (_units(part.column("unit"), d) @ planes[d] > 0).reshape(-1, codes, CODE_BITS)
                weights = 1 << np.arange(CODE_BITS - 1, -1, -1, dtype=np.int64)
                code = (bits * weights).sum(axis=2)
                for t in range(codes):
                    out = {
                        "d": part.column("d"),
                        "t": pa.array(np.full(len(places), t, dtype=np.int32)),
                        "code": pa.array(code[:, t]),
                        "node": part.column("node"),
                        "unit": part.column("unit"),
                    }
                    yield pa.RecordBatch.from_pydict(out)

    def adjacent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if rest is not None:
                batch = pa.concat_batches([rest, batch])
            sizes = np.array(batch.column("d").to_pylist())
            group = sizes * codes + np.array(batch.column("t").to_pylist())
            node = batch.column("node").to_numpy()
            for d in np.unique(sizes).tolist():
                places = np.flatnonzero(sizes == d)
                units = _units(batch.column("unit").take(pa.array(places)), d)
                for step in range(1, ahead + 1):
                    a, b = places[:-step], places[step:]
                    same = group[a] == group[b]
                    cos = np.einsum("ij,ij->i", units[:-step], units[step:])[same]
                    u, v = node[a][same], node[b][same]
                    yield _pairs(np.r_[u, v], np.r_[v, u], np.r_[cos, cos])
            rest = batch.slice(max(0, len(batch) - ahead))

    rows = nodes.select("node", "d", "unit")
    rows = rows.mapInArrow(coded, "d int, t int, code long, node long, unit binary")
    ordered = rows.repartitionByRange("d", "t", "code", "node").sortWithinPartitions("d", "t", "code", "node")
    return ordered.mapInArrow(adjacent, PAIR_DDL)


def best_lists(pairs: DataFrame, s: Settings) -> DataFrame:
    """Staged lists u, v, s, h, fresh: the nearest ones, and links of the smallest hashes.

    The links kept beyond the nearest are a uniform sample of all that were found.
    """
    merged = pairs.groupBy("u", "v").agg(F.max("s").alias("s"), F.min("h").alias("h"), F.min("fresh").alias("fresh"))
    link = F.col("s") >= s.threshold - ROUNDING
    near = Window.partitionBy("u").orderBy(F.desc("s"), "v")
    drawn = Window.partitionBy("u").orderBy(F.desc(link), "h", "v")
    ranked = merged.select("*", F.row_number().over(near).alias("near"), F.row_number().over(drawn).alias("drawn"))
    kept = (F.col("near") <= s.list_size) | (link & (F.col("drawn") <= s.enlarged))
    return stage_table(ranked.where(kept), "neighbours")


def joined(lists: DataFrame, nodes: DataFrame, s: Settings, turn: int) -> DataFrame:
    """Candidates from one join of neighbours' neighbours: pairs that enter a list.

    At most ``met`` neighbours of a node meet, fresh ones first; only pairs with
    a fresh neighbour are compared.
    """
    link = s.threshold - ROUNDING
    bars = lists.groupBy("u").agg(
        F.max(F.when(F.col("near") == s.list_size, F.col("s"))).alias("bar"),
        F.max(F.when((F.col("drawn") == s.enlarged) & (F.col("s") >= link), F.col("h"))).alias("last"),
    )
    edges = lists.select("u", "v", "fresh")
    around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"), "fresh"))
    around = around.groupBy("u", "v").agg(F.max("fresh").alias("fresh"))
    order = Window.partitionBy("u").orderBy(F.desc("fresh"), F.xxhash64("u", "v", F.lit(turn)), "v")
    around = around.withColumn("place", F.row_number().over(order)).where(F.col("place") <= s.met)
    around = around.withColumn("any", F.max("fresh").over(Window.partitionBy("u"))).where("any = 1")
    around = around.select(F.col("u").alias("hub"), F.col("v").alias("node"), "fresh")
    ends = nodes.select("node", "d", "unit").join(bars, nodes["node"] == bars["u"], "left").drop("u")
    met = around.join(ends, "node").repartition("hub").sortWithinPartitions("hub", "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if rest is not None:
                batch = pa.concat_batches([rest, batch])
            hub = batch.column("hub").to_numpy()
            cut = int(np.searchsorted(hub, hub[-1])) if len(hub) else 0
            rest = batch.slice(cut)  # the last hub may go on in the next batch
            yield from groups(batch.slice(0, cut))
        if rest is not None:
            yield from groups(rest)

    def groups(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not len(batch):
            return
        hub, node = batch.column("hub").to_numpy(), batch.column("node").to_numpy()
        fresh = batch.column("fresh").to_numpy() > 0
        bar = batch.column("bar").fill_null(-2.0).to_numpy(zero_copy_only=False)
        last = batch.column("last").fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
        sizes = batch.column("d").to_numpy()
        units = batch.column("unit").to_pylist()
        starts = np.r_[0, np.flatnonzero(np.diff(hub)) + 1, len(hub)]
        found = [[], [], []]
        for a, b in zip(starts[:-1], starts[1:]):
            d = int(sizes[a])
            x = np.frombuffer(b"".join(units[a:b]), dtype=np.float16).reshape(-1, d).astype(np.float32)
            cos = x @ x.T
            new = fresh[a:b]
            pairs = new[:, None] | new[None, :]
            np.fill_diagonal(pairs, False)
            enters = pairs & ((cos > bar[a:b, None]) | (cos >= link))
            i, j = np.nonzero(enters)
            for into, values in zip(found, (node[a + i], node[a + j], cos[i, j])):
                into.append(values)
            if sum(map(len, found[0])) > 1 << 18:
                yield from emit(found, node, bar, last, link)
                found = [[], [], []]
        yield from emit(found, node, bar, last, link)

    def emit(found, node, bar, last, link) -> Iterator[pa.RecordBatch]:
        if not found[0]:
            return
        u, v, cos = (np.concatenate(x) for x in found)
        order = np.argsort(node)
        at = order[np.searchsorted(node, u, sorter=order)]
        enters = (cos > bar[at]) | ((cos >= link) & (_mix(u, v) < last[at]))
        code = np.stack([u[enters], v[enters]], axis=1)
        code, first = np.unique(code, axis=0, return_index=True)
        yield _pairs(code[:, 0], code[:, 1], cos[enters][first])

    columns = met.select("hub", "node", "fresh", "d", "unit", "bar", "last")
    return columns.mapInArrow(compare, PAIR_DDL)


def descend(nodes: DataFrame, lists: DataFrame | None, s: Settings, search: int) -> DataFrame:
    """Lists after new seeds and joins, until a join adds hardly any link."""
    fresh = lambda df, flag: df.select("u", "v", "s", "h", F.lit(flag).alias("fresh"))
    pairs = fresh(seeds(nodes, s, search), 1)
    if lists is not None:
        pairs = pairs.unionByName(fresh(lists, 0))
    lists = best_lists(pairs, s)
    known = _n_links(lists, s)
    for turn in range(s.joins):
        candidates = fresh(joined(lists, nodes, s, turn), 1)
        lists = best_lists(candidates.unionByName(fresh(lists, 0)), s)
        before, known = known, _n_links(lists, s)
        if turn and known - before <= s.gain * known:
            break
    return lists


def _n_links(lists: DataFrame, s: Settings) -> int:
    return lists.where(F.col("s") >= s.threshold).count()


# --- links ----------------------------------------------------------------------


def _cosine(a: str, b: str):
    product = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), product))


def exact_links(lists: DataFrame, nodes: DataFrame, s: Settings) -> DataFrame:
    """Staged pairs u > v of cosine at least the threshold; doubtful ones are computed in doubles."""
    pairs = lists.where(F.col("s") >= s.threshold - ROUNDING).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"), "s"
    )
    pairs = pairs.groupBy("u", "v").agg(F.max("s").alias("s"))
    pairs = stage_table(pairs, "close_pairs")
    sure = pairs.where(F.col("s") >= s.threshold + ROUNDING).select("u", "v")
    of = lambda end: nodes.select(F.col("node").alias(end), F.col("exact").alias(f"x{end}"))
    doubtful = pairs.where(F.col("s") < s.threshold + ROUNDING).join(of("u"), "u").join(of("v"), "v")
    doubtful = doubtful.where(_cosine("xu", "xv") >= s.threshold).select("u", "v")
    return stage_table(sure.unionByName(doubtful), "links")


def dense_counts(dense: DataFrame, links: DataFrame, s: Settings) -> DataFrame:
    """Links among saturated nodes: ``node`` and the ``dense`` vectors linked to it.

    ``dense`` holds node, copies, d and exact; linked ones form a group.  Those
    within half the threshold's angle of the group's mean are linked to each
    other, by the triangle inequality; each of the others is compared with all
    of its group in blocks.
    """
    ids = dense.select("node")
    inner = links.join(ids.withColumnRenamed("node", "u"), "u").join(ids.withColumnRenamed("node", "v"), "v")
    roots = stage_table(components(inner), "dense_roots")
    found = dense.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    found = stage_table(found, "dense_groups")
    mean = Summarizer.metrics("mean").summary(array_to_vector("exact"))
    centres = found.groupBy("root").agg(mean.alias("m")).select("root", vector_to_array("m.mean").alias("centre"))
    centres = stage_table(centres, "centres")
    length = F.sqrt(F.aggregate("centre", F.lit(0.0), lambda t, x: t + x * x))
    # A mean of zero leaves everything outside.
    angle = F.when(length > 0, F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), _raw_dot("exact", "centre") / length))))
    half = math.acos(s.threshold) / 2 - ANGLE_SLACK
    placed = lookup(found, centres, ["root"], "inner").withColumn("inside", F.coalesce(angle <= half, F.lit(False)))
    placed = stage_table(placed.drop("centre"), "placed")
    core = placed.where("inside").groupBy("root").agg(F.sum("copies").alias("total"))
    core = lookup(stage_table(placed.where("inside").select("node", "root", "copies"), "core"), core, ["root"], "inner")
    core = core.select("node", (F.col("total") - F.col("copies")).alias("dense"))
    sizes = placed.groupBy("root").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("inside")).alias("outside")
    ).where("outside > 0")
    sizes = stage_table(sizes, "with_outside")
    cells = lookup(placed, sizes, ["root"], "inner")
    part = lambda n: F.pmod(F.xxhash64("node"), F.ceil(F.col(n) / s.block)).cast("int")
    outside = cells.where("not inside").withColumn("fb", part("outside")).groupBy("root", "fb").agg(
        F.collect_list(F.struct("node", "copies", "exact")).alias("outer")
    )
    members = cells.withColumn("cb", part("n")).groupBy("root", "cb").agg(
        F.collect_list(F.struct("node", "copies", "exact", "inside")).alias("members"),
        F.first("outside").alias("outside"),
    )
    last = F.ceil(F.col("outside") / s.block).cast("int") - 1
    members = members.withColumn("fb", F.explode(F.sequence(F.lit(0), last))).drop("outside")
    blocks = outside.join(members, ["root", "fb"]).repartition("root", "fb", "cb")
    far = blocks.select("outer", "members").mapInArrow(_block_counts(s.threshold), "node long, dense long")
    return core.unionByName(far).groupBy("node").agg(F.sum("dense").alias("dense"))


def _raw_dot(a: str, b: str):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)


def _block_counts(threshold: float):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for outer, members in pylists(batch):
                a, b = (np.array([x["node"] for x in side]) for side in (outer, members))
                x, y = (np.array([r["exact"] for r in side]) for side in (outer, members))
                linked = (x @ y.T >= threshold) & (a[:, None] != b[None, :])
                to_outer = linked @ np.array([r["copies"] for r in members])
                inside = np.array([r["inside"] for r in members])
                to_core = np.array([r["copies"] for r in outer]) @ linked
                yield pa.RecordBatch.from_pydict(
                    {"node": np.r_[a, b[inside]], "dense": np.r_[to_outer, to_core[inside]].astype(np.int64)}
                )

    return count


def link_counts(lists: DataFrame, nodes: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """Staged links (u > v) of the lists, and per node the number of vectors linked to it."""
    links = exact_links(lists, nodes, s)
    full = lists.where(F.col("s") >= s.threshold - ROUNDING).groupBy("u").agg(F.count(F.lit(1)).alias("n"))
    full = full.where(F.col("n") >= s.enlarged).select(F.col("u").alias("node"))
    dense = stage_table(nodes.join(full, "node").select("node", "copies", "d", "exact"), "saturated")
    marks = dense.select(F.col("node"), F.lit(True).alias("is_dense"))
    own = nodes.select("node", "copies").join(marks, "node", "left")
    at = lambda end: own.select(
        F.col("node").alias(end), F.col("copies").alias(f"c{end}"), F.col("is_dense").alias(f"d{end}")
    )
    ends = links.join(at("u"), "u").join(at("v"), "v")
    ends = ends.where(~(F.coalesce("du", F.lit(False)) & F.coalesce("dv", F.lit(False))))
    listed = ends.select(F.col("u").alias("node"), F.col("cv").alias("n")).unionByName(
        ends.select(F.col("v").alias("node"), F.col("cu").alias("n"))
    )
    counted = dense_counts(dense, links, s).select("node", F.col("dense").alias("n"))
    copies = nodes.select("node", (F.col("copies") - 1).alias("n"))
    counts = listed.unionByName(counted).unionByName(copies)
    return links, stage_table(counts.groupBy("node").agg(F.sum("n").alias("n_links")), "link_counts")


# --- audit ----------------------------------------------------------------------


def audit(nodes: DataFrame, counts: DataFrame, s: Settings) -> float:
    """Share of the true links of up to ``audited`` sampled vectors that were found.

    The sampled vectors (smallest hashes) go to every task; true links are counted
    there against all rows.
    """
    sample = nodes.orderBy(F.xxhash64("key"), "node").limit(s.audited).select("node", "d", "exact").collect()
    threshold = s.threshold
    queries: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for d in {r.d for r in sample}:
        own = [r for r in sample if r.d == d]
        queries[d] = np.array([r.node for r in own]), np.array([r.exact for r in own])
    shared = nodes.sparkSession.sparkContext.broadcast(queries)  # bounded by ``audited``

    def against(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("d").to_numpy()
            for d in np.unique(sizes).tolist():
                if d not in shared.value:
                    continue
                ids, wanted = shared.value[d]
                part = batch.take(pa.array(np.flatnonzero(sizes == d)))
                x = part.column("exact").flatten().to_numpy().reshape(-1, d)
                linked = wanted @ x.T >= threshold
                n = linked @ part.column("copies").to_numpy()
                yield pa.RecordBatch.from_pydict({"node": ids[n > 0], "n": n[n > 0].astype(np.int64)})

    true = nodes.select("d", "copies", "exact").mapInArrow(against, "node long, n long")
    true = true.groupBy("node").agg((F.sum("n") - 1).alias("true"))  # without itself
    found, all_links = true.join(counts, "node").agg(F.sum("n_links"), F.sum("true")).first()
    return float(found) / all_links if all_links else 1.0


# --- operator -------------------------------------------------------------------


def near_duplicates(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", settings: Settings = Settings()
) -> DataFrame:
    """One row per input row: id, n_links, component_id, kept and the audited recall.

    Vectors of cosine at least the threshold are linked; ``component_id`` is the
    smallest id reachable and ``kept`` marks the row that has it.  Equal vectors
    are one node with its number of copies.  Vectors that are null, empty, zero or
    hold null or non-finite entries, and vectors of different length, are not
    linked.  Rows without an id are linked and counted but give no component its
    id unless it has no other; repeated rows give repeated results and count as
    copies; other columns are ignored; an empty table gives an empty result.
    """
    s = settings
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = stage_table(rows.mapInArrow(_unit_rows, VECTOR_DDL), "unit_vectors")
    nodes = nodes_of(rows)
    lists, recall = None, 0.0
    for search in range(s.searches):
        lists = descend(nodes, lists, s, search)
        links, counts = link_counts(lists, nodes, s)
        recall = audit(nodes, counts, s)
        if recall >= s.recall:
            break
    roots = nodes.select("node", "key", "least").join(components(links), "node", "left")
    roots = roots.withColumn("root", F.coalesce("root", "node")).join(counts, "node")
    roots = stage_table(roots.drop("node"), "roots")
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    found = lookup(roots, least, ["root"], "inner").select("key", "n_links", "component_id")
    plain = rows.where("key is not null").select("id", "key")
    linked = lookup(stage_table(plain, "keys"), stage_table(found, "found"), ["key"], "inner")
    alone = rows.where("key is null").select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")
    )
    out = linked.select("id", "n_links", "component_id").unionByName(alone)
    kept = F.col("id").eqNullSafe(F.col("component_id"))
    return out.select(
        F.col("id").alias(id_col), "n_links", "component_id", kept.alias("kept"), F.lit(recall).alias("audited_recall")
    )
