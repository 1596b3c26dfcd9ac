"""SimHash near-duplicates, candidates by pigeonring filtering.

Two 64-bit fingerprints within 4 bits, cut into 5 segments on a ring, have a
segment from which every chain of l segments differs in at most 4*l/5 bits:
0, 1, 2, 3 and 4 bits for chains of one to five.  So a link shows as equal
values of some segment, with at most one differing bit in the next.  Both
segments together are the join key: one side gives its own value, the other
also the values with one of its zero bits set, which finds a pair that differs
there exactly once.  The whole chain is tested before the full distance.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthscore.llm.common import ASCII_LOWER, fresh, hex64, lookup
from hearthscore.llm.components import components
from hearthscore.llm.exact_dedup import maybe_repeated, member_filter
from hearthscore.session import stage_table

SHINGLE_WORDS = 4
MAX_DISTANCE = 4
SEED = 42
WIDTHS = (13, 13, 13, 13, 12)  # MAX_DISTANCE + 1 segments: the first of a chain is equal
STARTS = tuple(sum(WIDTHS[:i]) for i in range(len(WIDTHS)))
VOTE_ROWS = 1 << 16  # shingles whose bits are counted at once


def fingerprint(text: bytes | None) -> int:
    """Unsigned 64-bit SimHash of the 4-word shingles of a UTF-8 text.

    A-Z are lowered; words are runs of bytes other than ASCII white space.
    Fewer than four words make one shingle; none, or null, gives zero.
    """
    words = text.translate(ASCII_LOWER).split() if text else []
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    n = max(1, len(words) - SHINGLE_WORDS + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    first = np.concatenate(([0], ends))[:n].tolist()
    last = (ends[-n:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for at in range(0, n, VOTE_ROWS):
        spans = zip(first[at : at + VOTE_ROWS], last[at : at + VOTE_ROWS])
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


@F.arrow_udf(T.LongType())
def _fingerprints(texts: pa.Array) -> pa.Array:
    marks = np.array([fingerprint(t.as_py()) for t in texts], dtype=np.uint64)
    return pa.array(marks.view(np.int64))


def with_fingerprint(df: DataFrame, text_col: str, out: str) -> DataFrame:
    return df.withColumn(out, _fingerprints(F.col(text_col).cast("binary")))


def _segment(fp: Column, i: int) -> Column:
    mask = F.lit((1 << WIDTHS[i]) - 1)
    return F.shiftrightunsigned(fp, STARTS[i]).bitwiseAND(mask)


def _chains_hold(xor: Column, start: int) -> Column:
    """Every chain from ``start`` keeps its share of the allowed distance."""
    cond, total, m = F.lit(True), F.lit(0), len(WIDTHS)
    for length in range(1, m + 1):
        total = total + F.bit_count(_segment(xor, (start + length - 1) % m))
        cond = cond & (total <= MAX_DISTANCE * length // m)
    return cond


def _keys(fp: Column, i: int) -> tuple[Column, Column]:
    """The pair of segments i, i+1 as a key, and the same with one zero bit set."""
    m = len(WIDTHS)
    after = (i + 1) % m
    low = _segment(fp, after)
    base = F.shiftleft(_segment(fp, i), 16).bitwiseOR(low)
    flips = F.array(*[F.lit(1 << b) for b in range(WIDTHS[after])])
    zero = F.filter(flips, lambda bit: low.bitwiseAND(bit) == 0)
    return base, F.transform(zero, lambda bit: base.bitwiseOR(bit))


def _tagger(tag: Column):
    # A second parameter of a lambda would be taken for the element's index.
    return lambda key: key.bitwiseOR(tag)


def links(marks: DataFrame) -> DataFrame:
    """Pairs ``u``, ``v`` of distinct fingerprints (column ``fp``) within 4 bits."""
    m, fp = len(WIDTHS), F.col("fp")
    own, probes = [], []
    for i in range(m):
        base, near = _keys(fp, i)
        tagged = F.lit(i << 32)
        own.append(F.struct(base.bitwiseOR(tagged).alias("k"), F.lit(i).alias("start")))
        keys = F.concat(F.array(base), near)
        probes.append(F.transform(keys, _tagger(tagged)))
    left = marks.select(fp.alias("u"), F.explode(F.array(*own)).alias("o"))
    left = left.select("u", "o.k", "o.start")
    right = marks.select(fp.alias("v"), F.explode(F.concat(*probes)).alias("k"))
    xor = F.col("u").bitwiseXOR(F.col("v"))
    passes = F.lit(False)
    for i in range(m):
        passes = passes | ((F.col("start") == i) & _chains_hold(xor, i))
    near = F.bit_count(xor) <= MAX_DISTANCE
    # Spark sizes an exploded table as one row per fingerprint and would broadcast it far too late.
    right = right.hint("merge")
    pairs = left.join(right, (left["k"] == right["k"]) & (F.col("u") != F.col("v")) & passes & near)
    return pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _classes(rows: DataFrame) -> DataFrame:
    """Each fingerprint of staged ``id``, ``fp`` with its component's root and least id."""
    marks = stage_table(rows.groupBy("fp").agg(F.min("id").alias("least")), "fingerprints")
    found = components(links(marks))
    roots = marks.join(found, marks["fp"] == found["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    roots = stage_table(roots, "roots")
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    return stage_table(lookup(roots.select("fp", "root"), least, ["root"], "inner"), "classes")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, fingerprint (hex) and component_id.

    Fingerprints within 4 bits are linked and ``component_id`` is the smallest
    id reachable over links.  Null and empty texts share fingerprint zero; null
    ids never become a component id unless a component has no other.  Repeated
    rows give repeated results; other columns are ignored; an empty table gives
    an empty result.
    """
    rows = df.select(F.col(id_col).alias("id"), text_col)
    rows = with_fingerprint(rows, text_col, "fp").select("id", "fp")
    rows = stage_table(rows, "simhash")
    out = lookup(rows, _classes(rows), ["fp"], "inner")
    return out.select(F.col("id").alias(id_col), hex64(F.col("fp")).alias("fingerprint"), "component_id")


def roots_of(prints: DataFrame) -> DataFrame:
    """Staged ``fp``, ``root`` of the fingerprints (staged column ``fp``) that have a link."""
    marks = stage_table(prints.select("fp").distinct(), "fingerprints")
    return stage_table(components(links(marks)).withColumnRenamed("node", "fp"), "fp_roots")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` left when one row of each group of linked fingerprints stays.

    The row with the smallest id stays, the smallest text hash among rows of
    one id; rows equal in id and text count as one row.  Null and empty texts
    share fingerprint zero; a row without an id stays only if its group has no
    other.  Rows that a filter of the dropped and repeated ones clears pass
    without a shuffle.  Other columns pass unchanged, whatever their names; an
    empty table gives an empty result.
    """
    text_hash = F.xxhash64(F.col(text_col))
    rows = df.select(F.col(id_col).alias("id"), text_hash.alias("th"), text_col)
    rows = with_fingerprint(rows, text_col, "fp").select("id", "th", "fp")
    units = stage_table(rows.groupBy("id", "th", "fp").agg(F.count(F.lit(1)).alias("n")), "simhash")
    rooted = lookup(units, roots_of(units), ["fp"], "left").withColumn("root", F.coalesce("root", "fp"))
    row = F.struct(F.col("id").isNull().alias("none"), "id", "th")
    rooted = stage_table(rooted.select("id", "th", "n", "root", row.alias("row")), "classed")
    best = rooted.groupBy("root").agg(F.min("row").alias("best"), F.count(F.lit(1)).alias("size"))
    # A group of one row without repeats needs no decision.
    judged = lookup(rooted, best.where("size > 1"), ["root"], "left")
    stays = F.col("best").isNull() | F.col("row").eqNullSafe(F.col("best"))
    key = F.xxhash64(F.lit(0), "id", "th").alias("key")
    out = judged.select("id", "th", "n", stays.alias("stays"), key).where("not stays or n > 1")
    out = stage_table(out, "not_single")
    bitmaps, bits = member_filter(out, "key")
    tag, probe, flag = fresh(df, "_th", "_key", "_maybe")
    tagged = df.withColumn(tag, text_hash)
    tagged = tagged.withColumn(probe, F.xxhash64(F.lit(0), F.col(id_col), F.col(tag)))
    tagged = maybe_repeated(tagged, probe, bitmaps, bits, flag)
    unsure = tagged.where(F.col(flag))
    match = unsure[id_col].eqNullSafe(out["id"]) & (unsure[tag] == out["th"])
    single = unsure.join(out, match, "left_anti")
    again = unsure.join(out.where("stays"), match, "left_semi").dropDuplicates([id_col, tag])
    return tagged.where(~F.col(flag)).unionByName(single).unionByName(again).drop(tag, probe, flag)
