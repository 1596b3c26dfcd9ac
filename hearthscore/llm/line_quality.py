"""Quality rules: per-text measures and lines that many documents of a host share.

Normalised lines are hashed; for each (host, line) the distinct documents are
counted and lines above the limits go.  Copies must not make their own content
look like boilerplate, so documents whose SimHash fingerprints are linked, equal
texts included, count once, as one document of their host.  A document that
little is left of is rejected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthscore.llm.common import ASCII_LOWER, batch_of, fresh, lookup, pylists
from hearthscore.llm.exact_dedup import maybe_repeated, member_filter
from hearthscore.llm.simhash import fingerprint, roots_of
from hearthscore.session import stage_table

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"


@dataclass(frozen=True)
class LineSettings:
    min_words: int = 50
    max_repeat_pct: int = 50  # words in repeated 3-word windows, of all words
    min_docs: int = 20  # a removed line is in more documents of its host than this,
    min_doc_pct: int = 2  # and in more than this share of them; linked copies count once
    min_left_pct: int = 30  # a document keeps at least this share of its words


def line_hash(line: bytes) -> int | None:
    """Signed 64-bit hash of a line, A-Z lowered and blanks collapsed; None if blank."""
    words = line.translate(ASCII_LOWER).split()
    if not words:
        return None
    return int.from_bytes(hashlib.md5(b" ".join(words)).digest()[:8], "big", signed=True)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found at least twice."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    pairs = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)[1]
    windows = pairs[:-1] * len(known) + ids[2:]
    _, at, times = np.unique(windows, return_inverse=True, return_counts=True)
    twice = times[at] > 1
    covered = np.zeros(n, dtype=bool)
    for shift in range(3):
        covered[shift : shift + n - 2] |= twice
    return int(covered.sum())


def measures(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a UTF-8 text."""
    words = text.split()
    chars = len(text.decode()) - sum(text.count(bytes([c])) for c in SPACES)
    symbols = sum(text.count(bytes([c])) for c in SYMBOLS)
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


PROFILE = pa.schema(
    [
        ("id", pa.int64()),
        ("host", pa.string()),
        ("text_key", pa.int64()),
        ("fp", pa.int64()),
        *[(c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        ("lines", pa.list_(pa.struct([("h", pa.int64()), ("w", pa.int32())]))),
    ]
)
PROFILE_DDL = (
    "id long, host string, text_key long, fp long, n_words long, word_chars long, n_symbols long,"
    " n_dup_lines long, n_repeat_words long, lines array<struct<h:long,w:int>>"
)


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, host, key, text in pylists(batch):
            text = text or b""
            words: dict[int, int] = {}
            for line in text.split(b"\n"):
                h = line_hash(line)
                if h is not None:
                    words[h] = words.get(h, 0) + len(line.split())
            lines = [{"h": h, "w": w} for h, w in sorted(words.items())]
            fp = fingerprint(text)
            fp -= (fp >> 63) << 64  # as a long
            rows.append((doc, host, key, fp, *measures(text), lines))
        yield batch_of(PROFILE, rows)


def profiles(df: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """Staged: per row its measures and its distinct lines (hash, words), sorted by hash."""
    rows = df.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"),
        F.col(text_col).cast("binary").alias("text"),
    )
    return stage_table(rows.mapInArrow(_profile, PROFILE_DDL), "profiles")


def shared_lines(rows: DataFrame, s: LineSettings) -> tuple[DataFrame, DataFrame]:
    """Staged: places (host, text_key, h, w) of lines in many rows, and the frequent lines (host, h).

    ``rows`` are the staged profiles.  A line counts once for each group of linked
    fingerprints of its host.  Every count combines in the map tasks before it
    shuffles, so neither a hot host nor a line found everywhere lands in one task.
    """
    lines = rows.select("host", "text_key", "fp", F.explode("lines").alias("l"))
    lines = lines.select("host", "text_key", "fp", F.col("l.h").alias("h"), F.col("l.w").alias("w"))
    lines = stage_table(lines, "lines")
    common = lines.groupBy("host", "h").agg(F.count(F.lit(1)).alias("n"))
    common = stage_table(common.where(F.col("n") > s.min_docs).select("host", "h"), "common_lines")
    places = lookup(lines, common, ["host", "h"], "inner").distinct()
    places = stage_table(places, "places")
    roots = roots_of(rows)

    def documents(df: DataFrame, *keys: str) -> DataFrame:
        found = lookup(stage_table(df.distinct(), "prints"), roots, ["fp"], "left")
        found = found.select(*keys, F.coalesce("root", "fp").alias("root")).distinct()
        return found.groupBy(*keys).agg(F.count(F.lit(1)).alias("docs"))

    hosts = documents(rows.select("host", "fp"), "host").withColumnRenamed("docs", "host_docs")
    counted = documents(places.select("host", "h", "fp"), "host", "h")
    counted = stage_table(counted.where(F.col("docs") > s.min_docs), "counted_lines")
    above = F.col("docs") * 100 > F.col("host_docs") * s.min_doc_pct
    frequent = lookup(counted, hosts, ["host"], "inner").where(above).select("host", "h")
    return places.drop("fp"), stage_table(frequent, "frequent_lines")


def judge(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    settings: LineSettings = LineSettings(),
) -> DataFrame:
    """One staged row per input row: the measures, base_failed, removed words and lines, kept.

    Columns: id, host, text_key, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, n_removed_words, removed (line hashes, null if
    none) and kept.  Null texts have no words and fail the base rules; null
    hosts form one host; null and repeated ids are judged like others; other
    columns are ignored; an empty table gives an empty result.
    """
    s = settings
    rows = profiles(df, id_col, text_col, host_col)
    places, frequent = shared_lines(rows, s)
    removed = lookup(places, frequent, ["host", "h"], "inner").groupBy("host", "text_key").agg(
        F.sum("w").alias("n_removed_words"), F.sort_array(F.collect_list("h")).alias("removed")
    )
    removed = stage_table(removed, "removed")
    joined = lookup(rows.drop("lines", "fp"), removed, ["host", "text_key"], "left")
    gone = F.coalesce(F.col("n_removed_words"), F.lit(0)).cast("long")
    repeats = F.col("n_repeat_words") * 100 > F.col("n_words") * s.max_repeat_pct
    left = (F.col("n_words") - gone) * 100 >= F.col("n_words") * s.min_left_pct
    out = joined.withColumn("n_removed_words", gone)
    out = out.withColumn("base_failed", (F.col("n_words") < s.min_words) | repeats)
    return stage_table(out.withColumn("kept", ~F.col("base_failed") & left), "judged")


@F.arrow_udf(T.StringType())
def _without_lines(texts: pa.Array, removed: pa.Array) -> pa.Array:
    out = []
    for text, gone in zip(texts.to_pylist(), removed.to_pylist()):
        gone = set(gone)
        out.append("\n".join(x for x in text.split("\n") if line_hash(x.encode()) not in gone))
    return pa.array(out, pa.string())


def filter_documents(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    length_col: str = "n_chars",
    settings: LineSettings = LineSettings(),
) -> DataFrame:
    """The rows that :func:`judge` keeps, without their frequent lines, all columns.

    ``length_col`` is set to the new length where lines went.  Only rejected rows
    and rows that lose lines shuffle: a filter of their keys lets the others pass
    where they lie.  Nulls, repeated rows and empty tables as in :func:`judge`;
    other columns pass unchanged, whatever their names.
    """
    judged = judge(df, id_col, text_col, host_col, settings)
    judged = judged.where(~F.col("kept") | F.col("removed").isNotNull()).dropDuplicates(["id", "host", "text_key"])
    names = ("_host", "_key", "_probe", "_maybe", "_id", "_in_host", "_text_key", "_kept", "_removed")
    host, key, probe, flag, *found, kept, gone = fresh(df, *names)
    judged = judged.select(
        *[F.col(c).alias(a) for c, a in zip(("id", "host", "text_key"), found)],
        F.col("kept").alias(kept),
        F.col("removed").alias(gone),
    )
    of = lambda *c: F.xxhash64(F.lit(0), *c)
    judged = stage_table(judged.withColumn(probe, of(*found)), "touched")
    bitmaps, bits = member_filter(judged, probe)
    judged = judged.drop(probe)
    hosts = F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias(host)
    tagged = df.select("*", hosts, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias(key))
    tagged = tagged.withColumn(probe, of(F.col(id_col).cast("long"), host, key))
    tagged = maybe_repeated(tagged, probe, bitmaps, bits, flag)
    whole = tagged.where(~F.col(flag)).select(*df.columns)
    of_row = F.col(id_col).cast("long").eqNullSafe(F.col(found[0]))
    of_row = of_row & (F.col(host) == F.col(found[1])) & (F.col(key) == F.col(found[2]))
    judged_rows = tagged.where(F.col(flag)).join(judged, of_row, "left").where(F.coalesce(F.col(kept), F.lit(True)))
    same = judged_rows.where(F.col(gone).isNull()).select(*df.columns)
    part = judged_rows.where(F.col(gone).isNotNull())
    part = part.withColumn(text_col, _without_lines(F.col(text_col), F.col(gone)))
    part = part.withColumn(length_col, F.char_length(text_col).cast(df.schema[length_col].dataType))
    return whole.unionByName(same).unionByName(part.select(*df.columns))
