"""Filter interaction audit: what each filter removes under every order of filters.

Every text becomes a mask of the filters it fails, and the masks are counted per
part: at most 32 cells, however large the part.  A recursive query then extends
filter prefixes by unused letters, joins the cells and carries the bits applied
so far; each level emits the counts of its step.  Texts are read once, and no
order of filters touches a document again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthscore.llm.common import UPPER, batch_of, lookup
from hearthscore.session import stage_table

# The filters and their bits; a text fails a filter if
FILTERS = {
    "A": 1,  # it has under 200 words,
    "B": 2,  # under half of its words are distinct,
    "C": 4,  # over 2 of 100 code points are A-Z,
    "D": 8,  # it holds one of the symbols,
    "E": 16,  # it equals the text of a smaller id.
}
MIN_WORDS, MIN_DISTINCT_PCT, MAX_UPPER_PCT, SYMBOLS = 200, 50, 2, b"#$%&*|"

FLAGS = pa.schema(
    [("id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("digest", pa.binary())]
)
FLAGS_DDL = "id long, part string, mask int, digest binary"


def own_mask(text: bytes, n_chars: int) -> int:
    """Bits of the filters A to D that a UTF-8 text of ``n_chars`` code points fails."""
    words = text.split()
    n_upper = len(text) - len(text.translate(None, UPPER.encode()))
    failed = {
        "A": len(words) < MIN_WORDS,
        "B": 100 * len(set(words)) < MIN_DISTINCT_PCT * len(words),
        "C": 100 * n_upper > MAX_UPPER_PCT * n_chars,
        "D": len(text.translate(None, SYMBOLS)) < len(text),
    }
    return sum(FILTERS[f] for f, fails in failed.items() if fails)


def _flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc, part, text = batch.columns
        sizes = pc.utf8_length(text).to_pylist()
        rows = []
        for i, p, t, n in zip(doc.to_pylist(), part.to_pylist(), text.cast(pa.binary()), sizes):
            t = t.as_py()
            rows.append((i, p, own_mask(t, n), hashlib.sha256(t).digest()))
        yield batch_of(FLAGS, rows)


def mask_cells(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source"
) -> DataFrame:
    """Staged: per part and mask of failed filters the documents n, good and toxic.

    Rows equal in id, part and mask combine in the map tasks before any join; the
    texts themselves never shuffle, only their digests do.
    """
    rows = df.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    rows = stage_table(rows.mapInArrow(_flags, FLAGS_DDL), "filter_flags")
    first = rows.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
    first = stage_table(first.where("copies > 1").drop("copies"), "first_copies")
    rows = lookup(rows, first, ["digest"], "left")
    copied = F.when(F.col("id") > F.col("first"), FILTERS["E"]).otherwise(0)
    units = rows.groupBy("id", "part", F.col("mask").bitwiseOR(copied).alias("mask")).agg(
        F.count(F.lit(1)).alias("n")
    )
    is_one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("long"))
    known = labels.groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        is_one("quality").alias("good"), is_one("toxic").alias("toxic")
    )
    counted = [F.sum("n").alias("n")] + [
        F.sum(F.col("n") * F.coalesce(F.col(c), F.lit(0))).alias(c) for c in ("good", "toxic")
    ]
    cells = units.join(known, "id", "left").groupBy("part", "mask").agg(*counted)
    return stage_table(cells, "mask_cells")


_BITS = ", ".join(f"('{letter}', {bit})" for letter, bit in FILTERS.items())
_HIT = "c.mask & w.applied = 0 and c.mask & f.bit <> 0"


def _total(condition: str, value: str = "c.n") -> str:
    return f"aggregate(k.cells, 0L, (t, c) -> t + if({condition}, {value}, 0L))"


# Each level extends every prefix by every unused letter.
WALK = f"""
with recursive walk(part, prefix, applied, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost) as (
  select part, '', 0, 0, 0L, 0L, 0L, 0L, 0L, 0L from {{parts}}
  union all
  select w.part, concat(w.prefix, f.letter), w.applied | f.bit, w.step + 1,
         {_total("c.mask & (w.applied | f.bit) = 0")},
         {_total(_HIT)},
         {_total("c.mask & w.applied <> 0 and c.mask & f.bit <> 0")},
         {_total("c.mask = f.bit")},
         {_total(_HIT, "c.good")},
         {_total(_HIT, "c.toxic")}
  from walk w
  join (values {_BITS}) as f(letter, bit) on w.applied & f.bit = 0
  join {{parts}} k on k.part = w.part
)
select * from walk where step > 0
"""
METRICS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def audit(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """One row per part, filter_order and step, with that step's document counts.

    Null texts are empty and null parts the empty string; rows without an id are
    never copies and have no label, but their texts count.  Repeated rows count
    each; of several labels of an id one with 1 is enough.  Very long texts are
    read whole; other columns of ``df`` and ``labels`` are ignored; an empty
    table gives an empty result.
    """
    spark = df.sparkSession
    cells = mask_cells(df, labels, id_col, text_col, part_col)
    # At most 32 cells a part, so the list is bounded.
    parts = cells.groupBy("part").agg(
        F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")
    )
    parts = stage_table(parts, "parts")
    # The depth is five; the rows grow with the parts, which is no runaway query.
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    walk = stage_table(spark.sql(WALK, parts=parts), "prefixes")
    full = len(FILTERS)
    orders = walk.where(F.col("step") == full).select(
        "part",
        F.col("prefix").alias("filter_order"),
        F.explode(F.sequence(F.lit(1), F.lit(full))).alias("step"),
    )
    orders = orders.withColumn("prefix", F.expr("substring(filter_order, 1, step)"))
    out = orders.join(walk.drop("step", "applied"), ["part", "prefix"])
    letter = F.expr("substring(filter_order, step, 1)")
    shares = out.groupBy("part", letter.alias("letter")).agg(F.sum("removed").alias("shapley"))
    out = out.withColumn("letter", letter).join(shares, ["part", "letter"])
    return out.select("part", "filter_order", "step", *METRICS, "shapley")
