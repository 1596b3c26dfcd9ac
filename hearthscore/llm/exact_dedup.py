"""Exact duplicates by two-pass Bloom filtering, in DataFrame operations only.

Pass one maps every text to a few slots of a bit array and keeps the slots that
were hit twice; pass two probes each row's slots.  A row with a slot hit only
once is unique for certain and passes straight through; only the possibly
repeated rows shuffle, and an exact grouping by SHA-256 decides among them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthscore.llm.common import ascii_lower, fresh, lookup
from hearthscore.session import stage_table

HASHES = 2
BITS_PER_ROW = 16
# The filter is broadcast: 2**30 bits are 128 MB.  Beyond 67 million rows more
# unique rows take the exact path, smoothly; the result stays the same.
MAX_FILTER_BITS = 2**30
MAP_BITS = 32768  # bits of one bitmap of bitmap_construct_agg


def text_digest(text: Column) -> Column:
    """SHA-256 of the text with A-Z lowered, null as empty, in hex."""
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))), 256)


def _slots(digest: Column, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(digest, F.lit(k)), F.lit(bits)) for k in range(hashes)]


def repeat_filter(digests: DataFrame, digest: str, rows: int, hashes: int = HASHES):
    """Bitmaps of the slots hit at least twice, staged, and the filter's size in bits."""
    bits = _size(rows)
    hit = _hits(digests, digest, bits, hashes)
    twice = hit.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return stage_table(_bitmaps(twice), "repeat_filter"), bits


def member_filter(keys: DataFrame, key: str, hashes: int = HASHES):
    """Bitmaps of the slots of all ``keys`` (a staged table), staged, and the filter's size in bits."""
    bits = _size(keys.count())
    return stage_table(_bitmaps(_hits(keys, key, bits, hashes)), "member_filter"), bits


def _size(rows: int) -> int:
    bits = MAP_BITS
    while bits < rows * BITS_PER_ROW and bits < MAX_FILTER_BITS:
        bits *= 2
    return bits


def _hits(keys: DataFrame, key: str, bits: int, hashes: int) -> DataFrame:
    slots = F.array_distinct(F.array(*_slots(F.col(key), bits, hashes)))
    return keys.select(F.explode(slots).alias("slot"))


def _bitmaps(slots: DataFrame) -> DataFrame:
    return slots.groupBy(F.bitmap_bucket_number("slot").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("_map")
    )


def maybe_repeated(
    df: DataFrame, digest: str, bitmaps: DataFrame, bits: int, flag: str, hashes: int = HASHES
) -> DataFrame:
    """Add ``flag``: false only if the filter certainly does not hold the digest."""
    found = F.lit(True)
    for k, slot in enumerate(_slots(F.col(digest), bits, hashes)):
        maps = bitmaps.select(
            F.col("_bucket").alias(f"_bucket{k}"), F.col("_map").alias(f"_map{k}")
        )
        df = df.withColumn(f"_slot{k}", slot)
        at = F.bitmap_bucket_number(F.col(f"_slot{k}"))
        df = df.join(F.broadcast(maps), at == F.col(f"_bucket{k}"), "left")
        place = F.bitmap_bit_position(F.col(f"_slot{k}")).cast("int")
        byte = F.substring(F.col(f"_map{k}"), (place / 8).cast("int") + 1, F.lit(1))
        value = F.conv(F.hex(byte), 16, 10).cast("int")
        power = F.element_at(F.array(*[F.lit(2**b) for b in range(8)]), place % 8 + 1)
        found = found & F.coalesce(value.bitwiseAND(power) != 0, F.lit(False))
    df = df.withColumn(flag, found)
    return df.drop(*[f"{c}{k}" for k in range(hashes) for c in ("_slot", "_bucket", "_map")])


class _Groups:
    """Digests of a table, its filter, and the groups among possible repeats."""

    def __init__(self, df: DataFrame, id_col: str, text_col: str):
        plain = df.select(F.col(id_col).alias("id"), text_digest(F.col(text_col)).alias("digest"))
        staged = stage_table(plain, "digests")
        self.bitmaps, self.bits = repeat_filter(staged, "digest", staged.count())
        flagged = maybe_repeated(staged, "digest", self.bitmaps, self.bits, "maybe")
        self.rest = flagged.where("not maybe")
        # Rows equal in id and text are counted, not carried, so that a third
        # of the table under one key adds up in the map tasks.
        units = (
            flagged.where("maybe")
            .withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(64)))
            .groupBy("digest", "id", "salt")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        self.units = stage_table(units, "repeat_units")
        self.groups = self.units.groupBy("digest").agg(
            F.max(F.struct("id", "salt")).alias("best"), F.sum("n").alias("group_size")
        )


def mark_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lowering A-Z; null counts as empty.
    Of equal texts the row with the largest id stays (a null id only when the
    group has no other); of rows equal in id and text exactly one stays.
    Columns other than the two named are ignored; an empty table gives none.
    """
    g = _Groups(df, id_col, text_col)
    once = g.rest.select(
        "id",
        F.col("id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
    joined = lookup(g.units, g.groups, ["digest"], "inner")
    copy = joined.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    best = F.col("best.id").eqNullSafe(F.col("id")) & (F.col("best.salt") == F.col("salt"))
    more = copy.select(
        "id",
        F.col("best.id").alias("keep_id"),
        "group_size",
        (best & (F.col("copy") == 1)).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
    return once.unionByName(more).withColumnRenamed("id", id_col)


def drop_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns.

    Rules as in :func:`mark_duplicates`.  Rows that the filter clears pass
    without a shuffle; of the rest only those whose (id, text) was chosen are
    grouped, so copies of a hot text are gone before any grouping.
    """
    g = _Groups(df, id_col, text_col)
    digest, flag, chosen_id, chosen = fresh(df, "_digest", "_maybe", "_chosen_id", "_chosen")
    rows = df.withColumn(digest, text_digest(F.col(text_col)))
    rows = maybe_repeated(rows, digest, g.bitmaps, g.bits, flag)
    winners = stage_table(
        g.groups.select(F.col("best.id").alias(chosen_id), F.col("digest").alias(chosen)), "winners"
    )
    match = F.col(digest) == F.col(chosen)
    match = match & F.col(id_col).eqNullSafe(F.col(chosen_id))
    again = rows.where(F.col(flag)).join(winners, match, "left_semi")
    again = again.dropDuplicates([digest, id_col])
    return rows.where(~F.col(flag)).unionByName(again).drop(digest, flag)
