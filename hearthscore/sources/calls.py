"""Readers and writers for the raw call table and the stage tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthscore.sources.records import multiline_records

MONEY = "decimal(18,2)"

# Types of the columns that are not text.  ZIP stays text (leading zeros).
RAW_TYPES = {
    "household_key": "bigint",
    "length_of_residence": "double",
    "member_tenure_years": "double",
    "sc_date": "timestamp_ntz",
    "total_cost": MONEY,
    **{f"ers_ent_count_year_{i}": "double" for i in (1, 2, 3)},
    **{f"ers_member_cost_year_{i}": MONEY for i in (1, 2, 3)},
}
INDEX_COLUMNS = ("unnamed_0", "c0")


def column_name(header: str) -> str:
    """``Member Key`` -> ``member_key``; dots and blanks become underscores."""
    return re.sub(r"[^0-9a-z]+", "_", header.lower()).strip("_")


def _texts(spark: SparkSession, path: str, multiline: bool) -> tuple[DataFrame, dict[str, str]]:
    """Unparsed columns, with the place of each row in its file, and the header of each column."""
    raw = spark.read.option("header", True).option("escape", '"').csv(path)
    headers = {column_name(h): h for h in raw.columns if column_name(h) not in INDEX_COLUMNS}
    records = multiline_records(spark, path) if multiline else None
    if records is None:
        place = [
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("row"),
        ]
        return raw.withColumn("_place", F.struct(*place)), headers
    names = ["`" + h.replace("`", "``") + "` string" for h in raw.columns]
    parsed = F.from_csv("text", ", ".join(names), {"escape": '"'}).alias("_record")
    records = records.select(parsed, F.struct("file", "split", "row").alias("_place"))
    return records.select("_record.*", "_place"), headers


def _text_of(name: str, header: str) -> Column:
    col = F.col("`" + header.replace("`", "``") + "`")
    # a key column once held as float
    return F.regexp_replace(col, r"\.0+$", "") if name == "household_key" else col


def scan_csv(
    spark: SparkSession, path: str, file_order: bool = True, multiline: bool = True
) -> DataFrame:
    """Read the raw CSV with explicit types, without its unnamed index column.

    ``file_order`` adds (file, split start, row within split): the order of rows
    in the file, known without a shuffle.  Only the columns a query uses are
    parsed, because the scan is text and the casts sit above it.  ``multiline``
    looks for line breaks inside quotes first, which costs a pass over the text;
    files without any are then read by lines.  Text that is not of its column's
    type becomes null; :func:`unparsable` counts it.
    """
    raw, headers = _texts(spark, path, multiline)
    picked = []
    for name, header in headers.items():
        col = _text_of(name, header)
        if name in RAW_TYPES:
            col = col.try_cast(RAW_TYPES[name])
        picked.append(col.alias(name))
    if file_order:
        picked.append(F.col("_place").alias("file_order"))
    return raw.select(*picked)


def unparsable(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Per typed column, the values of the CSV that are there but not of the type; one aggregate."""
    raw, headers = _texts(spark, path, multiline)
    typed = {n: _text_of(n, h) for n, h in headers.items() if n in RAW_TYPES}
    lost = raw.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(c.isNotNull() & c.try_cast(RAW_TYPES[n]).isNull()).alias(n) for n, c in typed.items()],
    )
    return lost.unpivot(["_n"], list(typed), "column_name", "unparsable").drop("_n")


def write_csv(df: DataFrame, path: str, compressed: bool = False) -> None:
    """Values keep their outer blanks and line breaks; quotes inside are doubled, as the scan reads them.

    ``compressed`` writes gzip files: a fraction of the text's size, each read by one
    task, so the scan has as many tasks as the writer had.
    """
    writer = df.write.option("header", True).option("escape", '"')
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    if compressed:
        writer = writer.options(**{"compression": "gzip", "zlib.compress.level": "BEST_SPEED"})
    writer.options(**blanks).csv(path)


def scan_parquet(spark: SparkSession, path: str, columns=None, where=None) -> DataFrame:
    """Stage reader; the filter and the column list reach the Parquet scan."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.filter(where)
    return df.select(*columns) if columns else df


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
