"""CSV records with line breaks inside quotes, read split by split.

Whether a split starts inside a quoted value depends on all lines before it.  A
first pass gives per split what it does with either state at its start (one row a
split); composed in order, these rows tell the true state at every split's start,
so a second pass cuts the records of all splits independently.  Only what crosses
a split's border is grouped afterwards: at most two pieces a split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearthscore.session import stage_table

# Beyond so many splits (128 TB at the default split size) their states are joined, not broadcast.
MAX_BROADCAST_SPLITS = 1_000_000
WHOLE, BEGINS, GOES_ON = 0, 1, 2

SPLITS = pa.schema(
    [("file", pa.string()), ("split", pa.int64()), ("closed", pa.bool_()), ("open", pa.bool_()), ("broken", pa.bool_())]
)
PIECES = pa.schema(
    [("file", pa.string()), ("split", pa.int64()), ("row", pa.int64()), ("part", pa.int32()), ("text", pa.string())]
)


def ends_open(line: str, is_open: bool) -> bool:
    """Whether a line ends inside quotes, given whether it starts inside them.

    Quotes open only at the start of a field; two of them inside a quoted value
    are one character; elsewhere they are plain text.
    """
    at = 0 if is_open else -1
    if not is_open and line.startswith('"'):
        at = 1
    while True:
        if at < 0:
            at = line.find(',"')
            if at < 0:
                return False
            at += 2
        at = line.find('"', at)
        while at >= 0 and line.startswith('"', at + 1):
            at = line.find('"', at + 2)
        if at < 0:
            return True
        at = line.find(',"', at)
        if at < 0:
            return False
        at += 2


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """The batches cut where the file or the split changes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, split = (batch.column(c).dictionary_encode().indices.to_numpy() for c in ("file", "split"))
        changes = np.flatnonzero((np.diff(file) != 0) | (np.diff(split) != 0)) + 1
        ends = [0, *changes.tolist(), batch.num_rows]
        for a, b in zip(ends, ends[1:]):
            run = batch.slice(a, b - a)
            yield run.column("file")[0].as_py(), run.column("split")[0].as_py(), run


def _one(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _transfers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split: the state at its end for a closed and for an open start, and whether a
    closed start meets a record that goes on in the next line."""
    now, closed, opened, broken = None, False, True, False
    for file, split, run in _runs(batches):
        if (file, split) != now:
            if now:
                yield _one(SPLITS, [(*now, closed, opened, broken)])
            now, closed, opened, broken = (file, split), False, True, False
        lines = run.column("value")
        for line in lines.filter(pc.match_substring(lines, '"')).to_pylist():
            same = closed == opened
            closed = ends_open(line, closed)
            opened = closed if same else ends_open(line, opened)
            broken = broken or closed
    if now:
        yield _one(SPLITS, [(*now, closed, opened, broken)])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records that lie in one split, and the pieces of those that do not.  The first
    record of a file names its columns and is left out; so are blank lines."""
    now, is_open, part, first, held, header = None, False, WHOLE, 0, [], False
    rows: list[tuple] = []

    def take(whole: bool) -> None:
        nonlocal header
        text = "\n".join(held)
        if header:
            if len(held) > 1 or not whole:
                raise ValueError(f"the header of {now[0]} is longer than a line")
            header = not text.strip()
        elif part != WHOLE or not whole:
            rows.append((*now, first, part or BEGINS, text))
        elif len(held) > 1 or text.strip():
            rows.append((*now, first, WHOLE, text))
        held.clear()

    for file, split, run in _runs(batches):
        if (file, split) != now:
            if held:
                take(False)
            now, is_open, header = (file, split), run.column("is_open")[0].as_py(), split == 0
            part = GOES_ON if is_open else WHOLE
        lines = run.column("value")
        quoted = pc.match_substring(lines, '"').to_pylist()
        for row, line, has_quote in zip(run.column("row").to_pylist(), lines.to_pylist(), quoted):
            if not held:
                first = row
            held.append(line)
            if has_quote:
                is_open = ends_open(line, is_open)
            if not is_open:
                take(True)
                part = WHOLE
        if rows:
            yield _one(PIECES, rows)
            rows.clear()
    if held:
        take(False)
    if rows:
        yield _one(PIECES, rows)


def _states(lines: DataFrame) -> DataFrame:
    """``file``, ``split``, ``is_open`` (at the split's start), ``ends`` (open at its end), ``broken``.

    A split either keeps the state, swaps it or sets it.  So the state before a
    split is the last one set, swapped as often as swaps follow.
    """
    schema = "file string, split long, closed boolean, open boolean, broken boolean"
    splits = stage_table(lines.drop("row").mapInArrow(_transfers, schema), "splits")
    upto = Window.partitionBy("file").orderBy("split")
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.sum((F.col("closed") & ~F.col("open")).cast("long")).over(upto)
    fixed = F.when(F.col("closed") == F.col("open"), F.struct(F.col("closed").alias("state"), "swaps"))
    found = splits.withColumn("swaps", swaps).withColumn("fixed", fixed)
    found = found.withColumns({"last": F.last("fixed", True).over(before), "n": F.last("swaps").over(before)})
    since = F.coalesce("n", F.lit(0)) - F.coalesce("last.swaps", F.lit(0))
    is_open = F.coalesce("last.state", F.lit(False)) != (since % 2 == 1)
    found = found.withColumn("is_open", is_open)
    ends = F.when(F.col("is_open"), F.col("open")).otherwise(F.col("closed"))
    return stage_table(found.select("file", "split", "is_open", ends.alias("ends"), "broken"), "states")


def multiline_records(spark: SparkSession, path: str) -> DataFrame | None:
    """``file``, ``split``, ``row``, ``text`` of every record but the headers, or None
    if no record holds a line break.

    ``split`` and ``row`` are those of the record's first line.  A file that ends
    inside quotes is an error, as is a header of several lines.  Lines end at a
    line feed, with or without a carriage return before it; breaks inside
    quotes stay as they are.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )
    states = _states(lines)
    seen = states.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.bool_or(F.col("broken") | F.col("is_open")), F.lit(False)).alias("broken"),
        F.coalesce(F.bool_or("is_open"), F.lit(False)).alias("crossing"),
    ).first()
    if not seen.broken:
        return None
    open_end = states.groupBy("file").agg(F.max_by("ends", "split").alias("ends")).filter("ends").first()
    if open_end:
        raise ValueError(f"{open_end.file} ends inside quotes")
    known = states.select("file", "split", "is_open")
    if seen.n <= MAX_BROADCAST_SPLITS:
        placed = lines.join(F.broadcast(known), ["file", "split"], "left")
    else:
        placed = lines.join(known, ["file", "split"], "left")
        placed = placed.repartition("file", "split").sortWithinPartitions("file", "split", "row")
    changed = F.raise_error(F.lit("splits differ between two scans; fix spark.sql.files.minPartitionNum"))
    placed = placed.withColumn("is_open", F.coalesce("is_open", changed.cast("boolean")))
    pieces = placed.mapInArrow(_cut, "file string, split long, row long, part int, text string")
    records = pieces.filter(F.col("part") == WHOLE).drop("part")
    if seen.crossing:
        records = records.unionByName(_joined(pieces.filter(F.col("part") != WHOLE)))
    end = F.col("text").endswith("\r")
    return records.withColumn("text", F.when(end, F.expr("left(text, length(text) - 1)")).otherwise(F.col("text")))


def _joined(pieces: DataFrame) -> DataFrame:
    """Records put together from their pieces: a beginning and what follows it in later splits."""
    upto = Window.partitionBy("file").orderBy("split", "row").rowsBetween(Window.unboundedPreceding, 0)
    begin = F.when(F.col("part") == BEGINS, F.struct("split", "row"))
    grouped = stage_table(pieces, "pieces").withColumn("begin", F.last(begin, True).over(upto)).groupBy("file", "begin").agg(
        F.array_sort(F.collect_list(F.struct("split", "row", "text"))).alias("parts")
    )
    text = F.array_join(F.transform("parts", lambda p: p["text"]), "\n")
    return grouped.select("file", "begin.split", "begin.row", text.alias("text"))
