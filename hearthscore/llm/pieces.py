"""SentencePiece encoding and decoding with a max-plus scan over giant documents.

A text is cut into the vocabulary pieces of greatest total score (Viterbi over
positions).  Documents longer than a chunk are split: each chunk yields the
matrix of best scores from every overhang at its start to every overhang at its
end, where an overhang is how many characters a piece reaches across the
boundary.  Matrices combine associatively under (max, +), which gives every
chunk the scores at its start; then each chunk tells, for every overhang at its
end, the one at its start on the best path, and these maps compose in the other
direction.  With both ends known, chunks are traced independently, and the
result is that of one pass over the whole text, ties included.

Words between cuts do not depend on what surrounds them.  So a chunk takes part
in the scan with its two ends only, and its whole words are encoded where they
lie, without a join.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields
from functools import cached_property
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthscore.llm.common import batch_of, pylists
from hearthscore.session import stage_table

CHUNK_CHARS = 16384
SPELL_ROWS = 64  # chunks decoded at a time
PRIME = 2**128 - 159
BROADCAST_UNITS = 500_000  # longer texts whose fingerprints (under 100 bytes each) are broadcast; beyond, joined
SCAN_WIDTH = 64  # matrices or maps that one task combines at a time
NEVER = -(1 << 60)
MEMO = 200_000  # remembered words; forgetting them costs time only

# Without a newline or a blank after a non-blank inside any piece, such places
# cut every segmentation, and the words between them are independent.
WORD = re.compile(r"\n| +[^ \n]*|[^ \n]+")


@dataclass(frozen=True)
class Vocabulary:
    """Pieces (blanks as blanks) with ids and whole-number scores; ids of the 256 byte pieces."""

    ids: dict[str, int]
    scores: dict[str, int]
    byte_ids: tuple[int, ...]
    byte_score: int
    longest: int

    @cached_property
    def matcher(self):
        """Finds all pieces in a text, by their ends; of equal ends the longest comes first."""
        found = ahocorasick.Automaton()
        for piece, score in self.scores.items():
            found.add_word(piece, (len(piece), score, self.ids[piece]))
        found.make_automaton()
        return found

    @cached_property
    def letters(self) -> frozenset[str]:
        """Characters that are pieces."""
        return frozenset(p for p in self.scores if len(p) == 1)

    def __getstate__(self):
        return {f.name: getattr(self, f.name) for f in fields(self)}

    @property
    def spelling(self) -> list[bytes]:
        """The bytes of every id; ids that spell nothing have none."""
        known = {i: p.encode() for p, i in self.ids.items()}
        known |= {i: bytes([b]) for b, i in enumerate(self.byte_ids)}
        return [known.get(i, b"") for i in range(max(known) + 1)]


def read_vocabulary(path: str) -> Vocabulary:
    """The pieces of a SentencePiece model file, read on the driver.

    A merge-ranked vocabulary has ranks for scores; as log-probabilities they
    are taken from Zipf's law, ``-log(rank + 2)``, in thousandths, so that sums
    are exact in any order.  A character without a piece costs its bytes.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    bytes_, ids = {}, {}
    for i in range(size):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            bytes_[int(piece[3:-1], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            ids[piece.replace("▁", " ")] = i
    if len(bytes_) != 256:
        raise ValueError("a vocabulary with all byte pieces is needed")
    if any("\n" in p or re.search(r"[^ ] ", p) for p in ids):
        raise ValueError("pieces must not cross a line break or reach into a next word")
    ranked = sorted(ids, key=lambda p: (-model.get_score(ids[p]), ids[p]))
    scores = {p: -round(1000 * math.log(r + 2)) for r, p in enumerate(ranked)}
    byte_score = -round(1000 * math.log(size + 2))
    longest = max(map(len, ids))
    return Vocabulary(ids, scores, tuple(bytes_[b] for b in range(256)), byte_score, longest)


def _forward(v: Vocabulary, text: str, stop: int, start: dict[int, int]):
    """Best score and last piece length at each position, over pieces that start before ``stop``.

    ``start`` has the scores of the positions where a path may begin.  Equal
    scores prefer the longest last piece, which is the one before the start if any.
    """
    best = [NEVER] * (len(text) + 1)
    last = [0] * (len(text) + 1)
    for position, score in start.items():
        best[position] = score
    found = v.matcher.iter(text)
    if not v.letters.issuperset(text):
        bytes_ = [
            (i, (1, v.byte_score * len(c.encode()), None)) for i, c in enumerate(text) if c not in v.letters
        ]
        found = sorted([*found, *bytes_], key=itemgetter(0))  # stable: single characters last
    for end, (k, score, _) in found:
        at = end + 1 - k
        total = best[at] + score
        if total > best[end + 1] and at < stop and best[at] > NEVER:
            best[end + 1], last[end + 1] = total, k
    return best, last


def _trace(v: Vocabulary, text: str, last: list[int], end: int) -> tuple[list[int], int]:
    """Ids of the best path that ends at ``end``, and the position where it begins."""
    out: list[int] = []
    i = end
    while last[i]:
        piece = text[i - last[i] : i]
        known = v.ids.get(piece)
        out += [v.byte_ids[b] for b in reversed(piece.encode())] if known is None else [known]
        i -= last[i]
    return out[::-1], i


def _word_ids(v: Vocabulary, word: str) -> bytes:
    """Ids of a stretch between cuts: the plain case of the two functions above."""
    if not v.letters.issuperset(word):
        _, last = _forward(v, word, len(word), {0: 0})
        return _packed(_trace(v, word, last, len(word))[0])
    n = len(word)
    best, back = [0] + [NEVER] * n, [(0, 0, 0)] * (n + 1)
    for end, piece in v.matcher.iter(word):
        end += 1
        total = best[end - piece[0]] + piece[1]
        if total > best[end]:
            best[end], back[end] = total, piece
    ids = array("i")
    while n:
        length, _, known = back[n]
        ids.append(known)
        n -= length
    ids.reverse()
    return ids.tobytes()


class Encoder(dict):
    """Ids of stretches between cuts, as the bytes of 32-bit numbers; it remembers them."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.v = vocabulary

    def __missing__(self, word: str) -> bytes:
        ids = _word_ids(self.v, word)
        if len(self) >= MEMO:
            self.clear()
        self[word] = ids
        return ids

    def words(self, text: str) -> bytes:
        """Ids of a text that cuts enclose."""
        return b"".join(map(self.__getitem__, WORD.findall(text)))

    def packed(self, text: str) -> bytes:
        """Ids of a whole text, after the blank that opens every text."""
        return self.words(" " + text) if text else b""

    def whole(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()


def _packed(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


def _lists(packed: list[bytes]) -> pa.Array:
    """An Arrow list of int32 per element."""
    ends = np.cumsum([0, *(len(p) // 4 for p in packed)]).astype(np.int32)
    ids = np.frombuffer(b"".join(packed), np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(ids, pa.int32()))


class Ends:
    """The stretches of a chunk that depend on its neighbours.

    ``head`` reaches up to the first cut and ``tail`` from the last cut to what
    pieces may reach behind the chunk, whose own characters end at ``stop`` in
    it.  Without a cut the tail is all.  Whole words between the two add the
    same to every path, so scores leave them out.
    """

    def __init__(self, v: Vocabulary, cut: bool, head: str, tail: str, stop: int):
        self.v, self.cut, self.head, self.tail, self.stop = v, cut, head, tail, stop

    def _exits(self, best: list[int]) -> list[int]:
        return [
            best[self.stop + b] if self.stop + b < len(best) else NEVER
            for b in range(self.v.longest)
        ]

    def _passes(self, entry: list[int]):
        """Forward pass over head and tail for the scores of the overhangs at the start."""
        starts = {a: s for a, s in enumerate(entry) if s > NEVER}
        head_last: list[int] = []
        if self.cut:
            starts = {a: s for a, s in starts.items() if a <= len(self.head)}
            best, head_last = _forward(self.v, self.head, len(self.head), starts)
            starts = {0: best[len(self.head)]}
        starts = {a: s for a, s in starts.items() if a <= len(self.tail)}
        best, tail_last = _forward(self.v, self.tail, self.stop, starts)
        return self._exits(best), head_last, tail_last

    def matrix(self) -> np.ndarray:
        """Best score from each overhang at the start to each behind the end."""
        w = self.v.longest
        if not self.cut:
            alone = [[0 if i == a else NEVER for i in range(w)] for a in range(w)]
            return np.array([self._passes(entry)[0] for entry in alone], dtype=np.int64)
        first = []
        for a in range(w):
            if a > len(self.head):
                first.append(NEVER)
            else:
                first.append(_forward(self.v, self.head, len(self.head), {a: 0})[0][-1])
        best, _ = _forward(self.v, self.tail, self.stop, {0: 0})
        total = np.array(first, dtype=np.int64)[:, None] + np.array(self._exits(best), dtype=np.int64)
        return np.where(total < NEVER // 2, NEVER, total)

    def trace(self, entry: list[int], overhang: int) -> tuple[list[int], list[int], int]:
        """Ids in head and in tail on the best path to ``overhang``, and its own start."""
        _, head_last, tail_last = self._passes(entry)
        ids, start = _trace(self.v, self.tail, tail_last, self.stop + overhang)
        if not self.cut:
            return ids, [], start
        first, start = _trace(self.v, self.head, head_last, len(self.head))
        return first, ids, start

    def entries(self, entry: list[int]) -> list[int]:
        """For each overhang behind the end, the overhang at the start on its best path; -1: none."""
        exits, head_last, tail_last = self._passes(entry)
        if self.cut:
            start = _trace(self.v, self.head, head_last, len(self.head))[1]
            return [start if score > NEVER else -1 for score in exits]
        return [
            _trace(self.v, self.tail, tail_last, self.stop + b)[1] if score > NEVER else -1
            for b, score in enumerate(exits)
        ]


class Chunk(Ends):
    """A chunk of a text, given with the characters behind it that its pieces may reach."""

    def __init__(self, encoder: Encoder, text: str, ahead: str):
        self.encoder = encoder
        super().__init__(encoder.v, *(parts := cut_ends(text, ahead))[:1], *parts[2:])
        self.middle = parts[1]

    def encode(self, entry: list[int], overhang: int) -> tuple[list[int], int]:
        """Ids of the pieces starting here on the best path to ``overhang``, and its own start."""
        head, tail, start = self.trace(entry, overhang)
        middle = np.frombuffer(self.encoder.words(self.middle), np.int32).tolist()
        return head + middle + tail, start


def cut_ends(text: str, ahead: str) -> tuple[bool, str, str, str, int]:
    """Of a chunk: has it a cut, its whole words, its head, its tail, and where the tail's own part stops."""
    full, n = text + ahead, len(text)
    parts = WORD.findall(full)
    ends = np.cumsum([len(p) for p in parts])
    inner = int(np.searchsorted(ends, min(n, len(full) - 1), side="right"))  # parts up to the last cut
    if not inner:
        return False, "", "", parts[0], n
    head, last = len(parts[0]), int(ends[inner - 1])
    return True, full[head:last], parts[0], parts[inner], n - last


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product of two matrices under (max, +)."""
    best = (a[:, :, None] + b[None, :, :]).max(axis=1)
    return np.where(best < NEVER // 2, NEVER, best)


_encoders: list[Encoder] = []


def _encoder_of(vocabulary) -> Encoder:
    """The worker's encoder for a broadcast vocabulary, so that words stay remembered."""
    if not _encoders or _encoders[0].v is not vocabulary.value:
        _encoders[:] = [Encoder(vocabulary.value)]
    return _encoders[0]


CHUNK = pa.schema(
    [
        *[(c, pa.int64()) for c in ("unit", "id", "chunk", "n_chunks")],
        ("source", pa.string()),
        ("cut", pa.bool_()),
        *[(c, pa.string()) for c in ("middle", "head", "tail")],
        ("stop", pa.int32()),
    ]
)
CHUNK_DDL = (
    "unit long, id long, chunk long, n_chunks long, source string, cut boolean, middle string,"
    " head string, tail string, stop int"
)


def _split(reach: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit, doc, text in pylists(batch):
                source = fingerprint([text.encode()])
                text = " " + text
                rows, n = [], -(-len(text) // CHUNK_CHARS)
                for i, at in enumerate(range(0, len(text), CHUNK_CHARS)):
                    end = at + CHUNK_CHARS
                    rows.append((unit, doc, i, n, source, *cut_ends(text[at:end], text[end : end + reach])))
                    if len(rows) == 256:
                        yield batch_of(CHUNK, rows)
                        rows = []
                yield batch_of(CHUNK, rows)

    return run


def _pack(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a, dtype="<i8").tobytes()


def _unpack(b: bytes) -> np.ndarray:
    return np.frombuffer(b, dtype="<i8")


def _scan(level: DataFrame, combine: Callable, width: int) -> list[DataFrame]:
    """Levels of an up-sweep: each joins up to ``SCAN_WIDTH`` neighbours of the one below."""
    schema = pa.schema([("unit", pa.int64()), ("chunk", pa.int64()), ("m", pa.binary())])

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        total = None
        for m in table.column("m").to_pylist():
            m = _unpack(m).reshape(-1, width) if width > 1 else _unpack(m)
            total = m if total is None else combine(total, m)
        first = table.slice(0, 1).to_pylist()[0]
        row = (first["unit"], first["chunk"] // SCAN_WIDTH, _pack(total))
        return pa.Table.from_batches([batch_of(schema, [row])])

    levels = [level]
    while (levels[-1].agg(F.max("chunk")).first()[0] or 0) > 0:
        groups = levels[-1].groupBy("unit", F.floor(F.col("chunk") / SCAN_WIDTH))
        up = groups.applyInArrow(join, "unit long, chunk long, m binary")
        levels.append(stage_table(up, "scan_up"))
    return levels


def _sweep_down(levels: list[DataFrame], start: bytes, step: Callable, backwards: bool) -> DataFrame:
    """``unit``, ``chunk``, ``x``: what has gathered before (or behind) each chunk of level 0.

    Runs from the top level down; ``step(x, m)`` passes one element.
    """
    schema = pa.schema([("unit", pa.int64()), ("chunk", pa.int64()), ("x", pa.binary())])

    def spread(table: pa.Table) -> pa.Table:
        table = table.sort_by([("chunk", "descending" if backwards else "ascending")])
        rows, x = [], None
        for row in table.to_pylist():
            x = row["x"] if x is None else x
            rows.append((row["unit"], row["chunk"], x))
            x = step(x, row["m"])
        return pa.Table.from_batches([batch_of(schema, rows)])

    known = levels[-1].select("unit", "chunk", F.lit(bytearray(start)).alias("x"))
    for level in reversed(levels[:-1]):
        block = F.floor(F.col("chunk") / SCAN_WIDTH).alias("block")
        above = known.select("unit", F.col("chunk").alias("block"), "x")
        joined = level.select("*", block).join(above, ["unit", "block"])
        known = joined.groupBy("unit", "block").applyInArrow(spread, "unit long, chunk long, x binary")
        known = stage_table(known, "scan_down")
    return known


ENDS = ("cut", "head", "tail", "stop")
IDS = "unit long, id long, chunk long, n_chunks long, source string, ids array<int>"
PLACE = ("unit", "id", "chunk", "n_chunks", "source")


def _rows(places: list[tuple], packed: list[bytes]) -> pa.RecordBatch:
    columns = list(zip(*places)) or [()] * len(PLACE)
    kinds = [pa.string() if c == "source" else pa.int64() for c in PLACE]
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
    return pa.RecordBatch.from_arrays([*arrays, _lists(packed)], [*PLACE, "ids"])


def _encode_ends(ends: DataFrame, vocabulary, longest: int) -> DataFrame:
    """Rows of the first and the last stretch of each chunk: every third and the one before the next.

    ``ends`` has the key, the id and the ends of the chunks; it is read twice
    and shuffled once, without the words between the ends.
    """
    tri = "unit long, chunk long, m binary"
    schema = pa.schema([("unit", pa.int64()), ("chunk", pa.int64()), ("m", pa.binary())])

    def matrices(batches):
        v = _encoder_of(vocabulary).v
        for batch in batches:
            yield batch_of(schema, [(u, c, _pack(Ends(v, *e).matrix())) for u, c, *e in pylists(batch)])

    def pass_matrix(x: bytes, m: bytes) -> bytes:
        return _pack(max_plus(_unpack(x).reshape(1, -1), _unpack(m).reshape(longest, -1)))

    def origins(batches):
        v = _encoder_of(vocabulary).v
        for batch in batches:
            rows = []
            for u, c, *e, x in pylists(batch):
                rows.append((u, c, _pack(Ends(v, *e).entries(_unpack(x).tolist()))))
            yield batch_of(schema, rows)

    def compose(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """From overhangs behind the right chunk to those before the left one."""
        return np.where(right < 0, -1, left[np.maximum(right, 0)])

    def pass_map(x: bytes, m: bytes) -> bytes:
        return _pack(_unpack(m)[_unpack(x)])

    def trace(batches):
        v = _encoder_of(vocabulary).v
        for batch in batches:
            places, packed = [], []
            for unit, doc, c, n, source, *e, x, y in pylists(batch):
                head, tail, _ = Ends(v, *e).trace(_unpack(x).tolist(), int(_unpack(y)[0]))
                places += [(unit, doc, 3 * c + i, 3 * n, source) for i in (0, 2)]
                packed += [_packed(head), _packed(tail)]
            yield _rows(places, packed)

    keys = ["unit", "chunk"]
    cells = stage_table(ends.select(*keys, *ENDS).mapInArrow(matrices, tri), "matrices")
    start = np.array([0] + [NEVER] * (longest - 1))
    entry = _sweep_down(_scan(cells, max_plus, longest), _pack(start), pass_matrix, False)
    known = ends.join(entry.withColumnRenamed("x", "entry"), keys)
    maps = stage_table(known.select(*keys, *ENDS, "entry").mapInArrow(origins, tri), "origins")
    behind = _sweep_down(_scan(maps, compose, 1), _pack(np.array([0])), pass_map, True)
    ready = known.join(behind, keys).select(*PLACE, *ENDS, "entry", "x")
    return ready.mapInArrow(trace, IDS)


def encode(
    df: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows id, chunk, n_chunks, ids: the pieces of every text, chunk by chunk.

    The pieces of a text are those of greatest total score over the text with a
    blank put before it; equal scores prefer longer pieces from the end on.
    Texts up to ``CHUNK_CHARS`` are one chunk and are encoded where they are
    read; longer ones take the scan, in which no task holds more than
    ``SCAN_WIDTH`` matrices.  Each chunk of the scan gives three rows: what
    comes up to its first cut, its whole words, and what starts behind its last
    cut; the ids of a text are those of its rows in the order of ``chunk``.  Null
    and empty texts give one row without ids; null and repeated ids are encoded
    like others; other columns are ignored; an empty table gives an empty
    result.
    """
    short, long = _parts(df, vocabulary, id_col, text_col)
    return short.unionByName(long).select("id", "chunk", "n_chunks", "ids")


def _parts(df: DataFrame, vocabulary: Vocabulary, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows of the short texts and, staged, of the others, with the fingerprint of their text.

    ``unit`` numbers the longer texts, whatever their ids; short ones have none.
    """
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    one = F.char_length("text") < CHUNK_CHARS

    @F.arrow_udf("array<int>")
    def whole(texts: pa.Array) -> pa.Array:
        encoder = _encoder_of(shared)
        return _lists([encoder.packed(t.as_py()) for t in texts])

    def middles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder_of(shared)
        for batch in batches:
            rows = list(pylists(batch))
            places = [(unit, doc, 3 * c + 1, 3 * n, source) for unit, doc, c, n, source, _ in rows]
            yield _rows(places, [encoder.words(text) for *_, text in rows])

    @F.arrow_udf("string")
    def source_of(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint([t.as_py().encode()]) for t in texts], pa.string())

    nought, source = F.lit(0).cast("long"), source_of("text").alias("source")
    no_unit = F.lit(None).cast("long").alias("unit")
    short = rows.where(one).select(
        no_unit, "id", nought.alias("chunk"), (nought + 1).alias("n_chunks"), source, whole("text").alias("ids")
    )
    giants = rows.where(~one).select(F.monotonically_increasing_id().alias("unit"), "id", "text")
    cut = stage_table(giants.mapInArrow(_split(vocabulary.longest - 1), CHUNK_DDL), "chunks")
    words = cut.select(*PLACE, "middle").mapInArrow(middles, IDS)
    ends = _encode_ends(cut.drop("middle"), shared, vocabulary.longest)
    return short, stage_table(words.unionByName(ends), "long_texts")


def _residue(raw: bytes) -> tuple[int, int]:
    return int.from_bytes(raw, "big") % PRIME, len(raw)


def fingerprint(parts: list[bytes]) -> str:
    """Fingerprint of the parts set one after the other: their bytes as a number to base 256,
    modulo a prime of 128 bits, and how many bytes they are."""
    return _chained([_residue(p) for p in parts])


def _chained(residues: list[tuple[int, int]]) -> str:
    """The fingerprint of texts whose residues are known, so that no text has to move."""
    total, length = 0, 0
    for value, n in residues:
        total, length = (total * pow(256, n, PRIME) + value) % PRIME, length + n
    return f"{total:032x}-{length}"


def round_trip(
    df: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of :func:`encode`, each with ``spelled``, the fingerprint of the text that all
    pieces of its document spell, and ``round_trip``: whether the text encoded has the same.

    Every chunk is decoded on its own, where its pieces are; of longer texts only
    the residues of the chunks meet, never the texts.  Null and empty texts spell
    the empty text; repeated ids are kept apart.
    """
    short, long = _parts(df, vocabulary, id_col, text_col)
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    @F.arrow_udf("string")
    def spelled(first: pa.Array, ids: pa.Array) -> pa.Array:
        return pa.array([fingerprint([raw]) for raw in _spell(shared.value, first, ids)], pa.string())

    @F.arrow_udf("string")
    def chained(parts: pa.Array) -> pa.Array:
        rows = ([p["spelled"].split("-") for p in row.as_py()] for row in parts)
        return pa.array([_chained([(int(v, 16), int(n)) for v, n in row]) for row in rows], pa.string())

    def of_chunk(rows: DataFrame) -> DataFrame:
        return rows.withColumn("spelled", spelled(F.col("chunk") == 0, F.col("ids")))

    parts = of_chunk(long).select("unit", "chunk", "spelled").groupBy("unit").agg(
        F.array_sort(F.collect_list(F.struct("chunk", "spelled"))).alias("parts")
    )
    units = stage_table(parts.select("unit", chained("parts").alias("spelled")), "spelled")
    if units.count() <= BROADCAST_UNITS:
        units = F.broadcast(units)
    found = of_chunk(short).unionByName(long.join(units, "unit"))
    same = (F.col("spelled") == F.col("source")).alias("round_trip")
    return found.select("id", "chunk", "n_chunks", "ids", "spelled", same)


def decode_ids(vocabulary: Vocabulary, first: bool, ids: list[int]) -> str:
    """Text of the pieces of one chunk; the first chunk opens with the blank put there."""
    table = vocabulary.spelling
    text = b"".join(table[i] for i in ids).decode()
    return text[1:] if first else text


def _spell(v: Vocabulary, first: pa.Array, ids: pa.Array) -> Iterator[bytes]:
    """What each row of ids spells, without the blank put before a first chunk; few rows at a time."""
    table = _spelling_of(v)
    for at in range(0, len(ids), SPELL_ROWS):
        some = ids.slice(at, SPELL_ROWS)
        offsets = pc.subtract(some.offsets, some.offsets[0]).cast(pa.int64())
        parts = pa.LargeListArray.from_arrays(offsets, table.take(some.flatten()))
        joined = pc.binary_join(parts, pa.scalar(b"", pa.large_binary()))
        for is_first, raw in zip(first.slice(at, SPELL_ROWS).to_pylist(), joined):
            yield raw.as_py()[1 if is_first else 0 :]


_spellings: list[tuple[Vocabulary, pa.Array]] = []


def _spelling_of(v: Vocabulary) -> pa.Array:
    """The worker's table of a vocabulary's spellings."""
    if not _spellings or _spellings[0][0] is not v:
        _spellings[:] = [(v, pa.array(v.spelling, pa.large_binary()))]
    return _spellings[0][1]


def decode(encoded: DataFrame, vocabulary: Vocabulary, out: str = "text") -> DataFrame:
    """The rows of :func:`encode` with the text that each chunk's pieces spell.

    Texts of one document's chunks, joined in order, are the document.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    @F.arrow_udf("string")
    def spell(first: pa.Array, ids: pa.Array) -> pa.Array:
        return pa.array([raw.decode() for raw in _spell(shared.value, first, ids)], pa.string())

    return encoded.withColumn(out, spell(F.col("chunk") == 0, F.col("ids")))
