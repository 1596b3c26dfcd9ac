"""Language spans of mixed text: script ranges, per-word scores, Viterbi.

The model holds log-probabilities of hashed character trigrams per language
and the scripts each language is written in.  A word's script narrows the
languages it may be in; Viterbi over the words of a text, with a penalty for
every switch, labels the spans.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthscore.llm.common import batch_of, pylists

BUCKETS = 1 << 16  # hashed trigrams; the model is languages x BUCKETS numbers
SMOOTHING = 0.5
SWITCH_PENALTY = 12.0  # nats that a change of language costs
MIN_SCRIPT_SHARE = 0.01  # of a language's letters, to count as one of its scripts
CHUNK = 1 << 20  # characters handled at once
GROUP_CHARS = 1 << 21  # characters of the texts that are labelled side by side

# Unicode block ranges of the main scripts.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)],
}


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    trigrams: np.ndarray  # float32, BUCKETS x languages
    scripts: np.ndarray  # bool, scripts + 1 x languages; the last row is any other script


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per code point: is a letter or a mark, is a mark, its lower case, its script."""
    n = sys.maxunicode + 1
    letter, mark, lower = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool), np.arange(n, dtype=np.uint32)
    for c in range(n):
        ch = chr(c)
        kind = unicodedata.category(ch)[0]
        if kind in "LM":
            letter[c], mark[c] = True, kind == "M"
            small = ch.lower()
            if len(small) == 1:
                lower[c] = ord(small)
    script = np.full(n, len(SCRIPTS), dtype=np.uint8)
    for i, ranges in enumerate(SCRIPTS.values()):
        for a, b in ranges:
            script[a : b + 1] = i
    return letter, mark, lower, script


def _word_grams(text: str):
    """Of all words (a letter, then letters and marks): start, length, script, and trigram hashes.

    Each word is padded with one mark on both sides.
    """
    letter, mark, lower, script = _tables()
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    inside = np.concatenate(([False], letter[codes], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if mark[codes[starts]].any():  # marks before the first letter belong to no word
        letters = np.append(np.flatnonzero(letter[codes] & ~mark[codes]), len(codes))
        first = letters[np.searchsorted(letters, starts)]
        starts, ends = first[first < ends], ends[first < ends]
        steps = np.zeros(len(codes) + 2, dtype=np.int8)
        steps[starts + 1] = 1
        steps[ends + 1] = -1
        inside = np.cumsum(steps) > 0
    lengths = ends - starts
    padded = np.zeros(len(codes) + 2, dtype=np.uint32)
    padded[1:-1] = np.where(inside[1:-1], lower[codes], 0)
    mixed = (padded[:-2] * np.uint32(0x9E3779B1)) ^ (padded[1:-1] * np.uint32(0x85EBCA77))
    mixed ^= padded[2:] * np.uint32(0xC2B2AE3D)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    grams = (mixed >> np.uint32(16))[inside[1:-1]]  # one centred on each letter
    return starts, lengths, script[codes[starts]] if len(starts) else np.zeros(0, np.uint8), grams


def _chunks(text: str) -> Iterator[str]:
    """The text in chunks cut at blanks, so that no word of sane length is split."""
    at = 0
    while at < len(text):
        end = min(len(text), at + CHUNK)
        if end < len(text):
            cut = max(text.rfind(" ", at, end), text.rfind("\n", at, end))
            end = cut + 1 if cut > at else end
        yield text[at:end]
        at = end


COUNTS = pa.schema([("lang", pa.string()), ("kind", pa.int32()), ("bucket", pa.int32()), ("n", pa.int64())])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram (kind 0) and script (kind 1) counts per language."""
    for batch in batches:
        grams: dict[str, np.ndarray] = {}
        letters: dict[str, np.ndarray] = {}
        for lang, text in pylists(batch):
            g = grams.setdefault(lang, np.zeros(BUCKETS, np.int64))
            s = letters.setdefault(lang, np.zeros(len(SCRIPTS) + 1, np.int64))
            for part in _chunks(text):
                _, lengths, script, hashed = _word_grams(part)
                g += np.bincount(hashed, minlength=BUCKETS)
                s += np.bincount(script, weights=lengths, minlength=len(s)).astype(np.int64)
        for kind, table in ((0, grams), (1, letters)):
            for lang, n in table.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(at), pa.string()),
                        pa.array(np.full(len(at), kind, np.int32)),
                        pa.array(at.astype(np.int32)),
                        pa.array(n[at]),
                    ],
                    schema=COUNTS,
                )


def fit(df: DataFrame, text_col: str, lang_col: str) -> LanguageModel:
    """Learn from every row whose text and language are not null.

    Counts are added up per task and shuffled as sums; languages x BUCKETS
    sums reach the driver, a size the number of languages fixes.
    """
    known = df.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    known = known.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    sums = known.mapInArrow(_count, "lang string, kind int, bucket int, n long")
    sums = sums.groupBy("lang", "kind", "bucket").agg(F.sum("n").alias("n")).toArrow()
    lang, kind, bucket, n = (sums.column(c).to_numpy() for c in ("lang", "kind", "bucket", "n"))
    languages = tuple(sorted(set(lang.tolist())))
    index = {x: i for i, x in enumerate(languages)}
    col = np.array([index[x] for x in lang.tolist()], dtype=np.int64)
    grams = np.zeros((BUCKETS, len(languages)))
    letters = np.zeros((len(SCRIPTS) + 1, len(languages)))
    grams[bucket[kind == 0], col[kind == 0]] = n[kind == 0]
    letters[bucket[kind == 1], col[kind == 1]] = n[kind == 1]
    probability = (grams + SMOOTHING) / (grams.sum(axis=0) + SMOOTHING * BUCKETS)
    share = letters / np.maximum(letters.sum(axis=0), 1)
    return LanguageModel(languages, np.log(probability).astype(np.float32), share >= MIN_SCRIPT_SHARE)


def _word_scores(model: LanguageModel, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores (words x languages), letters and start of each word."""
    scores, letters, starts, at = [], [], [], 0
    for part in _chunks(text):
        first, lengths, script, hashed = _word_grams(part)
        if len(lengths):
            heads = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            s = np.add.reduceat(model.trigrams[hashed], heads, axis=0)
            allowed = model.scripts[script]
            allowed[~allowed.any(axis=1)] = True  # a script no language uses says nothing
            scores.append(np.where(allowed, s, np.float32(-1e6)))
            letters.append(lengths)
            starts.append(first + at)
        at += len(part)
    if not scores:
        return np.zeros((0, len(model.languages)), np.float32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(scores), np.concatenate(letters), np.concatenate(starts)


def viterbi(scores: list[np.ndarray], penalty: float = SWITCH_PENALTY) -> list[np.ndarray]:
    """Best label of every word of several texts, solved side by side.

    Step t advances all texts that have more than t words.  On ties a label is
    kept rather than switched, and the first language wins.
    """
    order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
    sizes = np.array([len(scores[i]) for i in order])
    longest = int(sizes[0]) if len(sizes) else 0
    if not longest:
        return [np.zeros(0, np.int8) for _ in scores]
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")  # texts longer than t
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    flat = np.concatenate([scores[i] for i in order])
    langs = flat.shape[1]
    back = np.empty((len(flat), langs), dtype=np.int16)
    own = np.arange(langs)
    state = np.zeros((len(order), langs))
    final = np.zeros((len(order), langs))
    for t in range(longest):
        k = active[t]
        now = state[:k]
        top = now.argmax(axis=1)
        change = now[np.arange(k), top] - penalty
        switch = now < change[:, None]
        rows = first[:k] + t
        back[rows] = np.where(switch, top[:, None], own)
        state = np.where(switch, change[:, None], now) + flat[rows]
        state -= state.max(axis=1, keepdims=True)
        final[:k] = state
    label = final.argmax(axis=1)
    out = np.empty(len(flat), dtype=np.int16)
    for t in range(longest - 1, -1, -1):
        k = active[t]
        rows = first[:k] + t
        out[rows] = label[:k]
        label[:k] = back[rows, label[:k]]
    result: list[np.ndarray] = [np.zeros(0, np.int16)] * len(scores)
    for place, i in enumerate(order):
        result[i] = out[first[place] : first[place] + sizes[place]]
    return result


def spans(model: LanguageModel, texts: list[str | None]) -> list[tuple[str, float, list]]:
    """Per text: main language, its share of the letters, and (start, language) of each span.

    ``und`` with score 0 for a text that is null or has no letter, or if the
    model knows no language.
    """
    none = ("und", 0.0, [])
    if not model.languages:
        return [none for _ in texts]
    measured = [_word_scores(model, t or "") for t in texts]
    out = []
    for (_, letters, starts), labels in zip(measured, viterbi([m[0] for m in measured])):
        if not len(labels):
            out.append(none)
            continue
        share = np.bincount(labels, weights=letters, minlength=len(model.languages))
        main = int(share.argmax())
        turns = np.concatenate(([0], np.flatnonzero(np.diff(labels)) + 1))
        parts = [(int(starts[i]), model.languages[labels[i]]) for i in turns]
        out.append((model.languages[main], float(share[main] / letters.sum()), parts))
    return out


SPANS = pa.schema(
    [
        ("id", pa.int64()),
        ("lang_pred", pa.string()),
        ("score", pa.float64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("lang", pa.string())]))),
    ]
)
SPANS_DDL = "id long, lang_pred string, score double, spans array<struct<start:long,lang:string>>"


def _labeller(model: LanguageModel):
    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, chars = [], [], 0
            for doc, text in pylists(batch):
                ids.append(doc)
                texts.append(text)
                chars += len(text or "")
                if chars >= GROUP_CHARS:
                    yield _rows(ids, texts)
                    ids, texts, chars = [], [], 0
            yield _rows(ids, texts)

    def _rows(ids: list, texts: list) -> pa.RecordBatch:
        found = spans(model, texts)
        return batch_of(
            SPANS,
            [
                (i, lang, score, [{"start": a, "lang": x} for a, x in parts])
                for i, (lang, score, parts) in zip(ids, found)
            ],
        )

    return label


def label_documents(df: DataFrame, model: LanguageModel, id_col: str, text_col: str) -> DataFrame:
    """One row per input row: id, lang_pred, score and the language spans of its text.

    Uses the text alone.  Null texts and texts without letters are ``und`` with
    score 0 and no spans; null and repeated ids are labelled like others; other
    columns are ignored; an empty table gives an empty result.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_labeller(model), SPANS_DDL).withColumnRenamed("id", id_col)


def language_of(model: LanguageModel, text: Column) -> Column:
    """Struct ``lang``, ``score`` of a text column, for filters on whole rows."""

    @F.arrow_udf("lang string, score double")
    def label(texts: pa.Array) -> pa.Array:
        out: list[tuple[str, float]] = []
        group: list[str | None] = []
        chars = 0
        for text in texts:
            group.append(text.as_py())
            chars += len(group[-1] or "")
            if chars >= GROUP_CHARS:
                out += [(lang, score) for lang, score, _ in spans(model, group)]
                group, chars = [], 0
        out += [(lang, score) for lang, score, _ in spans(model, group)]
        return pa.array([{"lang": a, "score": b} for a, b in out],
                        pa.struct([("lang", pa.string()), ("score", pa.float64())]))

    return label(text)


def is_held_out(row_id: Column, folds: int = 3, fold: int = 1) -> Column:
    """crc32 of the id as text falls in the held-out fold; a null id counts as empty text."""
    return F.crc32(F.coalesce(row_id.cast("string"), F.lit(""))) % folds == fold
