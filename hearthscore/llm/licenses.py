"""License scans with a positional index of rare template words.

Every template word has its positions (postings).  For a file, each template's
rarest words that the file has, by inverse document frequency over the whole
corpus, are looked up; where file positions minus template positions agree, the
template may stand.  There its mandatory phrases must be found in place.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthscore.llm.common import ASCII_LOWER, batch_of, pylists

RARE_WORDS = 8  # of each template, the rarest ones that a file has
MIN_AGREE = 0.6  # of the looked-up words must agree on one place
SLACK = 3  # words by which a phrase may be displaced around that place

# Phrases and labels of the base scan.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Public licence notices, each with the phrases it cannot do without.
TEMPLATES: dict[str, tuple[str, list[str]]] = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        ["apache license", "version 2 0"],
    ),
    "apache-2.0-header": (
        "you may not use this file except in compliance with the License. You may obtain a copy of"
        " the License at",
        ["except in compliance with the license"],
    ),
    "mit-notice": ("Released under the MIT License", ["mit license"]),
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files (the \"Software\"), to deal in the Software"
        " without restriction",
        ["permission is hereby granted free of charge", "deal in the software without restriction"],
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3",
        ["gnu general public license", "version 3"],
    ),
    "gpl-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU General Public License as published by the Free Software Foundation",
        ["terms of the gnu general public license", "free software foundation"],
    ),
    "lgpl": (
        "under the terms of the GNU Lesser General Public License as published by the Free Software"
        " Foundation",
        ["gnu lesser general public license"],
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met",
        ["redistribution and use in source and binary forms", "following conditions are met"],
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted",
        ["for any purpose with or without fee is hereby granted"],
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        ["mozilla public license", "2 0"],
    ),
    "cc-by-nc-4.0": ("Licensed under CC BY-NC 4.0", ["cc by nc 4 0"]),
    "cc-by-4.0": ("Licensed under CC BY 4.0", ["cc by 4 0"]),
    "cc-by-sa-4.0": ("Licensed under CC BY-SA 4.0", ["cc by sa 4 0"]),
    "unlicense": (
        "This is free and unencumbered software released into the public domain",
        ["free and unencumbered software", "public domain"],
    ),
}

# Bytes that split words, as blanks: ASCII other than digits and letters.
_TO_WORDS = bytes(
    b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in ASCII_LOWER
)


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a UTF-8 text with A-Z lowered."""
    return text.translate(_TO_WORDS).split()


def _template_words(templates) -> dict[str, list[bytes]]:
    return {name: words_of(text.encode()) for name, (text, _) in templates.items()}


def _places(words: list[bytes], phrase: list[bytes], starts: list[int]) -> list[int]:
    """The ``starts`` at which ``phrase`` stands."""
    k = len(phrase)
    return [i for i in starts if words[i : i + k] == phrase]


@dataclass(frozen=True)
class LicenseIndex:
    """Postings and key phrases of the templates, and the weight of each template word."""

    weight: dict[bytes, float]
    postings: dict[str, dict[bytes, list[int]]]  # template -> word -> positions
    by_rarity: dict[str, list[bytes]]  # template -> its words, rarest first
    phrases: dict[str, list[list[bytes]]]
    length: dict[str, int]


def build_index(document_counts: dict[bytes, int], documents: int, templates=None) -> LicenseIndex:
    templates = TEMPLATES if templates is None else templates
    words = _template_words(templates)
    vocabulary = {w for ws in words.values() for w in ws}
    vocabulary |= {w for phrase in BASE_PHRASES for w in words_of(phrase.encode())}
    weight = {w: math.log((documents + 1) / (document_counts.get(w, 0) + 0.5)) for w in vocabulary}
    postings: dict[str, dict[bytes, list[int]]] = {}
    for name, ws in words.items():
        at: dict[bytes, list[int]] = defaultdict(list)
        for i, w in enumerate(ws):
            at[w].append(i)
        postings[name] = dict(at)
    return LicenseIndex(
        weight,
        postings,
        {name: sorted(set(ws), key=lambda w: (-weight[w], w)) for name, ws in words.items()},
        {name: [words_of(p.encode()) for p in keys] for name, (_, keys) in templates.items()},
        {name: len(ws) for name, ws in words.items()},
    )


def licence_words(index: LicenseIndex, words: list[bytes]) -> dict[bytes, list[int]]:
    """Positions of the template words in a file."""
    seen: dict[bytes, list[int]] = defaultdict(list)
    for i, w in enumerate(words):
        if w in index.weight:
            seen[w].append(i)
    return seen


def find_templates(index: LicenseIndex, words: list[bytes], seen: dict[bytes, list[int]]):
    """Verified (template, first word, share of the template's words in place)."""
    found = []
    for name, at in index.postings.items():
        present = [w for w in index.by_rarity[name] if w in seen]
        if any(w not in seen for phrase in index.phrases[name] for w in phrase):
            continue
        rare = present[:RARE_WORDS]
        votes: Counter[int] = Counter()
        for w in rare:
            votes.update({d - t for d in seen[w] for t in at[w]})
        best: tuple[float, int] | None = None
        for place, n in votes.items():
            if n < MIN_AGREE * len(rare) or not _verified(index, name, words, seen, place):
                continue
            inside = range(max(0, place), min(len(words), place + index.length[name]))
            hits = sum(i - place in at.get(words[i], ()) for i in inside)
            best = max(best or (0.0, 0), (hits / index.length[name], -place))
        if best:
            found.append((name, -best[1], best[0]))
    return found


def _verified(index: LicenseIndex, name: str, words, seen, place: int) -> bool:
    low, high = place - SLACK, place + index.length[name] + SLACK
    for phrase in index.phrases[name]:
        starts = [i for i in seen[phrase[0]] if low <= i <= high - len(phrase)]
        if not _places(words, phrase, starts):
            return False
    return True


def scan(index: LicenseIndex, text: bytes) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of a UTF-8 text."""
    words = words_of(text)
    seen = licence_words(index, words)
    starts, base = [], set()
    for phrase, label in BASE_PHRASES.items():
        parts = phrase.encode().split()
        hits = _places(words, parts, seen.get(parts[0], []))
        starts += hits
        base |= {label} if hits else set()
    found = find_templates(index, words, seen)
    labels = base | {name for name, _, _ in found}
    score = max([share for _, _, share in found], default=0.0)
    ends = (min(starts), max(starts)) if starts else (None, None)
    return (len(words), len(starts), *ends, ",".join(sorted(base)), ",".join(sorted(labels)), score)


def _count_documents(vocabulary: frozenset[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        rows = 0
        for batch in batches:
            for (text,) in pylists(batch):
                rows += 1
                if text:
                    counts.update(vocabulary.intersection(words_of(text)))
        out = [(w.decode(), n) for w, n in counts.items()] + [(None, rows)]
        yield batch_of(pa.schema([("word", pa.string()), ("n", pa.int64())]), out)

    return run


def fit_index(df: DataFrame, text_col: str = "text") -> LicenseIndex:
    """Index with document frequencies of the template words over all rows of ``df``.

    Every task sends one sum per template word; the vocabulary is fixed.
    """
    vocabulary = frozenset(w for ws in _template_words(TEMPLATES).values() for w in ws)
    texts = df.select(F.col(text_col).cast("binary").alias("text"))
    counted = texts.mapInArrow(_count_documents(vocabulary), "word string, n long")
    sums = {r.word: r.n for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    rows = sums.pop(None, 0)
    return build_index({w.encode(): n for w, n in sums.items()}, rows)


SCAN = pa.schema(
    [
        ("id", pa.int64()),
        *[(c, pa.int64()) for c in ("n_words", "n_base", "first_word", "last_word")],
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("score", pa.float64()),
    ]
)
SCAN_DDL = (
    "id long, n_words long, n_base long, first_word long, last_word long, base_labels string,"
    " labels string, score double"
)


def scan_licenses(
    df: DataFrame, index: LicenseIndex, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: counts and places of base phrases, labels, score.

    ``score`` is the largest share of a verified template's words found in
    place, 0 without one.  Null texts count as empty and give no labels and
    null places; null and repeated ids are scanned like others; other columns
    are ignored; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch_of(SCAN, [(doc, *scan(index, text or b"")) for doc, text in pylists(batch)])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, SCAN_DDL).withColumnRenamed("id", id_col)
