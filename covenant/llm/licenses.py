"""Licence scans by a positional index of rare words.

Templates are short notices with key phrases that must be there word by word. The rarest words of a template's key
phrases, by their document frequency in the scanned table, are its entry: a file's words that are such words are looked up in
the postings (template, place in it), and each says where the template would start. Starts on which all entry words of
a template agree are candidates; a candidate counts if every key phrase stands at its place. All of this is exact: no file,
word or candidate is left out, and a template is found wherever its key phrases are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covenant.llm.common import Words, small_batches, split_words, text_slices

#: Words of a template's key phrases that must agree on where it starts before the phrases are compared.
ENTRY_WORDS = 3

# Labels and notices. Key phrases, which must be there in full, are in brackets.
BASE = [
    ("cc-by", "[cc by]"),
    ("gpl", "[general public license]"),
    ("reserved", "[all rights reserved]"),
]
OWN = [
    ("agpl", "[gnu affero general public license]"),
    ("apache-2.0", "licensed under the [apache license version 2 0]"),
    ("apache-2.0", "under the [apache 2 0 license]"),
    ("bsd", "[redistribution and use in source and binary forms] with or without modification are permitted"),
    ("bsd", "[bsd 3 clause]"),
    ("bsd", "[bsd 2 clause]"),
    ("cc-by-nc", "licensed under [cc by nc]"),
    ("cc-by-nd", "licensed under [cc by nd]"),
    ("cc-by-sa", "licensed under [cc by sa]"),
    ("cc0", "[cc0 1 0 universal]"),
    ("creative-commons", "licensed under a [creative commons attribution]"),
    ("gpl-2.0", "licensed under the [gnu general public license version 2]"),
    ("gpl-3.0", "this work is licensed under the [gnu general public license version 3]"),
    ("isc", "[permission to use copy modify and or distribute this software for any purpose] with or without fee"),
    ("lgpl", "[gnu lesser general public license]"),
    ("mit", "released under the [mit license]"),
    ("mit", "[permission is hereby granted free of charge] to any person obtaining a copy of this software"),
    ("mpl-2.0", "this source code form is subject to the terms of the [mozilla public license]"),
    ("proprietary", "[unauthorized copying] of this file via any medium is [strictly prohibited]"),
    ("public-domain", "[released into the public domain]"),
    ("unlicense", "this is [free and unencumbered software] released into the public domain"),
]

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


@dataclass
class Template:
    label: str
    words: list[str]
    keys: np.ndarray


def parse(notices: Sequence[tuple[str, str]]) -> list[Template]:
    """Templates of (label, notice); words in brackets are key phrases, of which every template has one at least."""
    out = []
    for label, notice in notices:
        words, keys, inside = [], [], False
        for token in re.findall(r"[\[\]]|[^\s\[\]]+", notice):
            if token in "[]":
                inside = token == "["
            else:
                words.append(token)
                keys.append(inside)
        if not any(keys):
            raise ValueError(f"{label}: no key phrase")
        out.append(Template(label, words, np.array(keys)))
    return out


@dataclass
class Index:
    """Words of the templates by hash, their weights, and the entry of each template: places and words, rarest first."""

    templates: list[Template]
    hashes: np.ndarray
    numbers: list[np.ndarray]
    weights: np.ndarray
    entries: list[np.ndarray]
    keys: list[np.ndarray]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, int, Words]]:
    for batch in batches:
        for first, end, data, offsets in text_slices(batch.column("text")):
            yield batch, first, end, split_words(data, offsets, fold=True, inside=_WORD)


def _hashes(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    return split_words(data, np.array([0, len(data)]), fold=True, inside=_WORD).hashes


class _Vocabulary:
    """Looks up many words at once: the low bits of their hashes rule out nearly all before the search."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.low = np.zeros(1 << 16, bool)
        self.low[hashes & np.uint64(0xFFFF)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of known words and their numbers."""
        maybe = np.flatnonzero(self.low[hashes & np.uint64(0xFFFF)])
        at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
        known = self.hashes[at] == hashes[maybe]
        return maybe[known], at[known]


def _frequencies(hashes: np.ndarray):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _Vocabulary(hashes)
        documents, seen = 0, np.zeros(len(hashes), np.int64)
        for _, first, end, words in _slices(batches):
            places, numbers = vocabulary.find(words.hashes)
            rows = np.searchsorted(words.bounds, places, "right") - 1
            seen += np.bincount(np.unique(rows * len(hashes) + numbers) % len(hashes), minlength=len(hashes))
            documents += end - first
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(hashes) + 1)), pa.array(np.r_[seen, documents])], names=["number", "documents"]
        )

    return count


def index(docs: DataFrame, notices: Sequence[tuple[str, str]]) -> Index:
    """The index of templates for a table: the weight of a template word is its inverse document frequency over all rows
    (null texts have no words). What is collected is one number per template word, however many rows there are."""
    small_batches(docs.sparkSession)
    templates = parse(notices)
    words = sorted({w for t in templates for w in t.words})
    hashes = np.sort(_hashes(words))
    found = docs.select("text").mapInArrow(_frequencies(hashes), "number bigint, documents bigint")
    counts = {r["number"]: r["n"] for r in found.groupBy("number").agg(F.sum("documents").alias("n")).collect()}
    documents = counts.get(len(hashes), 0)
    weights = np.log((documents + 1) / (np.array([counts.get(i, 0) for i in range(len(hashes))]) + 1)) + 1
    numbers = [np.searchsorted(hashes, _hashes(t.words)) for t in templates]
    entries, keys = [], []
    for template, own in zip(templates, numbers, strict=True):
        places = np.flatnonzero(template.keys)
        # Rarest first, each word once; ties go to the smaller hash and to the first place.
        by = places[np.lexsort((places, own[places], -weights[own[places]]))]
        _, first = np.unique(own[by], return_index=True)
        entries.append(by[np.sort(first)][:ENTRY_WORDS])
        keys.append(places)
    return Index(templates, hashes, numbers, weights, entries, keys)


_PLACES = "array<struct<label: string, start: bigint, words: int, score: double>>"


def _find(index: Index, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Templates, first words and scores of all places in some rows."""
    vocabulary = _Vocabulary(index.hashes)
    places, numbers = vocabulary.find(words.hashes)
    by_word: dict[int, np.ndarray] = {}
    for own in {int(n[e[0]]) for n, e in zip(index.numbers, index.entries, strict=True)}:
        by_word[own] = places[numbers == own]
    # Word numbers with a margin on both sides, so that templates may stick out of the slice.
    margin = max(len(t.words) for t in index.templates)
    number = np.full(len(words.hashes) + 2 * margin, -1, np.int32)
    number[places + margin] = numbers
    found = []
    for t, template in enumerate(index.templates):
        own, entry, keys = index.numbers[t], index.entries[t], index.keys[t]
        starts = by_word[int(own[entry[0]])] - entry[0]
        for place in entry[1:]:
            starts = starts[(starts + place >= 0) & (number[np.maximum(starts + place + margin, 0)] == own[place])]
        starts = starts[(starts + keys[0] >= 0) & (starts + keys[-1] < len(words.hashes))]
        for place in keys:
            starts = starts[number[starts + place + margin] == own[place]]
        if not len(starts):
            continue
        rows = np.searchsorted(words.bounds, starts + keys[0], "right") - 1
        same = starts + keys[-1] < words.bounds[rows + 1]
        starts, rows = starts[same], rows[same]
        spread = np.arange(len(template.words))
        at = starts[:, None] + spread
        matches = (number[at + margin] == own) & (at >= words.bounds[rows][:, None]) & (at < words.bounds[rows + 1][:, None])
        weight = index.weights[own]
        found.append((np.full(len(starts), t), starts, matches @ weight / weight.sum()))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(float)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _scan(shared):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Index = shared.value
        first_key = np.array([k[0] for k in known.keys])
        sizes = np.array([len(t.words) for t in known.templates], np.int32)
        labels = pa.array([t.label for t in known.templates], pa.string())
        for batch, first, end, words in _slices(batches):
            template, starts, scores = _find(known, words)
            rows = np.searchsorted(words.bounds, starts + first_key[template], "right") - 1 if len(starts) else starts
            by = np.lexsort((template, starts, rows))
            template, starts, scores, rows = template[by], starts[by], scores[by], rows[by]
            places = pa.StructArray.from_arrays(
                [
                    labels.take(pa.array(template)),
                    pa.array(starts - words.bounds[rows], pa.int64()),
                    pa.array(sizes[template], pa.int32()),
                    pa.array(np.round(scores, 6)),
                ],
                names=["label", "start", "words", "score"],
            )
            bounds = pa.array(np.searchsorted(rows, np.arange(end - first + 1)).astype(np.int32))
            part = batch.slice(first, end - first)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(np.diff(words.bounds), pa.int64()), pa.ListArray.from_arrays(bounds, places)],
                names=[*part.schema.names, "n_words", "places"],
            )

    return scan


def scan(docs: DataFrame, index: Index) -> DataFrame:
    """``docs`` with ``n_words`` and ``places``: label, start (a word's number, from 0), words and score of all notices.

    Words are runs of digits, ASCII letters in any case and all other characters beyond ASCII. ``start`` is where the template's
    first word would stand and may lie before the text if only its key phrases are there; ``score`` is the share of the
    template's weight that stands at its place, 1 for a whole notice, rounded to six digits. Places are sorted by start, then by
    template; overlapping ones are all listed. Null and empty texts have none. Columns of these names are replaced.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("n_words", "places")
    schema = docs.withColumns({"n_words": F.lit(0).cast("bigint"), "places": F.lit(None).cast(_PLACES)}).schema
    shared = docs.sparkSession.sparkContext.broadcast(index)
    return docs.mapInArrow(_scan(shared), schema)


def licences(docs: DataFrame, base: Sequence[tuple[str, str]] = tuple(BASE), own: Sequence[tuple[str, str]] = tuple(OWN)) -> DataFrame:
    """``docs`` with their licences: n_words, n_base (places of base phrases), first_word and last_word (the smallest and largest
    start of these, else null), base_labels and labels (distinct, sorted, joined by commas), score (of the best place, else 0)
    and ``places``. Columns of these names are replaced; an empty table gives no rows. Notices of ``base`` must be all key phrase."""
    found = scan(docs, index(docs, [*base, *own]))
    names = [label for label, _ in base]
    starts = F.transform(F.filter("places", lambda p: p["label"].isin(names)), lambda p: p["start"])

    def joined(places) -> object:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")

    return found.withColumns(
        {
            "n_base": F.size(starts).cast("bigint"),
            "first_word": F.array_min(starts),
            "last_word": F.array_max(starts),
            "base_labels": joined(F.filter("places", lambda p: p["label"].isin(names))),
            "labels": joined(F.col("places")),
            "score": F.coalesce(F.array_max(F.transform("places", lambda p: p["score"])), F.lit(0.0)),
        }
    )
