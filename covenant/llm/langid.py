"""Language identification with string kernels.

The kernel of two texts is the number of byte n-grams (one to three bytes, letters only, A-Z lower-cased) present in both,
divided by the root of the product of their numbers. Landmarks stand in for the sample (Nystroem): a text is described
by its kernels with them, whitened by their own kernel matrix, and one ridge regression per language is solved on that.
Kernel, whitening and regression are linear in the n-gram presences but for the norm, so their matrices are multiplied
out once, and a batch of texts is scored with one product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covenant.llm.common import held_out, small_batches, text_slices

#: Bound of the labelled sample, over all languages; languages get equal shares.
SAMPLE = 2400
#: n-grams of the kernel: the most widespread ones of the sample.
FEATURES = 4096
LANDMARKS = 160
RIDGE = 1e-2
UNDETERMINED = "und"

_CLASSES = np.full(256, 32, np.uint8)
_CLASSES[97:123] = np.arange(97, 123)
_CLASSES[65:91] = np.arange(97, 123)
_CLASSES[128:] = np.arange(128, 256)

#: First codes of the n-grams of one, two and three bytes, and the number of codes.
_FIRST = (0, 1 << 8, (1 << 8) + (1 << 16))
_CODES = (1 << 8) + (1 << 16) + (1 << 24)


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray


def _codes(data: np.ndarray) -> list[np.ndarray]:
    """Codes of the n-grams that start at each byte; n-grams may run over the end of a row and are cut off by callers."""
    letters = _CLASSES[data].astype(np.int32)
    two = (letters[:-1] << 8) | letters[1:]
    three = (two[:-1] << 8) | letters[2:]
    return [letters, two + _FIRST[1], three + _FIRST[2]]


def _presences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, data, offsets in text_slices(batch.column("text")):
            out = []
            for i in range(end - first):
                own = data[offsets[i] : offsets[i + 1]]
                found = [np.unique(c) for c in _codes(own)] if len(own) else []
                out.append(np.concatenate(found).astype("<i4").tobytes() if found else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").slice(first, end - first), pa.array(out, pa.binary())], names=["lang", "grams"]
            )


def _has_letter():
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def train(docs: DataFrame, sample: int = SAMPLE, features: int = FEATURES, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Fit on at most ``sample`` rows of ``docs`` (doc_id, text, lang) with a language and a letter, chosen by the hash of
    their ids, in about equal shares per language where there are enough. Their presences (n-gram codes) reach the driver."""
    usable = docs.where(F.col("lang").isNotNull() & _has_letter())
    # At most ``sample`` rows: the languages that are learned, the most frequent ones.
    counts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "lang").limit(sample)
    counts = counts.withColumn("share", F.ceil(F.lit(sample) / F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))))
    order = F.xxhash64("doc_id", "lang")
    # About three shares of each language are ranked, so no language's rows meet in one task.
    few = F.pmod(F.col("order"), F.lit(1 << 40)).cast("double") * F.col("rows") < F.lit(3 << 40).cast("double") * F.col("share")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order", "doc_id"))
    chosen = (
        usable.select("doc_id", "lang", order.alias("order"))
        .join(F.broadcast(counts), "lang")
        .where(few)
        .withColumn("rank", rank)
        .where(F.col("rank") <= F.col("share"))
        .orderBy("rank", "order", "doc_id")
        .limit(sample)
        .select("doc_id", "lang")
        .distinct()
    )
    rows = (
        usable.select("doc_id", "lang", "text")
        .join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi")  # at most ``sample`` rows
        .select("lang", "text")
        .mapInArrow(_presences, "lang string, grams binary")
        .limit(sample)
        .collect()
    )
    if not rows:
        return Model([], np.zeros(0, np.int32), np.zeros((0, 0), np.float32), np.zeros(0, np.float32))
    grams = [np.frombuffer(r["grams"], "<i4") for r in rows]
    languages = sorted({r["lang"] for r in rows})
    number = np.array([languages.index(r["lang"]) for r in rows])

    spread, counts = np.unique(np.concatenate(grams), return_counts=True)
    codes = np.sort(spread[np.lexsort((spread, -counts))[:features]])
    present = np.zeros((len(rows), len(codes)), np.float64)
    for i, own in enumerate(grams):
        at = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
        present[i, at[codes[at] == own]] = 1
    present /= np.sqrt(np.maximum(present.sum(axis=1, keepdims=True), 1))

    # Landmarks: rows of each language in turn.
    turn = np.zeros(len(rows), int)
    for language in range(len(languages)):
        own = np.flatnonzero(number == language)
        turn[own] = np.arange(len(own))
    marks = present[np.lexsort((number, turn))[:landmarks]]
    values, vectors = np.linalg.eigh(marks @ marks.T)
    strong = values > 1e-9 * values.max()
    whiten = vectors[:, strong] / np.sqrt(values[strong])
    described = present @ marks.T @ whiten
    described = np.c_[described, np.ones(len(rows))]
    wanted = np.eye(len(languages))[number]
    share = 1 / np.bincount(number)[number]
    weighted = described * share[:, None]
    scale = ridge * share.sum() / described.shape[1]
    solved = np.linalg.solve(described.T @ weighted + scale * np.eye(described.shape[1]), weighted.T @ wanted)
    return Model(languages, codes.astype(np.int32), (marks.T @ whiten @ solved[:-1]).astype(np.float32), solved[-1].astype(np.float32))


def _predict(shared):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        width = len(model.codes)
        place = np.full(_CODES, width, np.int16)
        place[model.codes] = np.arange(width, dtype=np.int16)
        for batch in batches:
            letter = batch.column("__letter").to_numpy(zero_copy_only=False)
            kept = [c for c in batch.schema.names if c != "__letter"]
            for first, end, data, offsets in text_slices(batch.column("text")):
                n = end - first
                present = np.zeros((n, width + 1), bool)
                row = np.repeat(np.arange(n, dtype=np.int64) * (width + 1), np.diff(offsets))
                for more, codes in enumerate(_codes(data)):
                    at = place[codes].astype(np.int64) + row[: len(codes)]
                    if more:
                        inside = row[: len(codes)] == row[more:]
                        at = at[inside]
                    present.reshape(-1)[at] = True
                known = present[:, :width].astype(np.float32)
                norm = np.sqrt(np.maximum(known.sum(axis=1, keepdims=True), 1))
                found = known @ model.weights / norm + model.bias
                best = found.argmax(axis=1)
                sure = np.clip(found[np.arange(n), best], 0, 1).astype(float)
                ok = letter[first:end]
                names = [model.languages[b] if yes else UNDETERMINED for b, yes in zip(best, ok, strict=True)]
                part = batch.slice(first, n)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in kept], pa.array(names, pa.string()), pa.array(np.where(ok, sure, 0.0))],
                    names=[*kept, "lang_pred", "score"],
                )

    return predict


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` (a learned language, or ``und`` for null texts and texts without a letter) and ``score``
    (the regression's value for it, cut to 0..1). Only ``text`` is looked at, and all of it. Columns of these names are
    replaced; all others pass through. Ties go to the language that sorts first; without a model all is ``und``."""
    small_batches(docs.sparkSession)
    docs = docs.drop("lang_pred", "score")
    if not model.languages:
        return docs.withColumns({"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.withColumns({"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0)}).schema
    return docs.withColumn("__letter", _has_letter()).mapInArrow(_predict(shared), schema)


def learnable(docs: DataFrame, folds: int = 5, fold: int = 0) -> DataFrame:
    """Rows that may be learned from: those outside the held-out fold."""
    return docs.where(~held_out(F.col("doc_id"), folds, fold))
