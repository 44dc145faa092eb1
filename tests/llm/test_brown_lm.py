import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from covenant.llm import brown_lm
from tests.llm.corpora import documents, no_documents, texts, words


def is_held_out(key):
    return key is not None and zlib.crc32(str(key).encode()) % 7 == 2


def test_counts_and_base_score(spark):
    docs = documents(spark)
    model = brown_lm.train(brown_lm.training_rows(docs), number=8, sweeps=2)
    tokens = {n: words(t, fold=True) + [None] for n, (_, t) in enumerate(texts())}
    counts = Counter(x for n, (i, _) in enumerate(texts()) if not is_held_out(i) for x in tokens[n])
    total, distinct = sum(counts.values()), len(counts)
    wanted = Counter()
    for n, (i, _) in enumerate(texts()):
        base = sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in tokens[n])
        wanted[i, len(tokens[n]), sum(counts[x] > 0 for x in tokens[n]), total, round(base, 6)] += 1
    found = brown_lm.score(docs, model).collect()
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == wanted
    assert all(r.score < 0 for r in found)


def test_rare_words_are_counted_through_the_table(spark, monkeypatch):
    # With a share this large every word is looked up in the table instead of memory.
    docs = documents(spark)
    a = brown_lm.score(docs, brown_lm.train(docs, number=8, sweeps=1)).collect()
    monkeypatch.setattr(brown_lm, "KNOWN_SHARE", 1)
    monkeypatch.setattr(brown_lm, "UNIT_SHARE", 100)
    model = brown_lm.train(docs, number=8, sweeps=1)
    assert len(model.known) <= 2
    b = brown_lm.score(docs, model).collect()
    assert Counter((r.doc_id, r.n_known, round(r.base_score, 6)) for r in a) == Counter((r.doc_id, r.n_known, round(r.base_score, 6)) for r in b)


def test_probabilities_sum_to_one(spark):
    model = brown_lm.train(documents(spark), number=8, sweeps=2)
    assert np.allclose((10**model.transitions).sum(axis=1), 1)
    counts = model.counts.toPandas()
    classes = model.classes[model.units.of(counts["id"].to_numpy())]
    for c in set(classes):
        seen = (counts["n"][classes == c] + 1).sum() / 10 ** model.emission[c]
        assert seen <= 1 + 1e-9 and abs(seen + 1 / 10 ** model.emission[c] - 1) < 1e-9


def test_classes_learn_what_follows_what(spark):
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(f"{'ab'[n % 2]}{rng.integers(30)}" for n in range(60))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = brown_lm.train(brown_lm.training_rows(docs), number=5, sweeps=4)
    held = [r for r in brown_lm.score(docs, model).collect() if is_held_out(r.doc_id)]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.2 * sum(r.n_tokens for r in held)


def test_empty_tables(spark):
    docs = documents(spark)
    model = brown_lm.train(no_documents(spark))
    assert brown_lm.score(no_documents(spark), model).collect() == []
    found = brown_lm.score(docs, model).collect()
    assert len(found) == docs.count() and {(r.n_known, r.train_tokens, r.base_score) for r in found} == {(0, 0, 0.0)}


@pytest.mark.parametrize("known_share", [1_000_000, 1])
def test_words_below_the_shares_are_clustered(spark, monkeypatch, known_share):
    # No word has the shares, and all end in the same two bytes, so only clustering the words themselves tells them apart.
    monkeypatch.setattr(brown_lm, "UNIT_SHARE", 1)
    monkeypatch.setattr(brown_lm, "KNOWN_SHARE", known_share)
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(f"{'ab'[n % 2]}{rng.integers(30)}xx" for n in range(60))) for i in range(120)]
    docs = spark.createDataFrame(rows + rows[:2] + [(500, "new words here")], "doc_id bigint, text string")
    model = brown_lm.train(brown_lm.training_rows(docs), number=5, sweeps=4)
    scored = brown_lm.score(docs, model).collect()
    held = [r for r in scored if is_held_out(r.doc_id)]
    gain = sum(r.score for r in held) - sum(r.base_score for r in held)
    assert len(model.known) <= 2 or known_share > 1
    if known_share > 1:
        assert gain > 0.2 * sum(r.n_tokens for r in held)
    # Scores and transitions are those of the classes that the words have.
    table = {r["id"]: r for r in model.counts.collect()}
    ids = {w: int(i) for w, i in _ids({w for _, t in [*rows, (0, "new words here")] for w in t.split()}).items()}

    def class_of(word):
        i = int(brown_lm.END) if word is None else ids[word]
        row = table.get(i)
        return model.classes[model.units.of(np.array([i]))[0]] if row is None or row["class"] is None else row["class"]

    def count_of(word):
        return table[ids[word]]["n"] if word in ids and ids[word] in table else 0

    texts_of = Counter((r["doc_id"], r["text"]) for r in docs.collect())
    after = np.zeros((5, 5))
    for (i, text), copies in texts_of.items():
        tokens = [None, *text.split(), None]
        if not is_held_out(i):
            for x, y in zip(tokens, tokens[1:]):
                after[class_of(x), class_of(y)] += copies
    assert np.allclose(10**model.transitions, _smoothed(after))
    wanted = Counter()
    for (i, text), copies in texts_of.items():
        tokens = [None, *text.split(), None]
        total = 0.0
        for x, y in zip(tokens, tokens[1:]):
            n = table[int(brown_lm.END)]["n"] if y is None else count_of(y)
            total += model.transitions[class_of(x), class_of(y)] + math.log10(n + 1) - model.emission[class_of(y)]
        wanted[i, round(total, 5)] += copies
    assert Counter((r.doc_id, round(r.score, 5)) for r in scored) == wanted


def _ids(vocabulary):
    ordered = sorted(vocabulary)
    batch = pa.record_batch([pa.array([" ".join(ordered)])], names=["text"])
    return dict(zip(ordered, next(brown_lm._texts(iter([batch])))[1]))


def _smoothed(after):
    plain = (after.sum(axis=0) + 1) / (after.sum() + len(after))
    kinds = np.maximum((after > 0).sum(axis=1), 1)
    return (after + kinds[:, None] * plain) / (after.sum(axis=1) + kinds)[:, None]


def test_classes_grow_with_the_vocabulary():
    assert brown_lm.classes_for(300) == brown_lm.CLASSES < brown_lm.classes_for(1_000_000) < brown_lm.classes_for(50_000_000)
