import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from covenant.llm import spelling
from tests.llm.corpora import ASCII_LOWER, documents, no_documents, texts


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def words_of(docs, drop_every, least, times):
    counts = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(ASCII_LOWER)
            check = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if drop_every and check % drop_every == 0:
                run = run[: check % len(run)] + run[check % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= times}


def brute_force(words, ratio=2):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = []
    for w in words:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, words[w], len(near[w]), forms[w], None if forms[w] is None else words[forms[w]], root))
    return Counter(out)


def found(df):
    return Counter((r["word"], r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect())


def misspelt(seed=3):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcdéÿ×") for _ in range(rng.randrange(3, 9))) for _ in range(40)]
    out = []
    for key in range(60):
        words = []
        for _ in range(60):
            word = rng.choice(stems)
            if rng.random() < 0.4:
                at = rng.randrange(len(word))
                word = rng.choice([word[:at] + word[at + 1 :], word[:at] + "x" + word[at:], word[:at] + "y" + word[at + 1 :]])
            words.append(word.upper() if rng.random() < 0.1 else word)
        out.append((key, rng.choice([" ", "-", "\n", " 12 "]).join(words)))
    return [*out, (None, "abcde abcde abcde abcdf"), (99, None), (98, ""), (97, "z" * 6000 + " " + "z" * 5999 + "Z")] * 2


@pytest.mark.parametrize(("drop", "least", "times", "group"), [(0, 5, 3, 20_000), (7, 5, 3, 20_000), (7, 1, 1, 4), (3, 4, 2, 9)])
def test_matches_brute_force(spark, drop, least, times, group):
    docs = misspelt() + texts()
    df = spark.createDataFrame([(k, t, "x", "y") for k, t in docs], "doc_id bigint, text string, word string, n string").repartition(5)
    words = words_of(docs, drop, least, times)
    assert len(words) > 100
    got = spelling.variants(df, drop_every=drop, min_length=least, min_count=times, group_words=group)
    assert found(got) == brute_force(words)


def test_a_hot_half_is_split(spark):
    # All words share their first or their last half; pairs of several kinds, and one large group of words that are all near.
    words = {f"international{a}{b}": 3 + ord(a) % 5 for a in "abcdefghij" for b in "abcdefghij"}
    words |= {f"{a}{b}national": 4 for a in "abcdefgh" for b in "abcdefgh"} | {"international": 50, "internationala": 20}
    table = spark.createDataFrame(list(words.items()), "word string, n bigint")
    near = spelling.near_words(table, group_words=5)
    expected = brute_force(words)
    assert {(r["word"], r["n_near"], r["form"]) for r in near.collect()} == {(w, k, f) for w, _, k, f, _, _ in expected}


def test_chains_of_forms(spark):
    chain = [(f"word{'x' * i}", f"word{'x' * (i + 1)}") for i in range(20)] + [("alone", None), ("worda", "word")]
    got = spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()
    assert {r["word"]: r["root"] for r in got} == {w: "word" + "x" * 20 for w, f in chain if f}


def test_empty_tables(spark):
    assert spelling.variants(no_documents(spark)).collect() == []
    nothing = documents(spark).where("text IS NULL OR text = ''")
    assert spelling.variants(nothing, min_count=1).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("abé", min_size=1, max_size=6), min_size=1, max_size=40))
def test_search_of_one_list(words):
    import numpy as np
    import pyarrow as pa

    words = sorted(words)
    heads = np.arange(len(words)) == 0
    lists = spelling._Lists(pa.array(words), heads)
    query, entry = spelling._near(lists, np.arange(len(words)), np.zeros(len(words), np.int64))
    assert sorted(zip(query.tolist(), entry.tolist(), strict=True)) == [
        (i, j) for i, a in enumerate(words) for j, b in enumerate(words) if one_edit(a, b)
    ]
