import math
import random
import re
from collections import Counter

import pytest

from covenant.llm import licenses
from tests.llm.corpora import documents, no_documents, sentence, texts, words

PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def corpus():
    rng = random.Random(8)
    notices = [n.replace("[", "").replace("]", "") for _, n in [*licenses.BASE, *licenses.OWN]]
    out = [(200 + i, f"{sentence(rng, rng.randrange(0, 30))}. {n.title()}! {sentence(rng, 5)}") for i, n in enumerate(notices)]
    out += [
        (300, "all rights reserved. ALL RIGHTS RESERVED, all rights  reserved all all rights reserved"),
        (301, "All rights, reserved"),
        (302, "all right reserved all rights ünreserved"),
        (303, "general public license"),
        (304, "GNU General Public License, version 3"),
        (305, "the GNU Lesser General Public License and CC BY-NC 4.0 and cc by"),
        (306, "unauthorized copying of this file via any medium is strictly"),
        (307, "unauthorized copying of that thing by any means was strictly prohibited"),
        (308, "strictly prohibited"),
        (309, " ".join(notices) * 20),
        (310, "word " * 30_000 + "cc by"),
        (310, "word " * 30_000 + "cc by"),
        (None, "cc-by"),
    ]
    return out + texts()


def brute_force(docs, base, own):
    notices = licenses.parse([*base, *own])
    tokens = [words(t, PATTERN, fold=True) for _, t in docs]
    seen = Counter(w for ws in tokens for w in set(ws))
    labels = {label for label, _ in base}
    out = []
    for (key, _), ws in zip(docs, tokens, strict=True):
        starts, found, best = [], set(), 0.0
        for notice in notices:
            weight = [math.log((len(docs) + 1) / (seen[w] + 1)) + 1 for w in notice.words]
            for start in range(-len(notice.words), len(ws)):
                here = [0 <= start + k < len(ws) and ws[start + k] == w for k, w in enumerate(notice.words)]
                if all(h for h, needed in zip(here, notice.keys, strict=True) if needed):
                    found.add(notice.label)
                    best = max(best, round(sum(x for x, h in zip(weight, here, strict=True) if h) / sum(weight), 5))
                    if notice.label in labels:
                        starts.append(start)
        out.append(
            (key, len(ws), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(found & labels)), ",".join(sorted(found)), best)
        )
    return Counter(out)


def found(df):
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels"]
    return Counter((*[r[n] for n in names], round(r["score"], 5)) for r in df.collect())


def test_matches_brute_force(spark):
    docs = corpus()
    schema = "doc_id bigint, text string, labels string, places string, score string, n_words string"
    df = spark.createDataFrame([(*d, "a", "b", "c", "d") for d in docs], schema).repartition(6)
    got = licenses.licences(df)
    assert len(got.columns) == len(set(got.columns))
    assert found(got) == brute_force(docs, licenses.BASE, licenses.OWN)


def test_own_templates(spark):
    base, own = [("one", "[w1 w2]"), ("same", "[w3]")], [("far", "[w1] w2 w3 [w4]"), ("twice", "[w5 w5]"), ("never", "[nothing here] w1")]
    rng = random.Random(2)
    docs = [(i, sentence(rng, 80, 7)) for i in range(40)] + [(50, "w5 w5 w5"), (51, "w1 x x w4"), (52, "w1"), (53, "w2 w3 w4")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert found(licenses.licences(df, base, own)) == brute_force(docs, base, own)


def test_places_of_a_notice(spark):
    df = spark.createDataFrame([(1, "the apache license version 2 0, and all rights reserved")], "doc_id bigint, text string")
    row = licenses.licences(df).first()
    assert [(p["label"], p["start"], p["words"]) for p in row["places"]] == [("apache-2.0", -2, 8), ("reserved", 7, 3)]
    assert row["places"][0]["score"] < 1.0 == row["places"][1]["score"]


def test_empty_table_and_no_key_phrase(spark):
    assert licenses.licences(no_documents(spark)).collect() == []
    assert set(documents(spark).columns) <= set(licenses.licences(documents(spark)).columns)
    with pytest.raises(ValueError, match="no key phrase"):
        licenses.parse([("x", "some words")])


def test_words_are_the_pattern():
    import numpy as np

    text = "A1-bé!× {x}~_[]`/:@\x7f中文 Z9"
    data = np.frombuffer(text.encode(), np.uint8)
    split = licenses.split_words(data, np.array([0, len(data)]), fold=True, inside=licenses._WORD)
    assert [data[a:b].tobytes().decode().lower() for a, b in zip(split.starts, split.ends, strict=True)] == re.findall(PATTERN, text.lower())
