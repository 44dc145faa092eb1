"""Small awkward corpora: nulls, empty and long texts, repeated rows, ties, and columns whose names clash."""

from __future__ import annotations

import random
import re

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, row bigint, score string, window string, "
    "kept_text string, n_words string, component_id string, kept string, ranges string, lang_pred string, items string"
)

ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
SPACES = r"[^\x20\x09-\x0D]+"


def sentence(rng: random.Random, words: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def texts(seed: int = 5) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    shared = sentence(rng, 120)
    base = sentence(rng, 300)
    changed = base.split()
    changed[10] = "Other"
    out: list[tuple[int | None, str | None]] = [
        (0, None),
        (1, ""),
        (2, " \t\n\x0b\f\r "),
        (3, base),
        (4, base),
        (5, " ".join(changed)),
        (6, sentence(rng, 40) + "\n" + shared + " " + sentence(rng, 30)),
        (7, shared + "  tail Ünïcode Ärger \U0001f600"),
        (8, "the " * 700),
        (9, "a"),
        (10, "One two"),
        (11, "12 34 !! ??"),
        (12, sentence(rng, 6000, 50_000)),
        (13, sentence(rng, 20) + " " + shared[:500] + " " + shared[:500]),
        (14, base.upper()),
        (15, "x" * 5000),
        (3, base),
        (20, shared),
        (20, sentence(rng, 50)),
        (None, base),
        (None, None),
    ]
    out += [(100 + i, sentence(rng, rng.randrange(1, 60))) for i in range(30)]
    return out


def rows(seed: int = 5) -> list[tuple]:
    languages = ["en", "fr", None]
    return [
        (i, t, languages[n % 3], f"s{n % 2}", None if t is None else len(t), n, "x", "y", "z", "q", "c", "k", "r", "l", "i")
        for n, (i, t) in enumerate(texts(seed))
    ]


def documents(spark, seed: int = 5):
    return spark.createDataFrame(rows(seed), SCHEMA).repartition(4)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text: str | None, pattern: str = SPACES, fold: bool = False) -> list[str]:
    text = text or ""
    return re.findall(pattern, text.translate(ASCII_LOWER) if fold else text)
