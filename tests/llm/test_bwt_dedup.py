import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from covenant.llm import bwt_dedup
from tests.llm.corpora import documents, no_documents, texts


def brute_force(docs, length):
    data = [(key, (text or "").encode()) for key, text in docs]
    counts = Counter(x[i : i + length] for _, x in data for i in range(len(x) - length + 1))
    out = Counter()
    for key, x in data:
        gone = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if counts[x[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(x, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[key, len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def check(found):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found.collect())


@pytest.mark.parametrize(
    "length, gram, limits", [(400, 200, (bwt_dedup.ANCHOR_BYTES, bwt_dedup.TASK_BYTES)), (60, 20, (1, 1 << 20)), (60, 20, (1, 1))]
)
def test_matches_brute_force(spark, length, gram, limits):
    # With limits of 1 every anchor is settled by its windows' hashes, in its task or across tasks.
    found = bwt_dedup.remove_repeated_bytes(documents(spark), length, gram, *limits)
    assert check(found) == brute_force(texts(), length)
    assert "row" in found.columns


def test_empty_table(spark):
    assert bwt_dedup.remove_repeated_bytes(no_documents(spark)).collect() == []


def test_suffix_order_is_the_sorted_order():
    rng = random.Random(0)
    for alphabet in ("ab", "a", "abcdefgh"):
        parts = [bytes(rng.choice(alphabet.encode()) for _ in range(rng.randrange(1, 60))) for _ in range(9)]
        symbols, finish = [], []
        for n, part in enumerate(parts):
            symbols += [b + len(parts) for b in part] + [n]
            finish += [len(symbols) - 1] * (len(part) + 1)
        plain = np.array([s - len(parts) + 1 if s >= len(parts) else 0 for s in symbols])
        found = bwt_dedup.suffix_order(plain, np.repeat(np.unique(finish), [len(p) + 1 for p in parts]))
        assert found.tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:])


@pytest.mark.parametrize("length, wide", [(1, 0), (3, 0), (3, 12), (20, 2), (30, 12)])
def test_expansion_finds_all_repeats(length, wide):
    rng = random.Random(length)
    shared = bytes(rng.choice(b"abc") for _ in range(90))
    for _ in range(30):
        parts = [bytes(rng.choice(b"abc") for _ in range(rng.randrange(0, 50))) for _ in range(5)]
        parts += [shared[a : a + rng.randrange(1, 60)] + b"z" for a in (0, 10, 30)] + [b"q" * 45]
        counts = Counter(p[i : i + length] for p in parts for i in range(len(p) - length + 1))
        wanted = [[i for i in range(len(p) - length + 1) if counts[p[i : i + length]] > 1] for p in parts]
        assert [x.tolist() for x in bwt_dedup.repeated_starts(parts, length, wide)] == wanted
        long = [(0, 0, 0, p) for p in parts if len(p) >= length]
        if long:
            wanted = [w for w, p in zip(wanted, parts, strict=True) if len(p) >= length]
            assert [x.tolist() for x in bwt_dedup.repeated_windows(long, length)] == wanted


@pytest.mark.parametrize("alphabet", ["a", "ab", "abcdefghij"])
def test_expansion_from_the_anchor_finds_all_repeats(alphabet):
    length, gram = 24, 8
    rng = random.Random(len(alphabet))
    base = [rng.choice(alphabet) for _ in range(150)]
    variants = set()
    for _ in range(60):
        text = base[rng.randrange(60) : rng.randrange(90, 150)]
        for _ in range(rng.randrange(4)):
            text[rng.randrange(len(text))] = rng.choice(alphabet + "\0")
        data = "".join(text).encode()
        rows = bwt_dedup.anchors(np.frombuffer(data, np.uint8), np.array([0, len(data)]), length, gram)
        variants |= {(a, data[s : s + m + length]) for a, s, m in zip(*(x.tolist() for x in rows[1:]), strict=True)}
    variants = sorted(variants)
    groups, parts = [a for a, _ in variants], [t for _, t in variants]
    counts = Counter(t[i : i + length] for t in parts for i in range(len(t) - length + 1))
    wanted = [[i for i in range(len(t) - length + 1) if counts[t[i : i + length]] > 1] for t in parts]
    assert any(wanted) or alphabet == "a"
    found = bwt_dedup.anchored_ranges(parts, groups, np.array(groups, np.uint64), length, gram)
    assert found == [bwt_dedup.as_ranges(np.array(w, int)) for w in wanted]
    assert [x.tolist() for x in bwt_dedup.repeated_starts(parts, length)] == wanted


def test_many_variants_of_one_anchor_are_expanded_together():
    rng = random.Random(1)
    middle = bytes(rng.randrange(97, 123) for _ in range(260))
    parts = sorted({bytes(rng.randrange(97, 99) for _ in range(100)) + middle + bytes(rng.randrange(97, 99) for _ in range(120)) for _ in range(6000)})
    # Texts of 480 bytes that share 260 and a few more: none holds 400 that another does.
    data = np.frombuffer(parts[0], np.uint8)
    anchor = bwt_dedup.span_hashes(data, 200)[110]
    assert bwt_dedup.anchored_ranges(parts, [0] * len(parts), np.full(len(parts), anchor), 400, 200) == [b""] * len(parts)
    # More than the half megabyte beyond which every window of an anchor was hashed by itself.
    assert bwt_dedup.ANCHOR_BYTES > sum(map(len, parts)) > 1 << 19


def test_anchors_cover_every_window_once():
    rng = np.random.default_rng(0)
    sizes = [0, 10, 900, 399, 400, 2500]
    data = rng.integers(97, 100, sum(sizes)).astype(np.uint8)
    offsets = np.r_[0, np.cumsum(sizes)]
    row, _, start, more = bwt_dedup.anchors(data, offsets, 400, 200)
    seen = Counter((r, w) for r, s, m in zip(row, start, more, strict=True) for w in range(s, s + m + 1))
    assert seen == Counter((r, w) for r, n in enumerate(sizes) for w in range(n - 400 + 1))
