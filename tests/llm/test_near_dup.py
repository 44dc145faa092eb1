from collections import Counter, defaultdict

import numpy as np

from covenant.llm import near_dup
from covenant.llm.components import components
from tests.llm.corpora import documents, no_documents, texts, words


def shingles(text, size):
    tokens = words(text, fold=True)
    if len(tokens) < size:
        return frozenset([tuple(tokens)]) if tokens else frozenset()
    return frozenset(tuple(tokens[i : i + size]) for i in range(len(tokens) - size + 1))


def brute_force(docs, size, percent):
    sets = [(key, shingles(text, size)) for key, text in docs]
    parent = {key: key for key, _ in sets if key is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if a is None or b is None or not s or not t:
                continue
            if 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return Counter((key, len(s), None if key is None else root(key), key is None or root(key) == key) for key, s in sets)


def check(spark, docs, size, percent):
    found = near_dup.near_duplicates(docs, size, percent).collect()
    return Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found)


def test_matches_brute_force(spark):
    assert check(spark, documents(spark), 3, 85) == brute_force(texts(), 3, 85)


def test_empty_table(spark):
    assert near_dup.near_duplicates(no_documents(spark)).collect() == []


def test_a_cluster_that_its_pivot_does_not_join(spark):
    # Chains of copies with growing edits: many are far from the first one, yet near each other.
    rng = np.random.default_rng(3)
    base = [f"t{i}" for i in range(300)]
    docs = []
    for chain in range(6):
        now = list(base)
        for step in range(12):
            docs.append((len(docs) + 1, " ".join(now)))
            for place in rng.choice(300, 4, replace=False):
                now[place] = f"c{chain}s{step}p{place}"
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert check(spark, table, 3, 85) == brute_force(docs, 3, 85)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    items = rng.integers(0, 1 << 63, 1200).astype(np.uint64)
    for common, size in ((1000, 1200), (500, 1000), (3, 5), (1, 1)):
        a, b = items[:common], items[:size]
        found = near_dup.superminhash([a, b], 256)
        assert abs((found[0] == found[1]).mean() - common / size) < 0.12


def test_signature_is_the_least_rank_of_all_elements():
    # Without early stopping: every element offers to every place.
    items = np.arange(7, 40, dtype=np.uint64)
    whole = near_dup.superminhash([items], 16)[0]
    each = near_dup.superminhash([items[i : i + 1] for i in range(len(items))], 16)
    assert (whole == each.min(axis=0)).all()


def test_bands_miss_little():
    for percent in (70, 80, 85, 95):
        rows = near_dup.band_rows(percent)
        assert (1 - (percent / 100) ** rows) ** near_dup.BANDS <= near_dup.MISS


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(400, 470)] + [(5, None)]
    edges += [(600, i) for i in range(601, 700)]
    groups = defaultdict(set)
    for a, b in edges:
        if b is None:
            continue
        merged = groups[a] | groups[b] | {a, b}
        for x in merged:
            groups[x] = merged
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {x: min(g) for x, g in groups.items() if len(g) > 1}
