import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from covenant.llm import merkle
from tests.llm.corpora import ASCII_LOWER, documents, no_documents, rows


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    values = [doc_id, source, lang, n_chars, text]
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def siblings(tree, place):
    out = []
    for nodes in tree[:-1]:
        first = place - place % 8
        out.append(("".join(nodes[first:place]), "".join(nodes[place + 1 : first + 8])))
        place //= 8
    return out


def brute_force(docs, tampered):
    """docs: (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for doc in docs:
        groups[doc[2]].append((doc[0] is not None, doc[0] or 0, leaf(*doc), doc))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: r[:3])
        trees[name] = levels([r[2] for r in groups[name]])
    top = levels([trees[name][-1][0] for name in names])
    out = []
    for at, name in enumerate(names):
        for place, (_, _, own, doc) in enumerate(groups[name]):
            path = siblings(trees[name], place) + siblings(top, at)
            now = own
            if tampered(doc) and doc[4] is not None:
                now = leaf(*doc[:4], doc[4].translate(ASCII_LOWER))
            for before, after in path:
                now = digest(before + now + after)
            proof = digest("".join(a + b for a, b in path))
            out.append((doc[0], own, trees[name][-1][0], top[-1][0], proof, now, now == top[-1][0]))
    return Counter(out)


def third(doc):
    return doc[0] is not None and zlib.crc32(str(doc[0]).encode()) % 3 == 0


def found(df):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return Counter(tuple(r) for r in merkle.verify(df, tampered=tampered).collect())


def test_matches_brute_force(spark):
    docs = [(r[0], r[3], r[2], r[4], r[1]) for r in rows()]
    assert found(documents(spark)) == brute_force(docs, third)


@pytest.mark.parametrize("size", [1, 8, 9, 512, 513, 4100])
def test_trees_of_several_tiers(spark, size):
    docs = [(i, f"s{i % 3}", "one" if i % 5 else "ä", i % 7, f"Text {i}" if i % 11 else None) for i in range(size)]
    docs += [(size + i, None, None, None, "") for i in range(3)]
    df = spark.createDataFrame(docs, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    assert found(df.repartition(5)) == brute_force(docs, third)


def test_equal_rows_and_groups_as_many_as_rows(spark):
    docs = [(7, "s", "x", 1, "Same")] * 30 + [(None, "s", "x", 1, "Other")] * 20 + [(i, "s", f"lang{i}", 1, "T") for i in range(600)]
    df = spark.createDataFrame(docs, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    assert found(df.repartition(3)) == brute_force(docs, third)


def test_empty_table(spark):
    df = merkle.verify(no_documents(spark))
    assert df.collect() == [] and "verified" in df.columns


def test_proofs_of_single_rows_and_missing_ones(spark):
    digests = [(i, digest(str(i))) for i in range(700)]
    named = spark.createDataFrame(digests, "key bigint, leaf string").withColumn("tree", F.lit("t"))
    placed = merkle.numbered(named, ["key"])
    manifest = merkle.build(placed)
    wanted = placed.where("key IN (0, 511, 512, 699)").select("tree", "position", "leaf", F.lit("x").alias("proof_sha256"))
    got = merkle.proofs(manifest, wanted).collect()
    assert len(got) == 4
    for row in got:
        path = merkle.read_path(row["proof"])
        assert merkle.pack_path(path) == row["proof"]
        assert merkle.fold(row["leaf"], path) == manifest.root
        assert merkle.fold(digest("forged"), path) != manifest.root
    with pytest.raises(Exception, match="no block"):
        merkle.proofs(manifest, wanted.withColumn("position", F.lit(10**6).cast("bigint"))).collect()


@pytest.mark.parametrize("height", [1, 2, 3, 4, 5, 6])
def test_layout_is_the_address_arithmetic(height):
    places = merkle.layout(height)
    every = sorted(int(x) for level in places for x in level)
    assert every == list(range(len(every)))
    for depth, level in enumerate(places):
        for node in {0, len(level) // 3, len(level) - 1}:
            assert merkle.address(height, depth, node) == level[node]


def test_subtrees_below_half_height_are_contiguous():
    places = merkle.layout(4)
    for subtree in range(64):
        own = [places[2][subtree], *places[3][8 * subtree : 8 * subtree + 8]]
        assert [int(x) for x in own] == list(range(9 + 9 * subtree, 18 + 9 * subtree))
