import numpy as np
import pytest

from covenant.llm import ann

SCHEMA = "vec_id bigint, embedding array<float>, label int, list bigint, shard int"


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(x) for x in v], 0, 1, 2) for i, v in zip(ids, vectors, strict=True)], SCHEMA)


def results(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def test_recall_and_scores(spark):
    rng = np.random.default_rng(0)
    vectors = (rng.standard_normal((1500, 24)) * rng.uniform(0.5, 2, (1500, 1))).astype(np.float32)
    given = table(spark, vectors)
    found = results(ann.nearest_neighbours(given, given.where("vec_id % 20 = 0"), 10))
    exact = vectors.astype(float)
    hits = 0
    for query, rows in found.items():
        assert [r[0] for r in rows] == list(range(1, 11)) and query not in [r[1] for r in rows]
        assert all(abs(s - exact[i] @ exact[query]) < 1e-12 for _, i, s in rows)
        assert rows == sorted(rows, key=lambda r: (-r[2], r[1]))
        hits += len({r[1] for r in rows} & set(ann.exact_neighbours(exact, np.arange(1500), exact[query], query, 10)))
    assert len(found) == 75 and hits >= 0.9 * 750


def test_all_lists_give_ties_to_smaller_ids(spark):
    rng = np.random.default_rng(1)
    vectors = np.r_[np.repeat(rng.standard_normal((1, 8)), 300, axis=0), rng.standard_normal((60, 8))].astype(np.float32)
    ids = rng.permutation(360)
    given = table(spark, vectors, ids)
    found = results(ann.nearest_neighbours(given, given.where("vec_id % 40 = 0"), 5, probe_share=1.0))
    exact = vectors.astype(float)
    for at in np.flatnonzero(ids % 40 == 0):
        scores = (exact * exact[at]).sum(axis=1)
        order = [int(i) for i in ids[np.lexsort((ids, -scores))] if i != ids[at]][:5]
        assert [r[1] for r in found[int(ids[at])]] == order


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [1.0, None])]
    rows += [(9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (2, [0.5, 0.5]), (2, [2.0, 0.0]), (1, [1.0, 0.0])]
    given = spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], SCHEMA)
    found = results(ann.nearest_neighbours(given, given, 20))
    assert found == {1: [(1, 2, 2.0)], 2: [(1, 1, 2.0)]}


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert ann.nearest_neighbours(empty, empty, 3).collect() == []


def test_every_size_is_searched(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.standard_normal(3 if i % 3 else 5)]) for i in range(60)] + [(60, [1.0, 2.0])]
    given = spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], SCHEMA)
    found = results(ann.nearest_neighbours(given, given, 4, probe_share=1.0))
    assert set(found) == set(range(60))
    for query, own in rows[:60]:
        same = [(i, np.dot(np.float32(v).astype(float), np.float32(own).astype(float))) for i, v in rows if len(v) == len(own) and i != query]
        assert [r[1] for r in found[query]] == [i for i, _ in sorted(same, key=lambda x: (-x[1], x[0]))[:4]]


@pytest.mark.parametrize("number", [48, 64])
def test_scans_on_until_enough_are_found(spark, number):
    # Small clusters far apart: the nearest lists hold fewer than k vectors.
    rng = np.random.default_rng(4)
    vectors = np.eye(8)[rng.integers(0, 8, number)] * 10 + rng.standard_normal((number, 8)) * 0.01
    given = table(spark, vectors)
    found = results(ann.nearest_neighbours(given, given, number - 2, probe_share=0.01))
    assert {len(r) for r in found.values()} == {number - 2} and len(found) == number
    assert {len(r) for r in results(ann.nearest_neighbours(given, given, number, probe_share=0.01)).values()} == {number - 1}


def test_repeated_ids_leave_room_for_others(spark):
    rng = np.random.default_rng(5)
    vectors = np.r_[np.ones((200, 6)) * 3, rng.standard_normal((40, 6))]
    given = table(spark, vectors, [7] * 200 + list(range(100, 140)))
    found = results(ann.nearest_neighbours(given, given, 10, probe_share=0.01))
    assert len(found) == 41 and all(len({r[1] for r in rows}) == 10 for rows in found.values())


@pytest.mark.parametrize("columns", [4, 16])
def test_scan_without_abandoning_is_exact(monkeypatch, columns):
    monkeypatch.setattr(ann, "COLUMNS", columns)
    monkeypatch.setattr(ann, "SURENESS", 1e9)
    monkeypatch.setattr(ann, "TILE", (7, 50))
    rng = np.random.default_rng(2)
    vectors, ids = rng.standard_normal((333, 20)), rng.permutation(333)
    member, probed = rng.integers(0, 5, 333), rng.random((30, 5)) < 0.7
    longest = float(np.sqrt((vectors**2).sum(axis=1)).max())
    query, found, _ = ann.scan(vectors[:30], ids[:30], probed, ids, vectors, member, 6, longest)
    for q in range(30):
        allowed = probed[q][member] & (ids != ids[q])
        order = ids[allowed][np.argsort(-(vectors[allowed] @ vectors[q]))][:6]
        assert sorted(found[query == q].tolist()) == sorted(order.tolist())
