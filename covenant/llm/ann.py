"""Nearest neighbours by largest inner product: inverted lists, scanned with adaptive dimension tests.

Vectors are lifted by one component that makes all of them equally long, so that the nearest by distance have the largest
inner product. Lists are formed around centroids fitted on a bounded sample; every vector is in one of them. A list is cut
into blocks of bounded size. Within a block the lifted vectors are rotated at random and scanned in blocks of columns: the
distance so far, scaled up to all dimensions, is tested against the distance of the k-th found, and candidates that the test
rejects are abandoned. What survives is measured in double precision on the vectors as given.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covenant.session import scratch_path, written

#: Vectors the centroids are fitted on.
SAMPLE = 32_768
#: Share of the lists that a query scans. Vectors without clusters need about half of them for a recall of 0.9.
PROBE_SHARE = 0.6
#: Vectors of a list that stay together, vectors of a shard (on average), and queries that meet a shard at a time.
PART = 4_096
SHARD = 16_384
QUERY_BLOCK = 8_192
#: Columns between two tests, and standard deviations of the partial distance that a test allows for.
COLUMNS = 16
SURENESS = 2.1
#: Queries and vectors of a tile, and the share of a tile below which its candidates are looked at one by one.
TILE = (256, 2_048)
FEW = 0.1
ROUNDS = 8
SEED = 11


@dataclass
class Lists:
    """Centroids, the length of the longest vector, and, once known, into how many parts each list is cut and how many ids
    it adds for certain to those of any other lists."""

    centroids: np.ndarray
    longest: float
    parts: np.ndarray | None = None
    ids: np.ndarray | None = None
    shards: int = 1


def _lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with one more component, so that all have the length of the longest."""
    room = np.maximum(longest**2 - (vectors**2).sum(axis=1), 0)
    return np.c_[vectors, np.sqrt(room)]


def _as_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors that take part, as packed doubles, with their number of components and length."""
    for batch in batches:
        ids, packed, sizes, norms = [], [], [], []
        for key, vector in zip(batch.column("vec_id").to_pylist(), batch.column("embedding"), strict=True):
            values = vector.values
            if key is None or values is None or not len(values) or values.null_count:
                continue
            values = np.asarray(values.to_numpy(zero_copy_only=False), "<f8")
            if np.isfinite(values).all() and values.any():
                ids.append(key)
                packed.append(values.tobytes())
                sizes.append(len(values))
                norms.append(float(np.sqrt((values**2).sum())))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(packed, pa.binary()), pa.array(sizes, pa.int32()), pa.array(norms, pa.float64())],
            names=["vec_id", "vector", "size", "norm"],
        )


def _fit(sample: np.ndarray, number: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids by k-means; empty ones move to vectors of the sample."""
    random = np.random.default_rng(SEED)
    centroids = sample[random.choice(len(sample), number, replace=False)]
    for _ in range(rounds):
        nearest = _nearest(sample, centroids, 1)[:, 0]
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        counts = np.bincount(nearest, minlength=number)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], sample[random.choice(len(sample), number)])
    return centroids


def _nearest(vectors: np.ndarray, centroids: np.ndarray, number: int) -> np.ndarray:
    out = []
    for start in range(0, len(vectors), 4096):
        part = vectors[start : start + 4096]
        distance = (centroids**2).sum(axis=1) - 2 * part @ centroids.T
        out.append(np.argsort(distance, axis=1, kind="stable")[:, :number])
    return np.concatenate(out) if out else np.zeros((0, number), int)


def _assign(shared):
    """Arrow map: vectors to their list."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists: Lists = shared.value
        for batch in batches:
            if batch.num_rows:
                found = _nearest(_lifted(_as_matrix(batch.column("vector")), lists.longest), lists.centroids, 1)[:, 0]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("vector"), pa.array(found.astype(np.int64))], names=["vec_id", "vector", "list"]
                )

    return assign


def _probe(shared, probes: int, k: int):
    """Arrow map: queries to a row per shard that has parts of the lists they scan, with those lists: the ``probes`` nearest,
    and the next ones until they hold k ids besides the query's own, or all."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists: Lists = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _as_matrix(batch.column("vector"))
            # A query's further component is zero.
            found = _nearest(np.c_[vectors, np.zeros(len(vectors))], lists.centroids, len(lists.centroids))
            enough = (np.cumsum(lists.ids[found], axis=1) <= k).sum(axis=1) + 1
            rows, shards, chosen = [], [], []
            for i, own in enumerate(found):
                own = own[: max(probes, enough[i])]
                of = np.repeat(own, lists.parts[own])
                part = np.arange(len(of)) - np.repeat(np.cumsum(lists.parts[own]) - lists.parts[own], lists.parts[own])
                shard = (of + part) % lists.shards
                for value in np.unique(shard):
                    rows.append(i)
                    shards.append(int(value))
                    chosen.append(np.unique(of[shard == value]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(shards, pa.int64()), batch.column("vec_id").take(pa.array(rows, pa.int64())), batch.column("vector").take(pa.array(rows, pa.int64())), pa.array(chosen, pa.list_(pa.int64()))],
                names=["shard", "vec_id", "vector", "lists"],
            )

    return probe


def scan(
    queries: np.ndarray, own: np.ndarray, probed: np.ndarray, ids: np.ndarray, vectors: np.ndarray, member: np.ndarray, k: int, longest: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest of each query among the vectors of its lists: query, id and inner product.

    ``probed[q, l]`` tells whether query q scans list l, ``member`` is the list of each vector. Ties go to smaller ids;
    of vectors with one id the nearest counts.
    """
    size = vectors.shape[1] + 1
    rotation = np.linalg.qr(np.random.default_rng(SEED).standard_normal((size, size)))[0]
    order = np.argsort(ids, kind="stable")
    ids, vectors, member = ids[order], vectors[order], member[order]
    repeated = bool((ids[1:] == ids[:-1]).any())
    edges = [*range(0, size, COLUMNS), size]
    spans = list(zip(edges, edges[1:], strict=False))
    rotated = _lifted(vectors, longest) @ rotation
    turned = np.c_[queries, np.zeros(len(queries))] @ rotation
    lengths = (queries**2).sum(axis=1) + longest**2
    out = []
    for top in range(0, len(queries), TILE[0]):
        asked = slice(top, top + TILE[0])
        turned_here, given = turned[asked], queries[asked]
        limit = np.full(len(given), np.inf)
        row, place, score = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        for left in range(0, len(ids), TILE[1]):
            here = slice(left, left + TILE[1])
            r, c = _survivors(turned_here, rotated[here], probed[asked][:, member[here]] & (own[asked][:, None] != ids[here]), limit, spans)
            if not len(r):
                continue
            row, place = np.r_[row, r], np.r_[place, c + left]
            score = np.r_[score, (vectors[c + left] * given[r]).sum(axis=1)]
            if repeated:
                by = np.lexsort((-score, ids[place], row))
                row, place, score = row[by], place[by], score[by]
                first = np.r_[True, (row[1:] != row[:-1]) | (ids[place[1:]] != ids[place[:-1]])]
                row, place, score = row[first], place[first], score[first]
            by = np.lexsort((place, -score, row))
            row, place, score = row[by], place[by], score[by]
            begin = np.searchsorted(row, np.arange(len(given) + 1))
            rank = np.arange(len(row)) - begin[row]
            row, place, score = row[rank < k], place[rank < k], score[rank < k]
            begin = np.searchsorted(row, np.arange(len(given) + 1))
            full = np.flatnonzero(np.diff(begin) == k)
            limit[full] = lengths[asked][full] - 2 * score[begin[full] + k - 1]
        out.append((row + top, ids[place], score))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _survivors(queries: np.ndarray, vectors: np.ndarray, alive: np.ndarray, limit: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a tile that no test rejects. The distance over the columns so far is tested, scaled up, against the limit with
    a margin that shrinks with the columns; over all columns there is no margin. Few pairs left are gathered."""
    partial = np.zeros(alive.shape)
    pairs: tuple[np.ndarray, np.ndarray] | None = None
    apart = np.zeros(0)
    for a, b in spans:
        last = b == spans[-1][1]
        bound = limit * (1 if last else (1 + SURENESS / np.sqrt(b)) ** 2 * b / spans[-1][1]) + 1e-9
        if pairs is None:
            x, q = vectors[:, a:b], queries[:, a:b]
            partial += (q**2).sum(axis=1)[:, None] - 2 * q @ x.T + (x**2).sum(axis=1)
            alive &= partial <= bound[:, None]
            if alive.mean() < FEW:
                pairs = alive.nonzero()
                apart = partial[pairs]
        else:
            r, c = pairs
            apart = apart + ((vectors[c, a:b] - queries[r, a:b]) ** 2).sum(axis=1)
            stay = apart <= bound[r]
            pairs, apart = (r[stay], c[stay]), apart[stay]
    return alive.nonzero() if pairs is None else pairs


def _search(k: int, shared):
    """Arrow map: rows in order of (shard, query block) to neighbours. One such group is in memory at a time: a shard's
    vectors and at most about QUERY_BLOCK queries."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists: Lists = shared.value
        group, held = None, []

        def done() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            is_query = rows.column("is_query").to_numpy(zero_copy_only=False)
            keys, matrix = rows.column("vec_id").to_numpy(), _as_matrix(rows.column("vector"))
            asked, given = np.flatnonzero(is_query), np.flatnonzero(~is_query)
            if not len(asked) or not len(given):
                return
            chosen = rows.column("lists")
            flat = chosen.flatten().to_numpy()
            counts = np.diff(chosen.offsets.to_numpy())
            owner = np.repeat(np.arange(len(keys)), counts)
            probed = np.zeros((len(keys), len(lists.centroids)), bool)
            probed[owner, flat] = True
            member = flat[np.cumsum(counts)[given] - 1]
            query, found, score = scan(matrix[asked], keys[asked], probed[asked], keys[given], matrix[given], member, k, lists.longest)
            yield pa.RecordBatch.from_arrays([pa.array(keys[asked][query]), pa.array(found), pa.array(score)], names=["query_id", "vec_id", "score"])

        for batch in batches:
            groups = list(zip(batch.column("shard").to_pylist(), batch.column("query_part").to_pylist(), strict=True))
            edges = [0, *[i for i in range(1, len(groups)) if groups[i] != groups[i - 1]], len(groups)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if groups[a] != group:
                    if held:
                        yield from done()
                    group, held = groups[a], []
                held.append(batch.slice(a, b - a))
        if held:
            yield from done()

    return search


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int, probe_share: float = PROBE_SHARE, sample: int = SAMPLE) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the largest inner product with each row of ``queries``: (query_id, rank, vec_id, score).

    Both are (vec_id, embedding); other columns are ignored. Rows with a query's own id are no candidates. Vectors that are
    null, empty, zero, or hold null or non-finite components take no part. A query's candidates are the vectors of its size;
    each size has its own lists, and its own few jobs. Rows that share an id count once, the nearest of them. Ties go to
    smaller ids. Every vector is indexed; there are about as many lists as the root of the number of vectors, and at most one for
    16 vectors of the sample, which is the rows with the smallest hashes of their ids. A query scans ``probe_share`` of the
    lists, those nearest to it, and more until they hold ``k`` ids, so it gets ``k`` rows, or all candidates if they are
    fewer. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    schema = "vec_id bigint, vector binary, size int, norm double"
    found = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")

    def cleaned(df: DataFrame) -> DataFrame:
        return df.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").mapInArrow(_clean, schema)

    clean = written(cleaned(vectors), scratch_path(spark, "vectors"))
    asked = written(cleaned(queries), scratch_path(spark, "queries"))
    # One row per size that has vectors and queries.
    sizes = clean.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("longest"))
    for row in sizes.join(asked.select("size").distinct(), "size").orderBy("size").collect():
        of_size = F.col("size") == row["size"]
        found = found.union(_of_one_size(clean.where(of_size), asked.where(of_size), row["n"], row["longest"], k, probe_share, sample))
    return found


def _of_one_size(clean: DataFrame, asked: DataFrame, total: int, longest: float, k: int, probe_share: float, sample: int) -> DataFrame:
    """The search among vectors of one size, ``total`` in number."""
    spark = clean.sparkSession
    chosen = clean.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(sample).select("vector").toArrow().column("vector").combine_chunks()
    points = _lifted(_as_matrix(chosen), longest)
    number = max(1, min(int(np.sqrt(total)), len(points) // 16))
    lists = Lists(_fit(points, number), longest)
    placed = clean.select("vec_id", "vector").mapInArrow(_assign(spark.sparkContext.broadcast(lists)), "vec_id bigint, vector binary, list bigint")
    placed = written(placed, scratch_path(spark, "lists"))

    # One number per list: a list is cut into parts, which go to neighbouring shards.
    lists.parts, lists.ids, lists.shards = np.zeros(number, int), np.zeros(number, int), max(1, -(-total // SHARD))
    for row in placed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / PART).alias("parts")).collect():
        lists.parts[row["list"]] = min(row["parts"], lists.shards)
    # An id in several lists counts for one of them.
    for row in placed.groupBy("vec_id").agg(F.min("list").alias("list")).groupBy("list").count().collect():
        lists.ids[row["list"]] = row["count"]
    shared = spark.sparkContext.broadcast(lists)
    probes = max(1, int(np.ceil(number * probe_share)))
    probing = written(
        asked.select("vec_id", "vector").mapInArrow(_probe(shared, probes, k), "shard bigint, vec_id bigint, vector binary, lists array<bigint>"),
        scratch_path(spark, "probes"),
    )
    query_parts = max(1, -(-asked.count() // QUERY_BLOCK))
    parts = F.element_at(F.array(*[F.lit(int(p)) for p in lists.parts]), (F.col("list") + 1).cast("int"))
    given = placed.select(
        F.pmod(F.col("list") + F.pmod(F.xxhash64("vec_id", "vector"), parts), F.lit(lists.shards)).alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(query_parts - 1))).alias("query_part"),
        F.lit(False).alias("is_query"),
        "vec_id",
        "vector",
        F.array("list").alias("lists"),
    )
    wanted = probing.withColumns(
        {"query_part": F.pmod(F.xxhash64("vec_id", "vector"), F.lit(query_parts)).cast("int"), "is_query": F.lit(True)}
    )
    found = (
        given.union(wanted.select(*given.columns))
        .repartition("shard", "query_part")
        .sortWithinPartitions("shard", "query_part")
        .mapInArrow(_search(k, shared), "query_id bigint, vec_id bigint, score double")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (
        found.repartition("query_id")
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def exact_neighbours(vectors: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int) -> list[int]:
    """Brute force for one query, to measure recall against."""
    scores = vectors @ query
    order = np.lexsort((ids, -scores))
    return [int(i) for i in ids[order] if i != own][:k]
