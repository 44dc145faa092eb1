"""Near duplicates by SuperMinHash signatures, banding, exact verification, and connected components.

A signature value is the smallest of the correlated ranks of a set's elements at its place: element ``e`` visits the
places in its own random order and offers step number plus a random fraction at each. Elements stop as soon as no place
of the signature can still fall, which for large sets is after a few steps.

Documents with equal sets are one class. Classes that share a band are candidates; a bucket's smallest class is its
pivot, and every member is compared with it on the full sets. What is still apart in a pivot's cluster is compared block
by block, leaving out pairs that the triangle inequality (Jaccard distance is a metric) already rules out. So every pair
of a bucket is compared, ruled out, or already in one component, and no list of pairs is ever made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covenant.llm.common import gram_hashes, in_filter, mix, row_filter, row_key, signed, small_batches, split_words, text_slices
from covenant.llm.components import components
from covenant.session import scratch_path, written

#: Words of a shingle and least similarity in percent, unless a caller says otherwise.
SHINGLE = 5
PERCENT = 80
BANDS = 32
#: Largest chance that a pair of exactly the least similarity shares no band.
MISS = 1e-5
#: Shingles in a block of members that are compared with another block.
BLOCK_SHINGLES = 100_000
#: Steps in which the distance from the pivot is measured to tell blocks apart.
STEPS = 50

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFFFFFF)


def band_rows(percent: int, bands: int = BANDS, miss: float = MISS) -> int:
    """Most rows a band may have to keep the chance of missing a pair of the least similarity below ``miss``."""
    rows = 1
    while (1 - (percent / 100) ** (rows + 1)) ** bands <= miss:
        rows += 1
    return rows


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted hashes of the distinct shingles of each text; shorter texts are one shingle, empty ones have none."""
    words = split_words(data, offsets, fold=True)
    grams = gram_hashes(words.hashes, size, 1)
    out = []
    for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True):
        if b - a >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        else:
            out.append(gram_hashes(words.hashes[a:b], int(b - a), int(b - a) + 1) if b > a else grams[:0])
    return out


def superminhash(sets: list[np.ndarray], places: int) -> np.ndarray:
    """Signatures (sets x places) of non-empty sets; a value is the step in its upper and a fraction in its lower half."""
    sizes = np.array([len(s) for s in sets])
    values = np.full(len(sets) * places, ~np.uint64(0), np.uint64)
    # Sets of about the same size need about as many steps, so they are handled together.
    order = np.argsort(sizes, kind="stable")
    at = 0
    while at < len(order):
        upto = at + max(1, int(np.searchsorted(np.cumsum(sizes[order[at:]]), 200_000)))
        part = order[at:upto]
        _offer(values, np.concatenate([sets[i] for i in part]), np.repeat(part, sizes[part]), places)
        at = upto
    return values.reshape(len(sets), places)


def _offer(values: np.ndarray, elements: np.ndarray, owner: np.ndarray, places: int) -> None:
    chosen: list[np.ndarray] = []
    for step in range(places):
        random = mix(elements + np.uint64((step + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        pick = np.uint64(step) + (((random >> np.uint64(32)) * np.uint64(places - step)) >> np.uint64(32))
        # Place held at position ``pick`` of the element's shuffled order: undo the earlier swaps, last one first.
        place = pick.copy()
        for earlier in range(step - 1, -1, -1):
            place[place == chosen[earlier]] = earlier
        np.minimum.at(values, owner * places + place.astype(np.int64), (np.uint64(step) << np.uint64(32)) | (random & _LOW))
        chosen.append(pick)
        owners = np.unique(owner)
        worst = values.reshape(-1, places)[owners].max(axis=1)
        open_ = owners[worst >= np.uint64((step + 1) << 32)]
        if not len(open_):
            return
        if len(open_) < len(owners):
            still = np.zeros(owners[-1] + 1, bool)
            still[open_] = True
            keep = still[owner]
            elements, owner = elements[keep], owner[keep]
            chosen = [c[keep] for c in chosen]


def band_hashes(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = signatures[:, : bands * rows].reshape(-1, bands, rows)
    total = np.broadcast_to(np.arange(bands, dtype=np.uint64) * _GOLDEN, parts.shape[:2]).copy()
    for i in range(rows):
        total = mix(total ^ parts[:, :, i]) + _GOLDEN
    return total


def _describe(size: int, bands: int, rows: int):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column("text")):
                sets = shingle_sets(data, offsets, size)
                full = [i for i, s in enumerate(sets) if len(s)]
                found = band_hashes(superminhash([sets[i] for i in full], bands * rows), bands, rows) if full else None
                lists: list = [None] * len(sets)
                for place, i in enumerate(full):
                    lists[i] = signed(found[place])
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"),
                        part.column("doc_id"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([int(signed(mix(s).sum(keepdims=True))[0]) if len(s) else None for s in sets], pa.int64()),
                        pa.array([int(signed(np.bitwise_xor.reduce(mix(s + _GOLDEN), keepdims=True))[0]) if len(s) else None for s in sets], pa.int64()),
                        pa.array(lists, pa.list_(pa.int64())),
                    ],
                    names=["row", "doc_id", "n_shingles", "sum", "xor", "bands"],
                )

    return describe


def _needed_sets(size: int, bits):
    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(in_filter(batch.column("row"), bits.value)))
            for first, end, data, offsets in text_slices(batch.column("text")):
                sets = shingle_sets(data, offsets, size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(first, end - first), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["row", "items"],
                )

    return needed


def _with_pivot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a pivot and share, pivot first, to the overlap of each member with the pivot. One pivot in memory."""
    key, pivot = None, None
    for batch in batches:
        keys = list(zip(batch.column("pivot").to_pylist(), batch.column("share").to_pylist(), strict=True))
        members, items = batch.column("member").to_pylist(), batch.column("items")
        out: list[tuple[int, int, int, int, int]] = []
        for i, k in enumerate(keys):
            own = np.frombuffer(items[i].as_buffer(), np.uint64)
            if k != key:
                key, pivot = k, own
            if members[i] != k[0]:
                out.append((k[0], members[i], _overlap(pivot, own), len(pivot), len(own)))
        columns = zip(*out, strict=True) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["pivot", "member", "common", "pivot_size", "size"]
        )


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    return int((large[at] == small).sum())


def _between_blocks(percent: int):
    """Rows of one pair of blocks together to links between members in different components. One pair in memory."""

    def links(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        left = [r for r in rows if r[1]]
        right = [r for r in rows if not r[1]] or left
        tokens = np.concatenate([r[4] for r in right])
        holder = np.repeat(np.arange(len(right)), [len(r[4]) for r in right])
        order = np.argsort(tokens, kind="stable")
        tokens, holder = tokens[order], holder[order]
        sizes = np.array([len(r[4]) for r in right])
        distance = np.array([r[3] for r in right])
        label = np.array([r[5] for r in right])
        names = np.array([r[2] for r in right])
        for _, _, name, far, items, comp in left:
            ok = (np.abs(distance - far) <= 1 - percent / 100 + 1e-9) & (label != comp) & (names > name if right is left else True)
            ok &= (100 * np.minimum(sizes, len(items)) >= percent * np.maximum(sizes, len(items)))
            if not ok.any():
                continue
            a, b = np.searchsorted(tokens, items), np.searchsorted(tokens, items, "right")
            runs = b - a
            spots = np.repeat(a - np.r_[0, np.cumsum(runs)[:-1]], runs) + np.arange(runs.sum())
            common = np.bincount(holder[spots], minlength=len(right))
            hit = ok & (100 * common >= percent * (sizes + len(items) - common))
            for comp_hit in np.unique(label[hit]):
                # One link joins two components; more between the same two add nothing.
                yield name, int(names[hit & (label == comp_hit)][0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def done() -> pa.RecordBatch:
            pairs = list(links(held))
            return pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["a", "b"]
            )

        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in ("pair", "is_left", "member", "distance", "component")}
            items = batch.column("items")
            for i, k in enumerate(columns["pair"]):
                if k != key:
                    if held:
                        yield done()
                    key, held = k, []
                held.append((k, columns["is_left"][i], columns["member"][i], columns["distance"][i], np.frombuffer(items[i].as_py(), np.uint64), columns["component"][i]))
        if held:
            yield done()

    return run


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS, miss: float = MISS
) -> DataFrame:
    """Class and component of every document whose words' shingles overlap: (row, doc_id, n_shingles, component_id, kept).

    Takes (doc_id, text), other columns are ignored. A-Z are lower-cased; a text with fewer words than a shingle is one
    shingle, a text without words (or null) has none and is linked with nothing. Two documents are linked when
    ``100 * common >= percent * union`` of their shingle sets (64-bit hashes). ``component_id`` is the smallest doc_id
    that can be reached, ``kept`` tells whether that is the row's own. Rows that share a doc_id count as one document;
    rows without one are linked with nothing and kept, with a null component.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = band_rows(percent, bands, miss)
    keyed = docs.select(row_key("doc_id", "text").alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    described = written(
        keyed.mapInArrow(
            _describe(shingle, bands, rows),
            "row bigint, doc_id bigint, n_shingles bigint, sum bigint, xor bigint, bands array<bigint>",
        ),
        scratch_path(spark, "signatures"),
    )
    linkable = described.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # One class per set: named by its smallest document, whose row key finds the set again.
    classes = written(
        linkable.groupBy("sum", "xor", "n_shingles").agg(
            F.min(F.struct("doc_id", "row")).alias("first"), F.count(F.lit(1)).alias("copies")
        ).select("sum", "xor", "n_shingles", "copies", F.col("first.doc_id").alias("class"), F.col("first.row").alias("first_row")),
        scratch_path(spark, "classes"),
    )
    firsts = linkable.join(classes, [linkable["row"] == classes["first_row"], linkable["doc_id"] == classes["class"]]).select(
        "class", "first_row", "bands"
    )
    member = firsts.select("class", "first_row", F.posexplode("bands").alias("band", "hash"))
    pivots = member.groupBy("band", "hash").agg(
        F.min(F.struct("class", "first_row")).alias("pivot"), F.count(F.lit(1)).alias("n")
    ).where("n > 1")
    # A pivot stands in buckets of its own, where others may be smaller: its buckets go by the least of these, so that a group
    # of near copies, whose buckets differ in who is missing, is one cluster and not one for each band.
    own = member.join(pivots, ["band", "hash"]).groupBy("class").agg(F.min("pivot").alias("root"))
    pivots = pivots.withColumn("class", F.col("pivot.class")).join(own, "class").select("band", "hash", F.col("root").alias("pivot"))
    pairs = written(
        member.join(pivots, ["band", "hash"])
        .where("class <> pivot.class")
        .select(F.col("pivot.class").alias("pivot"), F.col("pivot.first_row").alias("pivot_row"), F.col("class").alias("member"), F.col("first_row").alias("member_row"))
        .distinct(),
        scratch_path(spark, "candidates"),
    )
    needed = pairs.select(F.col("pivot_row").alias("row")).union(pairs.select(F.col("member_row").alias("row")))
    bits = spark.sparkContext.broadcast(row_filter(needed))
    sets = written(keyed.mapInArrow(_needed_sets(shingle, bits), "row bigint, items binary"), scratch_path(spark, "sets"))

    overlaps = written(_compare_with_pivots(pairs, sets), scratch_path(spark, "overlaps"))
    linked = 100 * F.col("common") >= percent * (F.col("pivot_size") + F.col("size") - F.col("common"))
    links = overlaps.where(linked).select(F.col("pivot").alias("a"), F.col("member").alias("b"))
    # Rows that share a doc_id, and classes of equal sets, hang together by the class's name.
    same = (
        linkable.join(classes, ["sum", "xor", "n_shingles"]).where("doc_id <> class").select(F.col("doc_id").alias("a"), F.col("class").alias("b"))
    )
    started = written(components(links), scratch_path(spark, "components"))
    more = written(_compare_blocks(overlaps, pairs, sets, started, percent), scratch_path(spark, "links"))
    found = written(components(links.union(more).union(same)), scratch_path(spark, "components"))
    return described.select("row", "doc_id", "n_shingles").join(
        found.withColumnRenamed("node", "doc_id"), "doc_id", "left"
    ).select(
        "row",
        "doc_id",
        "n_shingles",
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def _compare_with_pivots(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Overlap of every member with its pivot; the members of a large cluster are shared out, each share with the pivot."""
    shares = pairs.groupBy("pivot", "pivot_row").agg(F.ceil(F.count(F.lit(1)) / 256).cast("int").alias("shares"))
    members = (
        pairs.join(shares.drop("pivot_row"), "pivot")
        .select("pivot", F.pmod(F.xxhash64("member"), F.col("shares")).cast("int").alias("share"), "member", F.col("member_row").alias("row"))
    )
    leaders = shares.select(
        "pivot", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.col("pivot").alias("member"), F.col("pivot_row").alias("row")
    )
    return (
        members.union(leaders)
        .join(sets, "row")
        .select("pivot", "share", "member", "items")
        .repartition("pivot", "share")
        .sortWithinPartitions("pivot", "share", F.col("member") != F.col("pivot"))
        .mapInArrow(_with_pivot, "pivot bigint, member bigint, common bigint, pivot_size bigint, size bigint")
    )


def _compare_blocks(overlaps: DataFrame, pairs: DataFrame, sets: DataFrame, comps: DataFrame, percent: int) -> DataFrame:
    """Links between members of a cluster that are still in different components."""
    label = comps.select(F.col("node").alias("member"), "component")
    rows = pairs.select("member", F.col("member_row").alias("row")).distinct()
    members = (
        overlaps.distinct()
        .join(label, "member", "left")
        .withColumn("component", F.coalesce("component", "member"))
        .join(comps.select(F.col("node").alias("pivot"), F.col("component").alias("home")), "pivot", "left")
        .select(
            "pivot",
            "member",
            "component",
            "size",
            (1 - F.col("common") / (F.col("pivot_size") + F.col("size") - F.col("common"))).alias("distance"),
            (F.col("component") == F.coalesce("home", "pivot")).alias("at_home"),
        )
    )
    # A cluster with one member was settled by its pivot; so was one that is a single component.
    apart = members.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("x"), F.max("component").alias("y"))
    members = members.join(apart.where("n > 1 AND x <> y").select("pivot"), "pivot").withColumn(
        "step", F.floor(F.col("distance") * STEPS).cast("int")
    )
    members = written(members, scratch_path(sets.sparkSession, "members"))
    layers = members.groupBy("pivot", "at_home", "step").agg(F.ceil(F.sum("size") / BLOCK_SHINGLES).cast("int").alias("parts"))
    members = members.join(layers, ["pivot", "at_home", "step"]).withColumn(
        "part", F.pmod(F.xxhash64("member"), F.col("parts")).cast("int")
    )
    blocks = layers.select(
        "pivot", "at_home", "step", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    ).select("pivot", F.struct("at_home", "step", "part").alias("block"))
    reach = (1 - percent / 100) * STEPS + 1
    met = (
        blocks.withColumnRenamed("block", "x")
        .join(blocks.withColumnRenamed("block", "y"), "pivot")
        .where("x <= y AND NOT (x.at_home AND y.at_home)")
        .where(F.abs(F.col("x.step") - F.col("y.step")) <= reach)
        .select("pivot", "x", "y", F.xxhash64("pivot", "x", "y").alias("pair"))
    )
    sides = met.select("pivot", F.col("x").alias("block"), "pair", F.lit(True).alias("is_left")).union(
        met.where("x <> y").select("pivot", F.col("y").alias("block"), "pair", F.lit(False).alias("is_left"))
    )
    placed = members.select("pivot", F.struct("at_home", "step", "part").alias("block"), "member", "distance", "component")
    return (
        sides.join(placed, ["pivot", "block"])
        .join(rows, "member")
        .join(sets, "row")
        .select("pair", "is_left", "member", "distance", "component", "items")
        .repartition("pair")
        .sortWithinPartitions("pair", F.desc("is_left"))
        .mapInArrow(_between_blocks(percent), "a bigint, b bigint")
    )
