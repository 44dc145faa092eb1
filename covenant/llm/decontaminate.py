"""Documents that contain passages of benchmark items, found by winnowing. DataFrame expressions only.

A window is ``width`` words of an item (a shorter item is one window). Of the hashes of the k-word runs in a window, the
smallest is its fingerprint. A document lists the fingerprint of each of its windows, once for every run of neighbours
that share it; an item's window that occurs in a document is one of the document's windows, so its fingerprint is in that
list: nothing is missed. Matching fingerprints are extended to the windows they stand for, and those are compared word by word.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covenant.llm.common import LOWER, UPPER, row_key
from covenant.session import scratch_path, written

WIDTH = 10
#: Words of the runs that are hashed.
GRAM = 5
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _lowered(text: Column) -> Column:
    return F.coalesce(F.translate(text, UPPER, LOWER), F.lit(""))


def words(text: Column) -> Column:
    """Words of a text, with A-Z in lower case; none for null."""
    return F.regexp_extract_all(_lowered(text), F.lit(WORD), F.lit(0))


def _upto(n: Column) -> Column:
    """0 .. n - 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _grams(hashes: Column, gram: int) -> Column:
    return F.transform(
        _upto(F.size(hashes) - (gram - 1)), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(gram)])
    )


def _least(grams: Column, window: int) -> Column:
    """Smallest hash of each window of grams."""

    def least(i: Column) -> Column:
        return F.least(*[F.get(grams, i + j) for j in range(window)]) if window > 1 else F.get(grams, i)

    return F.transform(_upto(F.size(grams) - (window - 1)), least)


def fingerprints(df: DataFrame, width: int, gram: int) -> DataFrame:
    """``df`` with ``least``: the fingerprint of every window of ``width`` words in ``words``. Step by step, so that no
    array is computed again for each of its elements."""
    gram = min(gram, width)
    return (
        df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
        .withColumn("grams", _grams(F.col("hashes"), gram))
        .withColumn("least", _least(F.col("grams"), width - gram + 1))
        .drop("hashes", "grams")
    )


def _runs(least: Column, width: int) -> Column:
    """One struct per run of windows with the same fingerprint: its first window and the fingerprint."""
    starts = F.filter(
        _upto(F.size(least)), lambda i: (i == 0) | (F.get(least, i) != F.get(least, F.greatest(i - 1, F.lit(0))))
    )
    return F.transform(starts, lambda i: F.struct(i.alias("at"), F.get(least, i).alias("print"), F.lit(width).alias("width")))


def _placed(places: Column, width: int, **more: Callable[[Column], Column]) -> Column:
    """Structs of window numbers, the windows' words joined by a space, and ``more`` as functions of the number."""

    def placed(i: Column) -> Column:
        passage = F.concat_ws(" ", F.slice("words", i + 1, F.lit(width)))
        return F.struct(i.alias("at"), passage.alias("passage"), *[f(i).alias(name) for name, f in more.items()])

    return F.transform(places, placed)


def item_windows(benchmark: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(item_id, width, print, passage): the windows of the items, a short item being one."""
    items = benchmark.select("item_id", words(F.col("text")).alias("words"))
    # At most ``width`` numbers.
    lengths = [r[0] for r in items.select(F.least(F.size("words"), F.lit(width)).alias("n")).distinct().collect() if r[0]]
    parts = [items.select("item_id", F.lit(0).alias("width"), F.lit(0).cast("bigint").alias("print"), F.lit("").alias("passage")).limit(0)]
    for length in sorted(lengths):
        long_enough = F.size("words") >= width if length == width else F.size("words") == length
        found = fingerprints(items.where(long_enough), length, gram)
        at = _placed(_upto(F.size("least")), length, print=lambda i: F.get("least", i))
        parts.append(found.select("item_id", F.lit(length).alias("width"), F.explode(at).alias("w")).select("item_id", "width", "w.print", "w.passage"))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def find_contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """Per row of ``docs`` (doc_id, text) the words that lie in a window of an item of ``benchmark`` (item_id, text).

    Returns the columns of ``docs`` and n_words, n_hit, items (ids of the items with occurring windows, as text, sorted),
    contaminated. Null texts have no words and are clean, items without words have no windows, items without an id count
    as hits but are not listed. Equal rows get equal results. Columns of ``docs`` with these names are replaced.
    """
    spark = docs.sparkSession
    added = ["n_words", "n_hit", "items", "contaminated"]
    docs = docs.drop(*added)
    windows = written(item_windows(benchmark, width, gram).distinct(), scratch_path(spark, "windows"))
    # At most ``width`` numbers; only window lengths that some item has are looked for.
    lengths = sorted(r[0] for r in windows.select("width").distinct().collect())
    keyed = docs.withColumn("__row", row_key("doc_id", "text"))
    hit = _hits(keyed, windows, lengths, width, gram) if lengths else None
    counted = keyed.withColumn("n_words", F.regexp_count(_lowered(F.col("text")), F.lit(WORD)).cast("bigint"))
    if hit is None:
        joined = counted.withColumns({"n_hit": F.lit(0).cast("bigint"), "items": F.array().cast("array<string>")})
    else:
        joined = counted.join(hit, "__row", "left").withColumns(
            {"n_hit": F.coalesce("n_hit", F.lit(0).cast("bigint")), "items": F.coalesce("items", F.array().cast("array<string>"))}
        )
    return joined.withColumn("contaminated", F.col("n_hit") > 0).drop("__row")


def _hits(keyed: DataFrame, windows: DataFrame, lengths: list[int], width: int, gram: int) -> DataFrame:
    spark = keyed.sparkSession
    texts = keyed.select("__row", "text")
    # Spark broadcasts the fingerprints of the items if their table is below its threshold, and shuffles otherwise.
    prints = windows.select("width", "print").distinct()
    found = None
    for length in lengths:
        listed = fingerprints(texts.select("__row", words(F.col("text")).alias("words")), length, gram).select(
            "__row", F.explode(_runs(F.col("least"), length)).alias("f")
        )
        found = listed if found is None else found.union(listed)
    matched = (
        found.select("__row", "f.at", "f.print", "f.width")
        .join(prints, ["width", "print"], "left_semi")
        .groupBy("__row", "width")
        .agg(F.collect_set("print").alias("prints"))
    )
    matched = written(matched, scratch_path(spark, "fingerprints"))
    passages = None
    for length in lengths:
        # Extension: all windows of the document that a matching fingerprint stands for, with their words.
        chosen = fingerprints(
            texts.join(matched.where(F.col("width") == length), "__row").select("__row", "prints", words(F.col("text")).alias("words")),
            length,
            gram,
        )
        at = F.filter(_upto(F.size("least")), lambda i: F.array_contains("prints", F.get("least", i)))
        listed = chosen.select("__row", F.explode(_placed(at, length)).alias("w")).select(
            "__row", F.lit(length).alias("width"), "w.at", "w.passage"
        )
        passages = listed if passages is None else passages.union(listed)
    ids = windows.groupBy("width", "passage").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    covered = F.flatten(F.collect_set(F.sequence("at", F.col("at") + F.col("width") - 1)))
    return (
        passages.join(ids, ["width", "passage"])
        .groupBy("__row")
        .agg(
            F.size(F.array_distinct(covered)).cast("bigint").alias("n_hit"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
    )
