"""Chat formatting in windows of a token budget. DataFrame expressions only.

A turn is written as ``<turn role="...">text</turn>`` and a line break. In texts and roles a backslash becomes two, ``<``
becomes ``\\l`` and, in roles, a double quote ``\\q``, so control strings only ever stem from the template and everything
can be read back. Prefix sums of the turns' tokens, held against what the budget leaves beside the system turn, assign each
turn to a window; a window repeats the leading system turn and the last few turns before it, and only the assistant texts of
its own turns are under the loss mask, so each is once.

A conversation may be of any size: its turns are summed up in ranges, to which the sums of earlier ranges are added, and
what meets in one group afterwards is a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from covenant.session import scratch_path, written

#: Tokens of a window, and of the history it may repeat.
BUDGET = 1024
HISTORY = 128
#: Tokens of the marks around a turn.
MARKS = 4
#: Rows over which a conversation's system turn is spread to meet the windows that repeat it.
SPREAD = 16
#: A token: a run of ASCII letters, digits and underscores, or any other character but white space.
TOKEN = r"[A-Za-z0-9_]+|[^A-Za-z0-9_ \t\r\n]"

ASSISTANT, SYSTEM = "assistant", "system"
_TURN = r'<turn role="([^"<]*)">([^<]*)</turn>'


def _replaced(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def escape(text: Column) -> Column:
    return _replaced(_replaced(text, "\\", "\\\\"), "<", "\\l")


def escape_role(role: Column) -> Column:
    return _replaced(escape(role), '"', "\\q")


def unescape(text: Column) -> Column:
    # Pairs of backslashes are taken off from the left, so what is left of a backslash starts one of the other escapes.
    parts = F.split(text, r"\\\\")
    return F.array_join(F.transform(parts, lambda s: _replaced(_replaced(s, "\\l", "<"), "\\q", '"')), "\\")


def format_chat(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens: str | None = None) -> DataFrame:
    """Windows of all conversations: (conv_id, window, text, repeated, loss_mask).

    Takes (conv_id, turn, role, text) and, if ``tokens`` names it, a column with the tokens of each text (null or negative:
    none) by the caller's tokenizer; without it ``TOKEN`` counts them. A turn takes ``MARKS`` more. Other columns are ignored;
    null roles and texts are empty, rows without a conv_id are one conversation, turns with the same number follow each
    other by role and text. An empty table gives no windows.

    ``window`` counts from 0. ``repeated`` is the number of turns at the start of the text that an earlier window had as its
    own, ``loss_mask`` the places (start, length; code points from 0) of the assistant texts to learn. Turns are never cut.
    The system turn, the turns repeated (at most ``history`` tokens of the window before) and a window's own turns keep to
    ``budget`` together wherever each turn does beside the system turn; a turn that does not has a window of its own.
    """
    spark = conversations.sparkSession
    turns = conversations.select("conv_id", "turn", "role", "text", *([] if tokens is None else [F.col(tokens).alias("tokens")]))
    turns = _numbered(turns, budget, history)
    turns = written(_in_windows(turns), scratch_path(spark, "turns"))
    return _built(turns, budget, history)


def _numbered(turns: DataFrame, budget: int, history: int) -> DataFrame:
    """Turns with their place in the conversation, tokens and characters before them, and the room of its windows.

    Turns are sorted into ranges; sums within a range start from those of the conversation's earlier ranges.
    """
    spark = turns.sparkSession
    order = ["turn", "role", "text", "tokens"]
    turns = turns.fillna("", ["role", "text"])
    # What is measured is measured behind the shuffle, whose ranges are drawn from a pass of its own over the keys.
    ranged = turns.repartitionByRange("conv_id", *[c for c in order if c in turns.columns])
    given = F.greatest(F.col("tokens"), F.lit(0)) if "tokens" in turns.columns else F.regexp_count("text", F.lit(TOKEN))
    ranged = (
        ranged.withColumn("range", F.spark_partition_id())
        .withColumn("tokens", (F.coalesce(given, F.lit(0)) + MARKS).cast("bigint"))
        .withColumn("head", F.char_length(F.concat(F.lit('<turn role="'), escape_role(F.col("role")), F.lit('">'))))
        .withColumn("body", F.char_length(escape(F.col("text"))))
        .withColumn("length", (F.col("head") + F.col("body") + 8).cast("bigint"))
    )
    ranged = written(ranged, scratch_path(spark, "ranges"))
    by_range = Window.partitionBy("conv_id").orderBy("range")
    earlier = by_range.rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("conv_id", "range").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("tokens").alias("sum_tokens"),
        F.sum("length").alias("sum_length"),
        F.min(F.struct("turn", "role", "text", "tokens")).alias("least"),
    )
    lead = F.first("least").over(by_range)
    sums = sums.select(
        F.col("conv_id").alias("of"),
        F.col("range").alias("in"),
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("n", "sum_tokens", "sum_length")],
        F.when(lead["role"] == SYSTEM, lead["tokens"]).otherwise(0).alias("system_tokens"),
    )
    within = Window.partitionBy("conv_id", "range").orderBy(*order)
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.col("sum_tokens_before") + F.sum("tokens").over(so_far) - F.col("system_tokens")
    return (
        ranged.join(sums, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("range") == F.col("in")))
        .withColumn("place", F.col("n_before") + F.row_number().over(within))
        .withColumn("leads", (F.col("place") == 1) & (F.col("system_tokens") > 0))
        .withColumn("end", end)
        .withColumn("start", F.greatest(F.col("end") - F.col("tokens"), F.lit(0)))
        .withColumn("before", F.col("sum_length_before") + F.sum("length").over(so_far) - F.col("length"))
        .withColumn("room", F.greatest(F.lit(budget - history) - F.col("system_tokens"), F.lit(1)))
        .drop("of", "in", "n_before", "sum_tokens_before", "sum_length_before")
    )


def _in_windows(turns: DataFrame) -> DataFrame:
    """Turns with the tokens before their window (``begin``) and up to its end (``finish``).

    Prefix sums are cut at every multiple of the room. The turns between two cuts fit a window, and a turn across a cut joins
    the turns behind it if they fit together; else it is a window by itself.
    """
    cut = (F.floor(F.col("start") / F.col("room")) + 1) * F.col("room")
    cell = Window.partitionBy("conv_id", "cell")
    own = Window.partitionBy("conv_id", "cell", "part")
    return (
        turns.withColumn("crosses", F.col("end") > cut)
        .withColumn("cell", F.floor(F.when(F.col("crosses"), F.col("end")).otherwise(F.col("start")) / F.col("room")))
        .withColumn("fits", F.max("end").over(cell) - F.min("start").over(cell) <= F.col("room"))
        .withColumn("part", F.when(F.col("fits") | F.col("crosses"), 0).otherwise(1))
        .withColumn("begin", F.min("start").over(own))
        .withColumn("finish", F.max("end").over(own))
        .drop("crosses", "cell", "fits", "part", "room")
    )


def _windows(turns: DataFrame) -> DataFrame:
    """One row per window: its first turn's place, and its number among the conversation's windows."""
    first = turns.where((F.col("place") == 1) | ((F.col("begin") > 0) & (F.col("start") == F.col("begin"))))
    first = first.select("conv_id", "range", "place", "begin", "system_tokens")
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = first.groupBy("conv_id", "range").count().select(
        F.col("conv_id").alias("of"), F.col("range").alias("in"), F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("earlier")
    )
    number = F.col("earlier") + F.row_number().over(Window.partitionBy("conv_id", "range").orderBy("place")) - 1
    return first.join(counts, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("range") == F.col("in"))).select(
        "conv_id", "begin", "place", "system_tokens", number.cast("int").alias("window")
    )


def _built(turns: DataFrame, budget: int, history: int) -> DataFrame:
    """The text and loss mask of every window, from its own turns, the system turn and the end of the window before."""
    text = F.concat(F.lit('<turn role="'), escape_role(F.col("role")), F.lit('">'), escape(F.col("text")), F.lit("</turn>\n"))
    turns = turns.withColumn("written", text)

    def turn(kind: int) -> Column:
        fields = ["place", "leads", "role", "written", "head", "body", "length", "start", "before", "tokens"]
        return F.struct(F.lit(kind).alias("kind"), *fields).alias("turn")

    none = [F.lit(None).cast("int").alias("window"), F.lit(None).cast("bigint").alias("system_tokens")]
    own = turns.select("conv_id", "begin", *none, turn(2))
    # The next window begins where this one ends; if there is none, nothing comes of these rows.
    tail = turns.where(~F.col("leads") & (F.col("finish") - F.col("start") <= history))
    tail = tail.select("conv_id", F.col("finish").alias("begin"), *none, turn(1))
    system = turns.where("leads").select(
        F.col("conv_id").alias("of"), turn(0), F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("spread")
    )
    heads = _windows(turns).withColumn("at", F.pmod(F.col("place"), F.lit(SPREAD)).cast("int"))
    heads = heads.join(
        system, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("at") == F.col("spread")) & (F.col("begin") > 0), "left"
    ).select("conv_id", "begin", "window", "system_tokens", "turn")

    def of_kind(kind: int) -> Column:
        return F.filter("turns", lambda t: t["kind"] == kind)

    def total(turns: Column, field: str) -> Column:
        return F.aggregate(turns, F.lit(0).cast("bigint"), lambda sum, t: sum + t[field])

    used = F.col("system_tokens") + total(F.filter("own", lambda t: ~t["leads"]), "tokens")
    windows = (
        own.union(tail)
        .union(heads)
        .groupBy("conv_id", "begin")
        .agg(F.max("window").alias("window"), F.max("system_tokens").alias("system_tokens"), F.sort_array(F.collect_list("turn")).alias("turns"))
        .where("window IS NOT NULL")
        .withColumn("own", of_kind(2))
        .withColumn("spare", F.least(F.lit(history), F.lit(budget) - used))
        .withColumn("again", F.concat(of_kind(0), F.filter(of_kind(1), lambda t: F.col("begin") - t["start"] <= F.col("spare"))))
        .withColumn("base", total(F.col("again"), "length"))
    )
    learned = F.transform(
        F.filter("own", lambda t: t["role"] == ASSISTANT),
        lambda t: F.struct(
            (F.col("base") + t["before"] - F.col("own")[0]["before"] + t["head"]).cast("bigint").alias("start"),
            t["body"].cast("bigint").alias("length"),
        ),
    )
    return windows.select(
        "conv_id",
        "window",
        F.array_join(F.transform(F.concat("again", "own"), lambda t: t["written"]), "").alias("text"),
        F.size("again").alias("repeated"),
        learned.alias("loss_mask"),
    )


def read_turns(windows: DataFrame) -> DataFrame:
    """Formatted windows with ``turns``: role and text of their own turns, unescaped, read from the text alone but for the
    number of repeated turns at its start."""
    found = F.arrays_zip(
        F.regexp_extract_all("text", F.lit(_TURN), F.lit(1)).alias("role"),
        F.regexp_extract_all("text", F.lit(_TURN), F.lit(2)).alias("text"),
    )
    own = F.slice(found, F.col("repeated") + 1, F.greatest(F.size(found) - F.col("repeated"), F.lit(0)))
    return windows.withColumn(
        "turns", F.transform(own, lambda t: F.struct(unescape(t["role"]).alias("role"), unescape(t["text"]).alias("text")))
    )


def learned_text(windows: DataFrame) -> Column:
    """All text under the loss mask of a window, unescaped, nothing between."""
    return F.array_join(
        F.transform("loss_mask", lambda m: unescape(F.substring(F.col("text"), (m["start"] + 1).cast("int"), m["length"].cast("int")))), ""
    )
