"""Reading tagged messages: Kafka or tables of the same shape, tagged text files, and where to start."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from covenant.functions.headers import SECURITY_LABEL
from covenant.schemas import MESSAGE

# Separators of a tagged text line, and Kafka's codes for both ends of a partition.
HEADER_SEPARATOR = "\u00ac"
PAYLOAD_SEPARATOR = "\t"
EARLIEST, LATEST = -2, -1


def read_messages(
    spark: SparkSession,
    source: str | DataFrame,
    topics: Sequence[str],
    *,
    streaming: bool = False,
    start: str | Mapping[str, Mapping[str, int]] = "earliest",
    max_records: int | None = None,
    max_files: int | None = None,
    format: str = "kafka",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Messages of some topics in the shape of :data:`covenant.schemas.MESSAGE`.

    ``source`` is the Kafka bootstrap servers, the path of files in ``format``, or any DataFrame of that shape.
    ``options`` are passed through (``kafka.*`` for consumer properties). ``start`` is an end of the partitions or offsets by
    topic and partition, where partitions that are not named are read from their beginning; files and frames honour it, too.
    ``max_records`` bounds a micro-batch of Kafka, and what is read of files and frames at a time (a stream of files is bounded
    by ``max_files``).
    """
    if not topics:
        raise ValueError("at least one topic is required")
    if max_records is not None and max_records < 1:
        raise ValueError("max_records must be at least 1")
    wanted = F.col("topic").isin(*topics)
    if isinstance(source, DataFrame):
        given = source.where(wanted & _after(start)).select(*MESSAGE.fieldNames())
        return given if max_records is None or given.isStreaming else first_records(given, max_records)
    reader = spark.readStream if streaming else spark.read
    reader = reader.options(**dict(options or {}))
    if format != "kafka":
        if streaming and max_files is not None:
            reader = reader.option("maxFilesPerTrigger", max_files)
        given = reader.format(format).schema(MESSAGE).load(source).where(wanted & _after(start))
        return given if max_records is None or streaming else first_records(given, max_records)
    reader = (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", source)
        .option("subscribe", ",".join(topics))
        .option("includeHeaders", "true")
        .option("startingOffsets", start if isinstance(start, str) else json.dumps(start))
    )
    if streaming and max_records is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_records)
    return with_text_headers(reader.load()).select(*MESSAGE.fieldNames())


def _after(start: str | Mapping[str, Mapping[str, int]]) -> Column:
    """Whether a message is not before its partition's start."""
    if isinstance(start, str):
        return F.lit(start != "latest")
    keep = F.lit(True)
    for topic, partitions in start.items():
        for partition, offset in partitions.items():
            here = (F.col("topic") == topic) & (F.col("partition") == int(partition))
            keep = keep & (~here | (F.lit(offset != LATEST) & (F.col("offset") >= max(int(offset), 0))))
    return keep


def first_records(messages: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` messages, the first of every partition alike; what one poll of a consumer would give."""
    order = Window.partitionBy("topic", "partition").orderBy("offset")
    near = messages.withColumn("__place", F.row_number().over(order)).where(F.col("__place") <= limit)
    return near.orderBy("__place", "topic", "partition").limit(limit).drop("__place")


def index_messages(messages: DataFrame) -> DataFrame:
    """The offsets that files of messages hold: (file, topic, partition, first, last, messages). ``messages`` is read from files."""
    named = messages.select("topic", "partition", "offset", F.col("_metadata.file_path").alias("file"))
    return named.groupBy("file", "topic", "partition").agg(
        F.min("offset").alias("first"), F.max("offset").alias("last"), F.count(F.lit(1)).alias("messages")
    )


def read_from(
    spark: SparkSession, index: DataFrame, starts: DataFrame, *, max_records: int | None = None, format: str = "parquet"
) -> DataFrame:
    """Messages from given offsets on, out of the files of an ``index`` that hold any; no other file is opened.

    ``starts`` has (topic, partition, offset), as :func:`start_offsets` gives them: partitions that are not named are not read,
    EARLIEST reads all and LATEST nothing. ``max_records`` bounds each partition; files that lie after that many messages are not
    opened either.
    """
    begin = starts.where(F.col("offset").isNotNull() & (F.col("offset") != LATEST)).select(
        "topic", "partition", F.greatest(F.col("offset"), F.lit(0)).alias("begin")
    )
    held = index.join(begin, ["topic", "partition"]).where("last >= begin")
    if max_records is not None:
        # Messages that surely come before a file: those of files that begin after the start and have ended where it begins.
        files = Window.partitionBy("topic", "partition").orderBy("first", "last")
        earlier = files.rowsBetween(Window.unboundedPreceding, -1)
        counted = F.coalesce(F.sum(F.when(F.col("first") >= F.col("begin"), F.col("messages"))).over(earlier), F.lit(0))
        apart = F.coalesce(F.max("last").over(earlier) < F.col("first"), F.lit(True))
        held = held.withColumn("__counted", F.when(apart, counted))
        held = held.withColumn("__before", F.last("__counted", ignorenulls=True).over(files.rowsBetween(Window.unboundedPreceding, 0)))
        held = held.where(F.col("__before") < max_records)
    paths = sorted(row["file"] for row in held.select("file").distinct().collect())
    if not paths:
        return spark.createDataFrame([], MESSAGE)
    found = spark.read.schema(MESSAGE).format(format).load(paths).join(begin, ["topic", "partition"])
    found = found.where(F.col("offset") >= F.col("begin")).select(*MESSAGE.fieldNames())
    if max_records is None:
        return found
    order = Window.partitionBy("topic", "partition").orderBy("offset")
    return found.withColumn("__place", F.row_number().over(order)).where(F.col("__place") <= max_records).drop("__place")


def with_text_headers(messages: DataFrame) -> DataFrame:
    """Header values as text; Kafka gives them as bytes."""
    return messages.withColumn(
        "headers",
        F.transform(
            "headers", lambda h: F.struct(h["key"].alias("key"), F.decode(h["value"], "UTF-8").alias("value"))
        ),
    )


def start_offsets(
    committed: DataFrame, requested: DataFrame, *, force_reset: bool = False, default: int | None = None
) -> DataFrame:
    """Start position of each ``(topic, partition)``, and whether it is a seek.

    A commit wins unless ``force_reset``; requested offset 0 means the beginning. ``default`` is the position of
    partitions that are neither committed nor requested (``EARLIEST`` and ``LATEST`` are the two ends).
    """
    kept = committed.select("topic", "partition", F.col("next_offset").alias("committed"))
    asked = requested.select("topic", "partition", F.col("offset").alias("requested"))
    both = kept.join(asked, ["topic", "partition"], "full_outer")
    wanted = F.when(F.col("requested") == 0, EARLIEST).otherwise(F.col("requested"))
    wanted = F.coalesce(wanted, F.lit(default).cast("bigint"))
    seek = F.lit(force_reset) | F.col("committed").isNull()
    return both.select(
        "topic",
        "partition",
        F.when(seek, F.coalesce(wanted, F.col("committed"))).otherwise(F.col("committed")).alias("offset"),
        (seek & wanted.isNotNull()).alias("is_seek"),
    )


def starting_offsets_json(offsets: DataFrame) -> str:
    """The ``startingOffsets`` option of a Kafka read. One entry per partition, so its size is that of the topics."""
    starts: dict[str, dict[str, int]] = {}
    for row in offsets.where("offset IS NOT NULL").select("topic", "partition", "offset").toLocalIterator():
        starts.setdefault(row["topic"], {})[str(row["partition"])] = row["offset"]
    return json.dumps(starts, sort_keys=True)


def tagged_line(line: Column, separator: str = HEADER_SEPARATOR) -> Column:
    """``struct(headers, payload)`` of ``Name:value<sep>Name:value<TAB>payload``."""
    head = F.split(line, PAYLOAD_SEPARATOR, 2)
    headers = F.transform(
        F.split(F.get(head, F.lit(0)), f"\\Q{separator}\\E"),
        lambda h: F.struct(
            F.substring_index(h, ":", 1).alias("key"),
            F.substring(h, F.instr(h, ":") + 1, F.length(h)).alias("value"),
        ),
    )
    return F.struct(headers.alias("headers"), F.get(head, F.lit(1)).alias("payload"))


def tagged_text(lines: DataFrame, topic: str | Column, separator: str = HEADER_SEPARATOR) -> DataFrame:
    """Messages out of text lines with a ``value`` column; the caller's ``offset`` column gives their positions."""
    name = F.lit(topic) if isinstance(topic, str) else topic
    parsed = lines.withColumn("__line", tagged_line(F.col("value"), separator))
    return parsed.select(
        name.alias("topic"),
        F.lit(0).alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(None).cast("binary").alias("key"),
        F.col("__line.payload").cast("binary").alias("value"),
        F.col("__line.headers").alias("headers"),
    )


def read_tagged_text(
    spark: SparkSession, path: str, topic: str, separator: str = HEADER_SEPARATOR
) -> DataFrame:
    """Load tagged text files into a topic.

    Offsets follow file and line order without sorting all lines in one task: each line gets an increasing id inside
    its read partition, with gaps between partitions. Write the result before using the offsets elsewhere.
    """
    lines = spark.read.text(path).withColumn("offset", F.monotonically_increasing_id())
    return tagged_text(lines.where(F.length("value") > 0), topic, separator)


def security_label(messages: DataFrame) -> DataFrame:
    """Positions and raw labels only, for routing questions that need no payload."""
    labels = F.filter("headers", lambda h: F.lower(h["key"]) == SECURITY_LABEL.lower())
    return messages.select("topic", "partition", "offset", labels.alias("headers"))
