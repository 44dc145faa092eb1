"""String rules used throughout: trimming, blankness, path parts and target topics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Trimming removes every character up to and including the space.
CONTROL_AND_SPACE = "".join(chr(code) for code in range(0x21))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside one expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def trim_all(text: Column) -> Column:
    """Strip spaces and control characters from both ends (plain ``trim`` strips spaces only)."""
    return F.btrim(text, F.lit(CONTROL_AND_SPACE))


def is_blank(text: Column) -> Column:
    """True for null, empty and all-whitespace text (Unicode whitespace included)."""
    return F.coalesce(~text.rlike(r"\P{javaWhitespace}"), F.lit(True))


def blank_to_null(text: Column) -> Column:
    return F.when(~is_blank(text), text)


def file_part(path: Column) -> Column:
    """What follows the last slash or backslash."""
    return F.regexp_extract(path, r"[^/\\]*$", 0)


def directory_part(path: Column) -> Column:
    """Everything up to and including the last slash or backslash."""
    return F.regexp_extract(path, r"(?s)^(.*[/\\])?", 0)


def base_name(path: Column) -> Column:
    """Last element of a slash-separated path; trailing slashes are not part of a name."""
    return F.coalesce(F.substring_index(F.regexp_replace(path, "/+$", ""), "/", -1), F.lit(""))


def extension(name: Column) -> Column:
    """Last dot and what follows, or empty when there is no dot past the first character."""
    return F.regexp_extract(name, r"(?s)^.+(\.[^.]*)$", 1)


def without_extension(name: Column) -> Column:
    return F.substring(name, F.lit(1), F.length(name) - F.length(extension(name)))


def target_topic(topic: Column, target: Column, server: Column) -> Column:
    """The configured target topic, else ``server-topic``."""
    return F.when(F.length(target) > 0, target).otherwise(F.concat_ws("-", server, topic))


def compound_topic(topic: Column, prefix: Column, server: Column) -> Column:
    """``prefix-server-topic``, or ``server-topic`` without a prefix."""
    return F.concat_ws("-", F.when(F.length(prefix) > 0, prefix), server, topic)
