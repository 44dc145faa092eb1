"""Lookups on the ordered header list of a message. Names may repeat and order matters, so it is never a map."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Well-known header names and the separator of a configured shared-header list.
SECURITY_LABEL = "Security-Label"
CONTENT_TYPE = "Content-Type"
DEAD_LETTER_REASON = "Dead-Letter-Reason"
SHARED_HEADER_SEPARATOR = "^"
DEFAULT_SHARED_HEADERS = (CONTENT_TYPE,)


def _named(headers: Column, name: str) -> Column:
    return F.filter(headers, lambda h: F.lower(h["key"]) == name.lower())


def header_all(headers: Column, name: str) -> Column:
    """Values of every header with this name (any case), in order."""
    return F.transform(_named(headers, name), lambda h: h["value"])


def header_first(headers: Column, name: str) -> Column:
    """First value of this header (any case), or the empty string."""
    return F.coalesce(F.get(header_all(headers, name), F.lit(0)), F.lit(""))


def header_last(headers: Column, name: str) -> Column:
    """Last value of this header (any case), or null."""
    return F.try_element_at(header_all(headers, name), F.lit(-1))


def header_last_exact(headers: Column, name: str) -> Column:
    """Last value of the header with exactly this name, or null."""
    exact = F.filter(headers, lambda h: h["key"] == name)
    return F.try_element_at(F.transform(exact, lambda h: h["value"]), F.lit(-1))


def shared_header_names(configured: str | None) -> tuple[str, ...]:
    """Split a configured list such as ``Content-Type^Security-Label``."""
    names = tuple(n for n in (configured or "").split(SHARED_HEADER_SEPARATOR) if n)
    return names or DEFAULT_SHARED_HEADERS


def select_headers(headers: Column, names: Sequence[str] | None = None) -> Column:
    """Headers whose name is in ``names`` (exact case), order and repeats kept; all of them without names."""
    if names is None:
        return headers
    return F.filter(headers, lambda h: h["key"].isin(list(names)))


def add_header(headers: Column, name: str, value: Column) -> Column:
    empty = F.array().cast("array<struct<key:string,value:string>>")
    extra = F.array(F.struct(F.lit(name).alias("key"), value.cast("string").alias("value")))
    return F.concat(F.coalesce(headers, empty), extra)
