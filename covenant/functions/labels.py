"""Security labels and the attribute rules checked against them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from covenant.functions.text import bind, is_blank, trim_all

# Reason codes of a refused message.
BAD_LABEL = "BAD_LABEL"
INVALID_FILTER = "INVALID_FILTER"
MISSING_ATTRIBUTE = "MISSING_ATTRIBUTE"
VALUE_MISMATCH = "VALUE_MISMATCH"

_ENTRIES = "array<struct<key:string,value:string>>"


def _entry(part: Column) -> Column:
    """``key=value`` or ``key:value`` as an upper-cased pair; either side is empty when the part is malformed."""
    cut = F.least(
        F.nullif(F.instr(part, "="), F.lit(0)),
        F.nullif(F.instr(part, ":"), F.lit(0)),
    )
    key = F.upper(trim_all(F.substring(part, F.lit(1), cut - 1)))
    value = F.upper(trim_all(F.substring(part, cut + 1, F.length(part))))
    return F.struct(
        F.coalesce(key, F.lit("")).alias("key"),
        F.coalesce(value, F.lit("")).alias("value"),
    )


def _last_of_each_key(entries: Column) -> Column:
    distinct_keys = F.size(F.array_distinct(F.transform(entries, lambda e: e["key"])))
    return F.when(distinct_keys == F.size(entries), entries).otherwise(
        F.filter(
            entries,
            lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"]),
        )
    )


def parse_label(text: Column) -> Column:
    """``struct(entries, malformed)``: entries in upper case, the last of a repeated key kept.

    Blank text has no entries; a part without a usable key and value makes the whole label malformed.
    """
    parts = F.filter(F.transform(F.split(text, ","), trim_all), lambda p: p != "")
    none = F.array().cast(_ENTRIES)
    entries = F.when(is_blank(text), none).otherwise(F.transform(parts, _entry))

    def finish(found: Column) -> Column:
        malformed = F.exists(found, lambda e: (e["key"] == "") | (e["value"] == ""))
        return F.struct(
            F.when(malformed, none).otherwise(_last_of_each_key(found)).alias("entries"),
            malformed.alias("malformed"),
        )

    return bind(entries, finish)


def label_value(entries: Column, key: Column) -> Column:
    return F.get(F.transform(F.filter(entries, lambda e: e["key"] == key), lambda e: e["value"]), F.lit(0))


def attribute_rule(attributes: Column) -> Column:
    """Compile an attribute list once per grant: ``struct(open, impossible, wanted)``.

    ``open`` lets everything pass (no attributes), ``impossible`` lets nothing pass (an attribute without a name or
    value), ``wanted`` holds the pairs a label must contain.
    """
    stated = F.filter(attributes, lambda a: a.isNotNull())
    return F.struct(
        (F.coalesce(F.size(attributes), F.lit(0)) <= 0).alias("open"),
        F.coalesce(F.exists(stated, lambda a: a["name"].isNull() | a["value"].isNull()), F.lit(False)).alias(
            "impossible"
        ),
        F.coalesce(
            F.array_distinct(
                F.transform(
                    stated, lambda a: F.struct(F.upper(a["name"]).alias("key"), F.upper(a["value"]).alias("value"))
                )
            ),
            F.array().cast(_ENTRIES),
        ).alias("wanted"),
    )


def rule_allows(rule: Column, label: Column) -> Column:
    """Whether a parsed label satisfies a compiled rule; set difference instead of a lookup per attribute."""
    return rule["open"] | (
        ~rule["impossible"] & ~label["malformed"] & (F.size(F.array_except(rule["wanted"], label["entries"])) == 0)
    )


def attributes_allow(attributes: Column, label: Column) -> Column:
    """Every attribute must be present in the label with the same value; no attributes means everyone may read."""
    return rule_allows(attribute_rule(attributes), label)


def refusal_reason(attributes: Column, label: Column) -> Column:
    """Reason code of the first attribute that fails, or null when the message may be read."""

    def judge(attribute: Column) -> Column:
        actual = label_value(label["entries"], F.upper(attribute["name"]))
        return (
            F.when(attribute.isNull(), F.lit(None).cast("string"))
            .when(attribute["name"].isNull() | attribute["value"].isNull(), INVALID_FILTER)
            .when(actual.isNull(), MISSING_ATTRIBUTE)
            .when(actual != F.upper(attribute["value"]), VALUE_MISMATCH)
        )

    verdicts = F.filter(F.transform(attributes, judge), lambda v: v.isNotNull())
    return (
        F.when(F.coalesce(F.size(attributes), F.lit(0)) <= 0, F.lit(None).cast("string"))
        .when(label["malformed"], BAD_LABEL)
        .otherwise(F.get(verdicts, F.lit(0)))
    )
