"""Governed fan-out: every message to every consumer entitled to it, in one pass over the messages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covenant.functions.headers import SECURITY_LABEL, header_first
from covenant.functions.labels import (
    attribute_rule,
    attributes_allow,
    label_value,
    parse_label,
    refusal_reason,
    rule_allows,
)
from covenant.operators.grants import entitlements
from covenant.operators.joins import keyed_join

Predicate = Callable[[Callable[[str], Column], Column], Column]
Shape = Callable[[DataFrame], DataFrame]


def attribute_filter(messages: DataFrame, attributes: Column) -> DataFrame:
    """Messages whose security label satisfies one attribute list."""
    label = parse_label(header_first(F.col("headers"), SECURITY_LABEL))
    return messages.withColumn("__label", label).where(attributes_allow(attributes, F.col("__label"))).drop("__label")


def with_refusal_reason(messages: DataFrame, attributes: Column) -> DataFrame:
    """Add ``reason``: why the message is refused under this attribute list, null when it is not."""
    label = parse_label(header_first(F.col("headers"), SECURITY_LABEL))
    return (
        messages.withColumn("__label", label)
        .withColumn("reason", refusal_reason(attributes, F.col("__label")))
        .drop("__label")
    )


def _labelled(messages: DataFrame) -> DataFrame:
    """The label is parsed once per message, before the fan-out."""
    return messages.withColumn("topic_key", F.lower("topic")).withColumn(
        "__label", parse_label(header_first(F.col("headers"), SECURITY_LABEL))
    )


_HELPERS = ("topic_key", "__label")


def _strict(label: Column, rule: Column, allowed: Column) -> Column:
    message = F.concat(F.lit("malformed security label: "), header_first(F.col("headers"), SECURITY_LABEL))
    return F.when(label["malformed"] & ~rule["open"], F.raise_error(message).cast("boolean")).otherwise(allowed)


def federate(
    messages: DataFrame,
    grants: DataFrame,
    *,
    requests: DataFrame | None = None,
    require_topic_grant: bool = True,
    on_bad_label: str = "quarantine",
    predicate: Predicate | None = None,
    shape: Shape | None = None,
    salt: bool = False,
) -> DataFrame:
    """Delivered messages: the message columns plus ``consumer_id``, one row per consumer and message.

    ``shape`` turns messages into what is sent. It is applied once to each message that anyone gets, before the fan-out,
    and must keep the columns it does not know.

    A malformed label is not delivered to consumers with attributes; ``on_bad_label="fail"`` stops the job instead.
    ``predicate`` adds a rule of the caller's own, given a label lookup and the attribute list.

    Give only the columns needed downstream: routing alone needs no payload.
    """
    labelled = _labelled(messages)
    rules = entitlements(grants, requests, require_topic_grant=require_topic_grant)
    rules = rules.withColumn("__rule", attribute_rule(F.col("attributes")))
    label, rule = F.col("__label"), F.col("__rule")
    allowed = rule_allows(rule, label)
    if on_bad_label == "fail":
        allowed = _strict(label, rule, allowed)
    if predicate is not None:
        allowed = allowed & predicate(lambda key: label_value(label["entries"], F.lit(key.upper())), F.col("attributes"))
    options = {
        "spread": ["partition", "offset"],
        "residual": allowed,
        "salt": salt,
    }
    if shape is not None:
        labelled = shape(keyed_join(labelled, rules, ["topic_key"], how="left_semi", **options))
    joined = keyed_join(labelled, rules, ["topic_key"], **options)
    return joined.select("consumer_id", *[c for c in labelled.columns if c not in _HELPERS])


def federate_decisions(
    messages: DataFrame,
    grants: DataFrame,
    *,
    requests: DataFrame | None = None,
    require_topic_grant: bool = True,
    shape: Shape | None = None,
    salt: bool = False,
) -> DataFrame:
    """Every message and consumer with access to its topic, and ``reason``: null when delivered, else why not.

    The payload of refused rows and its digest are dropped here, so that they stay small. ``shape`` is applied once per
    message, before the fan-out, as in :func:`federate`.
    """
    labelled = _labelled(messages)
    labelled = labelled if shape is None else shape(labelled)
    rules = entitlements(grants, requests, require_topic_grant=require_topic_grant)
    joined = keyed_join(
        labelled,
        rules,
        ["topic_key"],
        spread=["partition", "offset"],
        salt=salt,
    )
    decided = joined.withColumn("reason", refusal_reason(F.col("attributes"), F.col("__label")))
    kept = [
        F.when(F.col("reason").isNull(), F.col(c)).alias(c) if c in ("value", "payload_checksum") else F.col(c)
        for c in labelled.columns
        if c not in _HELPERS
    ]
    return decided.select("consumer_id", *kept, "reason")


def delivered(decisions: DataFrame) -> DataFrame:
    return decisions.where("reason IS NULL").drop("reason")


def refused(decisions: DataFrame) -> DataFrame:
    return decisions.where("reason IS NOT NULL")


def delivered_counts(delivered_rows: DataFrame) -> DataFrame:
    return delivered_rows.groupBy("consumer_id", "topic").agg(F.count(F.lit(1)).alias("messages"))
