"""Fan-out for large grants tables: labels and rules are judged by class, and only accepted pairs of classes are expanded.

Consumers whose attribute lists say the same are one rule class of their topic, messages whose labels say the same one label
class. Every rule class is looked up by its rarest attribute, the one that the fewest label classes of its topic have, so that
a class pair is judged only where that attribute agrees. A message is joined with the rules that accept its label and
then with their members: it is never held against a consumer who does not get it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covenant.functions.labels import attribute_rule, label_value
from covenant.operators.federation import _HELPERS, Predicate, Shape, _labelled
from covenant.operators.grants import entitlements
from covenant.operators.joins import keyed_join
from covenant.session import scratch_path, written


def _spelled(text: Column) -> Column:
    """A text with its length before it, so that no two lists of texts are spelled alike."""
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _pair(entry: Column) -> Column:
    return F.concat(_spelled(entry["key"]), _spelled(entry["value"]))


def label_class(label: Column) -> Column:
    """What a parsed label says, whatever the order of its entries: the name of its class."""
    return F.when(label["malformed"], F.lit("!")).otherwise(F.array_join(F.array_sort(F.transform(label["entries"], _pair)), ","))


def rule_classes(rules: DataFrame, *, ordered: bool = False) -> DataFrame:
    """``rules`` (consumer_id, topic_key, attributes) with ``rule`` (compiled) and ``rule_class``, one name for all lists that
    want the same of a label; ``ordered`` tells lists apart that are written differently. Impossible rules are left out."""
    rule = attribute_rule(F.col("attributes"))
    named = rules.withColumn("rule", rule).where("NOT rule.impossible OR rule.open")
    meaning = F.when(F.col("rule.open"), F.lit("*")).otherwise(F.array_join(F.array_sort(F.transform("rule.wanted", _pair)), ","))
    if ordered:
        listed = F.transform("attributes", lambda a: F.concat(_spelled(a["name"]), _spelled(a["value"])))
        meaning = F.concat(meaning, F.lit("|"), F.coalesce(F.array_join(listed, ",", "-"), F.lit("")))
    return named.withColumn("rule_class", meaning)


def accepted_classes(labels: DataFrame, rules: DataFrame, *, predicate: Predicate | None = None) -> DataFrame:
    """(topic_key, label_class, rule_class) of the label classes that rule classes accept.

    ``labels`` has ``topic_key, label_class, label`` and ``rules`` ``topic_key, rule_class, rule, attributes``, each class once.
    """
    accepted = F.lit(True)
    if predicate is not None:
        accepted = predicate(lambda key: label_value(F.col("label.entries"), F.lit(key.upper())), F.col("attributes"))
    # A class of open rules takes every label of its topic.
    every = labels.join(rules.where("rule.open"), "topic_key").where(accepted)
    entries = labels.where("NOT label.malformed").select(
        "topic_key", "label_class", "label", F.explode(F.transform("label.entries", _pair)).alias("pair")
    )
    frequent = entries.groupBy("topic_key", "pair").agg(F.count(F.lit(1)).alias("labels"))
    wanted = rules.where("NOT rule.open").select(
        "topic_key", "rule_class", F.size("rule.wanted").alias("pairs"), F.explode(F.transform("rule.wanted", _pair)).alias("pair")
    )
    # A rule that wants what no label of its topic has is left out here, whatever else it wants.
    rarest = (
        wanted.join(frequent, ["topic_key", "pair"])
        .groupBy("topic_key", "rule_class", "pairs")
        .agg(F.count(F.lit(1)).alias("known"), F.min(F.struct("labels", "pair")).alias("least"))
        .where("known = pairs")
        .select("topic_key", "rule_class", F.col("least.pair").alias("pair"))
    )
    entered = rules.join(rarest, ["topic_key", "rule_class"])
    met = entries.join(entered, ["topic_key", "pair"]).where(F.size(F.array_except("rule.wanted", "label.entries")) == 0)
    # A rule without any pair that is not open (its list holds nulls only) takes every label that is not malformed.
    empty = labels.where("NOT label.malformed").join(rules.where("NOT rule.open AND size(rule.wanted) = 0"), "topic_key")
    columns = ["topic_key", "label_class", "rule_class"]
    return every.select(*columns).union(met.where(accepted).select(*columns)).union(empty.where(accepted).select(*columns))


def federate_classes(
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
    """The rows of :func:`covenant.operators.federation.federate`, judged by class.

    For topics with many consumers and messages: a label class is judged once, not once per message and consumer. The topics of
    the messages and then the rules for them are written as tables first; messages are read three times, for their topics, for
    their classes and for the expansion. ``predicate`` may look at the label and the attribute list, as there.
    """
    spark = messages.sparkSession
    labelled = _labelled(messages).withColumn("label_class", label_class(F.col("__label")))
    ordered = predicate is not None
    topics = written(labelled.select("topic_key").distinct(), scratch_path(spark, "topics"))
    entitled = entitlements(grants, requests, require_topic_grant=require_topic_grant, topics=topics, ordered=ordered)
    named = rule_classes(entitled, ordered=ordered).select("topic_key", "rule_class", "consumer_id", "attributes")
    rules = written(named, scratch_path(spark, "rules"))
    labels = labelled.groupBy("topic_key", "label_class").agg(F.any_value("__label").alias("label"))
    # Lists of a class are few, however many consumers have them, so they are folded as they are first.
    variants = rules.select("topic_key", "rule_class", "attributes").distinct()
    classes = variants.groupBy("topic_key", "rule_class").agg(F.any_value("attributes").alias("attributes"))
    classes = classes.withColumn("rule", attribute_rule(F.col("attributes")))
    accepted = accepted_classes(labels, classes, predicate=predicate)
    if on_bad_label == "fail":
        closed = classes.groupBy("topic_key").agg(F.bool_or(~F.col("rule.open")).alias("closed"))
        message = F.concat(F.lit("malformed security label on topic "), "topic_key")
        # No rule class has this name; the rows are there for the error they raise, which stays guarded by its condition.
        stop = F.when(F.col("label.malformed") & F.col("closed"), F.raise_error(message)).otherwise("!")
        stopped = labels.join(closed, "topic_key").select("topic_key", "label_class", stop.alias("rule_class"))
        accepted = accepted.union(stopped)
    place, spread = ["topic_key", "label_class"], ["partition", "offset"]
    if shape is not None:
        got = accepted.select(*place).distinct()
        labelled = shape(keyed_join(labelled, got, place, how="left_semi", spread=spread, salt=salt))
    taken = keyed_join(labelled, accepted, place, spread=spread, salt=salt)
    members = rules.select("topic_key", "rule_class", "consumer_id")
    joined = keyed_join(taken, members, ["topic_key", "rule_class"], spread=spread, salt=salt)
    helpers = (*_HELPERS, "label_class", "rule_class")
    return joined.select("consumer_id", *[c for c in labelled.columns if c not in helpers])
