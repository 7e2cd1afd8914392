"""Tag to topic, and message order inside a case."""

from pyspark.sql import functions as F

# Which topic a tag goes to; a few rows written by hand, so it is folded into the expression, not joined.
DEFAULT_ROUTES = {"patient.vitals": "vitals"}


def route(messages, routes=None):
    """Adds ``topic``; NULL for a tag no route names (see ``unrouted``)."""
    topic = F.lit(None).cast("string")
    for tag, name in (routes or DEFAULT_ROUTES).items():
        topic = F.when(F.col("tag") == tag, F.lit(name)).otherwise(topic)
    return messages.withColumn("topic", topic)


def routed(messages, routes=None):
    return route(messages, routes).where(F.col("topic").isNotNull())


def unrouted(messages, routes=None):
    return route(messages, routes).where(F.col("topic").isNull())


def in_case_order(messages, parts=None):
    """Time order inside each case: all messages of a key in one partition, in order. For messages of one block of time, whose
    length bounds those of a key. ``parts`` is the number of partitions; without it the cluster decides."""
    dealt = messages.repartition("key") if parts is None else messages.repartition(parts, "key")
    return dealt.sortWithinPartitions("key", "timestamp")


def union_inputs(first, *others):
    """Messages of several inputs as one, matched by column name."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
