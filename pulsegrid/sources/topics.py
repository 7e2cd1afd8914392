"""Message topics: Kafka on a cluster, files with the same row shape where there is no broker."""

from ..schemas import ENVELOPE_SCHEMA


def kafka_options(servers, topic, fail_on_data_loss=True, starting_offsets="earliest"):
    """``starting_offsets`` counts only for a new checkpoint; "latest" skips what came while no job was there."""
    return {
        "startingOffsets": starting_offsets,
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }


def read_topic(spark, fmt="kafka", options=None, path=None):
    """Stream of (key, value, topic, ...) rows. Kafka needs its connector on the class path."""
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        return reader.load()
    return reader.schema(ENVELOPE_SCHEMA).load(path).select(*ENVELOPE_SCHEMA.names)


def write_topic(messages, fmt="kafka", options=None, path=None, mode="append"):
    """Batch write of routed messages; Kafka takes each row's topic from its ``topic`` column."""
    if fmt == "kafka":
        messages = messages.select("key", "value", "topic")
    else:
        messages = messages.select("key", "value", "topic", messages["timestamp"].try_cast("timestamp").alias("timestamp"))
    messages.write.format(fmt).options(**(options or {})).mode(mode).save(path)
