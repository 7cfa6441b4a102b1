"""Kafka readers and writers. They need the Kafka connector on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

# Delivery guarantees of the publisher.
PUBLISH_OPTIONS = {"kafka.acks": "all", "kafka.retries": "5", "kafka.delivery.timeout.ms": "120000"}


def read_options(
    servers: str, topic: str, starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None
) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting_offsets}
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def write_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, **PUBLISH_OPTIONS}


def subscribe(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Stream ``key``/``value``; ``max_offsets_per_trigger`` paces the consumer."""
    return spark.readStream.format("kafka").options(**read_options(servers, topic, **options)).load()


def publish(messages: DataFrame, servers: str, topic: str) -> None:
    """Write ``value`` (and ``key``, if there is one) messages of a batch."""
    messages.write.format("kafka").options(**write_options(servers, topic)).save()


def publish_stream(messages: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """The same for a stream; the caller sets the trigger and starts it."""
    options = {**write_options(servers, topic), "checkpointLocation": checkpoint}
    return messages.writeStream.format("kafka").options(**options)
