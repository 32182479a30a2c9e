"""Kafka-compatible topics: options, stream and bounded reads, publishing, and replay from files.

The Kafka connector is a package of its own and has to be on the class path of the session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from marketspark.schemas import RAW_TOPIC, TOPIC_ROW


# How topics are read and written unless a caller says otherwise.
READING = {
    "startingOffsets": "earliest",
    "failOnDataLoss": "false",
    "kafka.isolation.level": "read_committed",
    "kafka.max.poll.interval.ms": "600000",
}
PUBLISHING = {
    "kafka.acks": "all",
    "kafka.enable.idempotence": "true",
    "kafka.compression.type": "snappy",
    "kafka.max.in.flight.requests.per.connection": "5",
    "kafka.retries": "3",
    "kafka.request.timeout.ms": "30000",
}


def reading_options(servers: str, topic: str = RAW_TOPIC, group: str = "marketspark", **changes: object) -> dict[str, str]:
    """Source options for a topic. ``changes`` are further options by their own names, and win."""
    chosen = {"kafka.bootstrap.servers": servers, "subscribe": topic, "kafka.group.id": group, **READING, **changes}
    return {name: str(value) for name, value in chosen.items() if value is not None}


def publishing_options(servers: str, client: str = "marketspark", **changes: object) -> dict[str, str]:
    """Sink options; ``changes`` as in ``reading_options``."""
    chosen = {"kafka.bootstrap.servers": servers, "kafka.client.id": client, **PUBLISHING, **changes}
    return {name: str(value) for name, value in chosen.items() if value is not None}


def topic_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def topic_table(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """All messages present when the job starts."""
    bounded = {name: value for name, value in options.items() if name != "maxOffsetsPerTrigger"}
    return spark.read.format("kafka").options(**bounded, endingOffsets="latest").load()


def publish(messages: DataFrame, options: dict[str, str], checkpoint: str | None = None) -> StreamingQuery | None:
    """Send ``(key, value, topic[, headers])`` rows; a stream needs a checkpoint and returns its query."""
    if "headers" in messages.columns:
        options = {**options, "includeHeaders": "true"}
    if not messages.isStreaming:
        messages.write.format("kafka").options(**options).save()
        return None
    if checkpoint is None:
        raise ValueError("a stream of messages needs a checkpoint")
    return messages.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint).start()


def replay_files(
    spark: SparkSession,
    path: str,
    schema: StructType = TOPIC_ROW,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Stored rows as a stream. With ``max_files_per_trigger`` the files are taken in batches, oldest first."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
