"""Position messages: topic options, JSON encoding and permissive decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.schema import CORRUPT, MAX_OFFSETS_PER_TRIGGER, PARSE_SCHEMA


def topic_options(servers: str, topic: str, streaming: bool,
                  max_offsets: int = MAX_OFFSETS_PER_TRIGGER) -> dict[str, str]:
    """Reader options: a stream from the earliest offset, or the bounded range up to now."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if streaming:
        return {**options, "maxOffsetsPerTrigger": str(max_offsets), "failOnDataLoss": "false"}
    return {**options, "endingOffsets": "latest"}


def read_topic(spark: SparkSession, servers: str, topic: str, streaming: bool = True,
               max_offsets: int = MAX_OFFSETS_PER_TRIGGER) -> DataFrame:
    """Messages of a topic; needs Spark's Kafka connector on the class path."""
    reader = spark.readStream if streaming else spark.read
    return reader.format("kafka").options(
        **topic_options(servers, topic, streaming, max_offsets)
    ).load()


def write_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Publish a batch of key/value rows."""
    (messages.select("key", "value").write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())


def to_messages(positions: DataFrame, key: str = "MMSI") -> DataFrame:
    """One keyed JSON message per row, holding the row's own columns."""
    body = F.to_json(F.struct(*positions.columns), {"ignoreNullFields": "false"})
    return positions.select(F.col(key).cast("string").alias("key"), body.alias("value"))


def parse_messages(messages: DataFrame, with_metadata: bool = True) -> DataFrame:
    """Decode JSON into text fields; undecodable values keep their text in _corrupt_record."""
    body = F.from_json(
        F.col("value").cast("string"),
        PARSE_SCHEMA,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    metadata = [
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
    ]
    # Generated columns, not a projected struct: filters on the fields then stay above the parser
    # and the text is decoded once per row.
    return messages.select(*(metadata if with_metadata else []), F.inline(F.array(body)))
