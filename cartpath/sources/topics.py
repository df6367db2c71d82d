"""Events on a topic: reading, decoding, encoding and publishing.

Reading and publishing need the public Kafka connector on the class path; decoding and encoding are
plain DataFrame steps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpath.sources.schemas import CORRUPT, EVENT_DDL, EVENT_FIELDS


def read_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """The topic as a stream, from its earliest message on."""
    return (
        spark.readStream.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest", **options})
        .load()
    )


def decode_events(messages: DataFrame, schema: str = EVENT_DDL, keep: tuple[str, ...] = ()) -> DataFrame:
    """Nested events from the JSON text in ``value``, with the columns in ``keep``.

    Text that gives no event id, since it cannot be parsed or is something else, is kept whole in
    ``_corrupt_record``, so that ingesting the result puts it into quarantine.
    """
    text = F.col("value").cast("string").alias("text")
    event = F.from_json(F.col("text"), schema).alias("event")
    rejected = F.when(F.col("event._id").isNull(), F.col("text")).alias(CORRUPT)
    return messages.select(text, *keep).select(event, "text", *keep).select("event.*", rejected, *keep)


def encode_events(events: DataFrame) -> DataFrame:
    """Messages of events: key is the event id, value its JSON text in bytes."""
    body = F.to_json(F.struct(*EVENT_FIELDS))
    return events.select(F.col("_id").cast("binary").alias("key"), F.encode(body, "UTF-8").alias("value"))


def publish_events(events: DataFrame, servers: str, topic: str, **options: str) -> None:
    encode_events(events).write.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "topic": topic, **options}
    ).save()
