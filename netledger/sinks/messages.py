"""Message sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keyed(messages: DataFrame, topic: str) -> DataFrame:
    """Add the message key: topic name and send time in milliseconds."""
    return messages.select(F.concat_ws("_", F.lit(topic), F.unix_millis(F.current_timestamp())
                                       .cast("string")).alias("key"), "value")


def to_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Send a batch; with a ``key`` column the messages are keyed."""
    (messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("topic", topic).save())


def stream_to_kafka(messages: DataFrame, servers: str, topic: str, checkpoint: str):
    return (messages.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).option("checkpointLocation", checkpoint).start())


def to_console(messages: DataFrame, rows: int = 10):
    """Show the first rows of each micro-batch."""
    return (messages.writeStream.format("console").option("numRows", rows)
            .option("truncate", "false").start())
