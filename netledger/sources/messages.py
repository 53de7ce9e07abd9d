"""Message streams: one text ``value`` per row and where it came from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_stream(spark: SparkSession, servers: str, topics: str,
                 max_per_trigger: int | None = None) -> DataFrame:
    """Messages of one topic or a comma list of topics, from the earliest offset."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topics).option("startingOffsets", "earliest"))
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().select(F.col("value").cast("string").alias("value"),
                                F.struct("timestamp", "partition", "offset").alias("origin"))


def file_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Messages from text files that appear in ``folder``, one per line."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(folder).select("value", F.struct(
        F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block")).alias("origin"))


def file_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The same files as a batch."""
    return spark.read.text(folder).select("value", F.struct(
        F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block")).alias("origin"))


def union(*streams: DataFrame) -> DataFrame:
    """Several streams of one shape as one."""
    result = streams[0]
    for other in streams[1:]:
        result = result.unionByName(other)
    return result


def with_arrival(batch: DataFrame) -> DataFrame:
    """Replace ``origin`` by an arrival order that is total within the batch."""
    return batch.withColumn("arrival", F.struct(
        "origin", F.monotonically_increasing_id().alias("row"))).drop("origin")
