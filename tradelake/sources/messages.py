"""Message source and sink: Kafka, or files with Kafka's `key` and `value` columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.schemas import MESSAGE


def read_stream(
    spark: SparkSession, place: str, topic: str, fmt: str = "kafka", **options: str
) -> DataFrame:
    """Streaming messages of one topic, from its beginning.

    `place` is the bootstrap servers for Kafka, else the folder that holds a folder per topic.
    """
    if fmt == "kafka":
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", place)
            .option("subscribe", topic)
            .option("startingOffsets", "earliest")
            .option("failOnDataLoss", "false")
        )
        return reader.options(**options).load()
    reader = spark.readStream.options(**options)
    if fmt == "text":
        return reader.text(f"{place}/{topic}")
    return reader.schema(MESSAGE).format(fmt).load(f"{place}/{topic}")


def read_batch(spark: SparkSession, place: str, topic: str, fmt: str = "kafka") -> DataFrame:
    if fmt == "kafka":
        return (
            spark.read.format("kafka")
            .option("kafka.bootstrap.servers", place)
            .option("subscribe", topic)
            .load()
        )
    if fmt == "text":
        return spark.read.text(f"{place}/{topic}")
    return spark.read.schema(MESSAGE).format(fmt).load(f"{place}/{topic}")


def write(messages: DataFrame, place: str, topic: str, fmt: str = "kafka") -> None:
    """Append `key` and `value` to a topic; a text file keeps the values only."""
    rows = messages.select(F.col("key").cast("binary"), F.col("value").cast("binary"))
    if fmt == "kafka":
        (
            rows.write.format("kafka")
            .option("kafka.bootstrap.servers", place)
            .option("kafka.acks", "all")
            .option("topic", topic)
            .save()
        )
    elif fmt == "text":
        messages.select(F.col("value").cast("string")).write.mode("append").text(f"{place}/{topic}")
    else:
        rows.write.mode("append").format(fmt).save(f"{place}/{topic}")
