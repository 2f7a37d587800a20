"""Bronze: messages as they arrived, decoded to text, with their position in the topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_bronze(messages: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Decode Kafka-shaped rows.  `ingested_at` replaces the clock where a run must repeat."""
    if ingested_at is None:
        ingested_at = F.current_timestamp()
    return messages.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("raw_value"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        ingested_at.alias("ingestion_timestamp"),
        F.to_date(ingested_at).alias("ingestion_date"),
    )
