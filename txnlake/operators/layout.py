"""Physical layout of stored tables: rows that are read together lie together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Clustering columns of each table.
CLUSTER_BY = {
    "bronze_transactions": ["kafka_partition", "ingestion_date"],
    "silver_transactions": ["account_id", "transaction_date"],
    "gold_merchant_analytics": ["merchant_category", "transaction_date"],
    "gold_fraud_alerts": ["fraud_reasons", "event_timestamp"],
}

# Added to the range keys so that one value of the clustering columns can span several files.
SPREAD_BY = {
    "bronze_transactions": ["kafka_offset"],
    "silver_transactions": ["event_timestamp", "transaction_id"],
    "gold_merchant_analytics": ["transaction_hour", "country"],
    "gold_fraud_alerts": ["transaction_id"],
}


ROWS_PER_FILE = 2_000_000


def write_clustered(df: DataFrame, table: str, path: str, rows_per_file: int = ROWS_PER_FILE):
    """Write in clustered order, in files of bounded size whatever the number of partitions."""
    writer = clustered(df, table).write.option("maxRecordsPerFile", rows_per_file)
    writer.mode("errorifexists").parquet(path)


def clustered(df: DataFrame, table: str, files: int | None = None) -> DataFrame:
    """Range-partition and sort for a write, so that Parquet statistics skip files and pages.

    A hot account or date is split over several ranges by the extra columns.
    """
    keys = [F.col(name) for name in CLUSTER_BY[table] + SPREAD_BY[table]]
    ranged = df.repartitionByRange(*keys) if files is None else df.repartitionByRange(files, *keys)
    return ranged.sortWithinPartitions(*keys)
