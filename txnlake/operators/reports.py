"""Summary and top-k reports over the stored layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake import schemas
from txnlake.operators.gold import GROUP_KEYS

SKETCH_BITS = 14  # 2^14 registers: a standard error of 0.8 %


def bronze_preview(bronze: DataFrame, rows: int = 10) -> DataFrame:
    """The first messages by topic position."""
    position = ["kafka_topic", "kafka_partition", "kafka_offset"]
    return bronze.orderBy(*position).limit(rows)


def bronze_summary(bronze: DataFrame, approximate: bool = False) -> DataFrame:
    """Row count, distinct keys, time range and missing payloads."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return bronze.agg(
        F.count(F.lit(1)).alias("total_rows"),
        distinct("kafka_key").alias("unique_accounts"),
        F.min("kafka_timestamp").alias("earliest_message"),
        F.max("kafka_timestamp").alias("latest_message"),
        F.count_if(F.col("raw_value").isNull()).alias("null_payloads"),
    )


def bronze_sketches(bronze: DataFrame) -> DataFrame:
    """What the summary needs of each date, mergeable: counts, time range and a sketch of the keys.

    A sketch has 16 KB at most, whatever the number of keys; messages without a time have a NULL date.
    """
    return bronze.groupBy(F.to_date("kafka_timestamp").alias("message_date")).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.hll_sketch_agg("kafka_key", SKETCH_BITS).alias("accounts"),
        F.min("kafka_timestamp").alias("earliest_message"),
        F.max("kafka_timestamp").alias("latest_message"),
        F.count_if(F.col("raw_value").isNull()).alias("null_payloads"),
    )


def summary_of_sketches(sketches: DataFrame) -> DataFrame:
    """`bronze_summary` from the rows of any dates; distinct keys within about 2 %."""
    return sketches.agg(
        F.coalesce(F.sum("total_rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("accounts")), F.lit(0)).alias(
            "unique_accounts"
        ),
        F.min("earliest_message").alias("earliest_message"),
        F.max("latest_message").alias("latest_message"),
        F.coalesce(F.sum("null_payloads"), F.lit(0)).alias("null_payloads"),
    )


def silver_preview(silver: DataFrame, rows: int = 20) -> DataFrame:
    """The first transactions by id."""
    return (
        silver.select(
            "transaction_id",
            "account_id",
            "amount",
            "currency",
            "transaction_type",
            "merchant_name",
            "merchant_category",
            "city",
            "country",
            "is_fraud",
            "fraud_reasons",
        )
        .orderBy("transaction_id")
        .limit(rows)
    )


def fraud_summary(silver: DataFrame) -> DataFrame:
    """Fraud rate and hits per rule."""
    frauds, total = F.count_if("is_fraud"), F.count(F.lit(1))
    return silver.agg(
        total.alias("total_transactions"),
        frauds.alias("fraud_count"),
        F.round(F.try_divide(frauds * F.lit(100.0), total), 2).alias("fraud_pct"),
        F.count_if("is_high_amount").alias("high_amount_count"),
        F.count_if("is_international_atm").alias("intl_atm_count"),
        F.count_if("is_suspicious_currency").alias("suspicious_currency_count"),
        F.count_if("is_high_value_online").alias("high_value_online_count"),
    )


def top_flagged(silver: DataFrame, rows: int = 20) -> DataFrame:
    """The largest flagged transactions; ties by id."""
    return (
        silver.filter("is_fraud")
        .select(
            "transaction_id",
            "account_id",
            "amount",
            "currency",
            "transaction_type",
            "city",
            "country",
            "fraud_reasons",
        )
        .orderBy(F.desc_nulls_last("amount"), "transaction_id")
        .limit(rows)
    )


def gold_by_volume(gold: DataFrame) -> DataFrame:
    """All metric groups, the largest volume first; ties by key."""
    return gold.orderBy(F.desc_nulls_last("total_volume_usd"), *GROUP_KEYS).select(
        *schemas.names(schemas.GOLD)
    )


def recent_alerts(alerts: DataFrame, rows: int = 25) -> DataFrame:
    """The latest alerts; ties by id."""
    return (
        alerts.select(
            "transaction_id",
            "account_id",
            "amount",
            "currency",
            "merchant_name",
            "city",
            "country",
            "fraud_reasons",
            "event_timestamp",
        )
        .orderBy(F.desc_nulls_last("event_timestamp"), "transaction_id")
        .limit(rows)
    )
