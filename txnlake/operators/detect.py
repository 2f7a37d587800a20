"""Account-level detection and rolling spend over stored silver rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.functions.geo import haversine_km, speed_kmh
from txnlake.functions.rules import differs_from_expected
from txnlake.operators import timeline

MAX_GAP_SECONDS = 3600
VELOCITY_SECONDS = 3600
VELOCITY_COUNT = 3
SPEND_SECONDS = 3600


def hop_report(hops: DataFrame) -> DataFrame:
    """Distance and implied speed of rows that carry a `previous` struct."""
    gap = (F.unix_micros("event_timestamp") - F.unix_micros("previous.event_timestamp")) / 1e6
    km = haversine_km(
        F.col("previous.latitude"),
        F.col("previous.longitude"),
        F.col("latitude"),
        F.col("longitude"),
    )
    return hops.select(
        "account_id",
        "transaction_id",
        "event_timestamp",
        "country",
        F.col("previous.transaction_id").alias("previous_transaction_id"),
        F.col("previous.event_timestamp").alias("previous_timestamp"),
        F.col("previous.country").alias("previous_country"),
        F.round(gap, 3).alias("gap_seconds"),
        F.round(km, 3).alias("distance_km"),
        F.round(speed_kmh(km, gap), 2).alias("speed_kmh"),
    )


HOP_CARRIED = ["transaction_id", "event_timestamp", "country", "latitude", "longitude"]


def is_hop(max_gap_seconds: int) -> Column:
    """Country differs from the row before, at most `max_gap_seconds` earlier."""
    gap = F.unix_micros("event_timestamp") - F.unix_micros("previous.event_timestamp")
    near = gap <= max_gap_seconds * 1_000_000
    return (F.col("country") != F.col("previous.country")) & near


def geo_hop(silver: DataFrame, max_gap_seconds: int = MAX_GAP_SECONDS) -> DataFrame:
    """Transactions in another country than the account's transaction shortly before."""
    visits = silver.select("account_id", *HOP_CARRIED)
    ordered = timeline.with_previous(
        visits,
        "account_id",
        "event_timestamp",
        "transaction_id",
        HOP_CARRIED,
        max_gap_seconds,
    )
    return hop_report(ordered.filter(is_hop(max_gap_seconds)))


def velocity_spike(
    silver: DataFrame,
    seconds: int = VELOCITY_SECONDS,
    at_least: int = VELOCITY_COUNT,
) -> DataFrame:
    """Transactions that are at least the `at_least`-th of their account within `seconds`."""
    counted = timeline.with_trailing_sums(
        silver.select("account_id", "transaction_id", "event_timestamp", "amount"),
        "account_id",
        "event_timestamp",
        seconds,
        {"txn_count": F.lit(1).cast("bigint")},
    )
    return counted.filter(F.col("txn_count") >= at_least)


def rolling_account_spend(silver: DataFrame, seconds: int = SPEND_SECONDS) -> DataFrame:
    """Per transaction, count and amount of its account over the `seconds` up to it.

    Amounts are added as DECIMAL, so the sum does not depend on the order of the rows.  A missing
    amount counts as a transaction and adds nothing; so does one that no sum can hold (NaN,
    infinite, or of 33 digits and more), which `unsummed` counts.
    """
    exact = F.col("amount").try_cast("decimal(38,6)")
    summed = timeline.with_trailing_sums(
        silver.select("account_id", "transaction_id", "event_timestamp", "amount"),
        "account_id",
        "event_timestamp",
        seconds,
        {
            "txn_count": F.lit(1).cast("bigint"),
            "rolling_spend": exact,
            "unsummed": (F.col("amount").isNotNull() & exact.isNull()).cast("bigint"),
        },
    )
    return summed.withColumn("rolling_spend", F.round("rolling_spend", 2).cast("double"))


def currency_rule_join(transactions: DataFrame, currencies: DataFrame) -> DataFrame:
    """The currency rule with a `country, currency` table in place of the literal map.

    Of several rows for a country the alphabetically first currency counts, so a transaction
    never multiplies.  No broadcast hint: Spark broadcasts the table while it is below its size
    threshold and joins by sort otherwise.  `transactions` may be a stream.
    """
    expected = currencies.groupBy("country").agg(F.min("currency").alias("expected_currency"))
    suspicious = differs_from_expected(F.col("expected_currency"), F.col("currency"))
    return transactions.join(expected, "country", "left").select(
        "transaction_id",
        "country",
        "currency",
        "expected_currency",
        suspicious.alias("is_suspicious_currency"),
    )
