"""Event-time windows over silver rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sliding_volume(
    rows: DataFrame, keys: list[str], window: str = "5 minutes", slide: str = "1 minute"
) -> DataFrame:
    """Count and volume per sliding window, for streams: the watermark closes the windows.

    One aggregate, thus one shuffle and one state store.  A row enters each of its windows, but tasks
    add rows up before anything is shuffled.  A late row counts in those of its windows that are open.
    """
    grouped = rows.groupBy(F.window("event_timestamp", window, slide), *keys).agg(
        F.count(F.lit(1)).alias("txn_count"), F.round(F.sum("amount"), 2).alias("volume")
    )
    return grouped.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *keys,
        "txn_count",
        "volume",
    )


def sliding_category_volume(
    silver: DataFrame, window_minutes: int = 5, slide_minutes: int = 1
) -> DataFrame:
    """Count and volume per category over sliding windows, for stored rows.

    Each row is added once, to the pane of length `slide_minutes` it falls in; windows are sums
    of panes.  Spark's own sliding window would copy every row into each of its windows first.
    """
    if window_minutes % slide_minutes:
        raise ValueError("the window must be a multiple of the slide")
    panes = silver.groupBy(
        F.window("event_timestamp", f"{slide_minutes} minutes").start.alias("pane"),
        "merchant_category",
    ).agg(F.count(F.lit(1)).alias("txn_count"), F.sum("amount").alias("volume"))
    slide = F.make_dt_interval(mins=F.lit(slide_minutes))
    reach = F.make_dt_interval(mins=F.lit(window_minutes - slide_minutes))
    starts = F.sequence(F.col("pane") - reach, F.col("pane"), slide)
    return (
        panes.withColumn("window_start", F.explode(starts))
        .groupBy("window_start", "merchant_category")
        .agg(F.sum("txn_count").alias("txn_count"), F.round(F.sum("volume"), 2).alias("volume"))
        .select(
            "window_start",
            (F.col("window_start") + F.make_dt_interval(mins=F.lit(window_minutes))).alias(
                "window_end"
            ),
            "merchant_category",
            "txn_count",
            "volume",
        )
    )


def hourly_spend(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Count, sum and average of the amounts per clock hour and `keys`."""
    grouped = rows.groupBy(F.window("event_timestamp", "1 hour"), *keys).agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.round(F.sum("amount"), 2).alias("spend"),
        F.round(F.avg("amount"), 2).alias("avg_spend"),
    )
    return grouped.select(
        F.col("window.start").alias("hour_start"), *keys, "txn_count", "spend", "avg_spend"
    )


def hourly_account_spend(silver: DataFrame) -> DataFrame:
    """Spend per clock hour, account and category."""
    return hourly_spend(silver, ["account_id", "merchant_category"])


def hourly_spend_by_account(silver: DataFrame) -> DataFrame:
    """Spend per clock hour and account."""
    return hourly_spend(silver, ["account_id"])


def hourly_spend_by_category(silver: DataFrame) -> DataFrame:
    """Spend per clock hour and category."""
    return hourly_spend(silver, ["merchant_category"])


def account_velocity(
    rows: DataFrame, window: str = "60 minutes", slide: str = "10 minutes", at_least: int = 3
) -> DataFrame:
    """Accounts with at least `at_least` transactions in a sliding window."""
    counted = sliding_volume(rows, ["account_id"], window, slide)
    return counted.filter(F.col("txn_count") >= at_least)
