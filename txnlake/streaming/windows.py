"""Streaming forms of the windowed aggregates: state ends with the watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame

from txnlake.operators import windows

WATERMARK = "10 minutes"


def sliding_category_volume(silver: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Append mode: a window is emitted once the watermark has passed its end."""
    timed = silver.withWatermark("event_timestamp", watermark)
    return windows.sliding_volume(timed, ["merchant_category"])


def account_velocity(silver: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Append mode: accounts that reach the count in a closed window."""
    return windows.account_velocity(silver.withWatermark("event_timestamp", watermark))


def hourly_spend(silver: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Append mode: spend per closed hour, account and category; later rows are dropped."""
    return windows.hourly_account_spend(silver.withWatermark("event_timestamp", watermark))
