"""Every operator as a named query over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlake import session
from txnlake.functions.rules import COUNTRY_CURRENCY
from txnlake.operators import (
    detect,
    gold,
    layout,
    quality,
    reports,
    silver,
    validate,
    windows,
)
from txnlake.plans import lake, streams

Query = Callable[[SparkSession, str], DataFrame]


def _without_zone(df: DataFrame) -> DataFrame:
    """Timestamps as UTC wall-clock values, the form other engines compare with."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def _laid_out(name: str, rows: Callable[[SparkSession, str], DataFrame]) -> Query:
    """A stored layer written in clustered order and read back."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = session.scratch_dir(spark, f"layout_{name}")
        df = rows(spark, sf_dir)
        layout.write_clustered(df, name, path)
        return spark.read.schema(df.schema).parquet(path)

    return run


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fraud_alerts(lake.stored_silver(spark, sf_dir))


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lake.stored_silver(spark, sf_dir)
    return validate.run_summary(
        lake.stored_bronze(spark, sf_dir),
        rows,
        silver.quarantine(lake.stored_bronze(spark, sf_dir)),
        lake.stored_gold(spark, sf_dir),
        gold.fraud_alerts(rows),
    )


def post_validation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lake.stored_silver(spark, sf_dir)
    return validate.table_counts(
        bronze_transactions=lake.stored_bronze(spark, sf_dir),
        silver_transactions=rows,
        gold_merchant_analytics=lake.stored_gold(spark, sf_dir),
        gold_fraud_alerts=gold.fraud_alerts(rows),
    )


def currency_rule_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    currencies = spark.createDataFrame(
        list(COUNTRY_CURRENCY.items()), "country STRING, currency STRING"
    )
    return detect.currency_rule_join(lake.stored_silver(spark, sf_dir), currencies)


def _on_bronze_table(operator: Callable[..., DataFrame], *args) -> Query:
    return lambda spark, sf_dir: operator(lake.stored_bronze(spark, sf_dir), *args)


def _on_silver_table(operator: Callable[..., DataFrame], *args) -> Query:
    return lambda spark, sf_dir: operator(lake.stored_silver(spark, sf_dir), *args)


BATCH: dict[str, Query] = {
    "bronze_decode": lake.bronze,
    "silver_parse": _on_bronze_table(silver.parse),
    "silver_parse_literal": _on_bronze_table(silver.to_silver, "keep"),
    "silver_fraud_flags": _on_bronze_table(silver.to_silver),
    "quarantine": _on_bronze_table(silver.quarantine),
    "dq_bronze": lambda spark, sf_dir: quality.metrics(
        lake.bronze(spark, sf_dir), "bronze", quality.BRONZE_RULES
    ),
    "dq_silver": lambda spark, sf_dir: quality.metrics(
        silver.flagged(lake.stored_bronze(spark, sf_dir)), "silver", quality.SILVER_RULES
    ),
    "dq_gold": lambda spark, sf_dir: quality.metrics(
        gold.fraud_alerts(lake.stored_silver(spark, sf_dir)), "gold", quality.GOLD_RULES
    ),
    "gold_merchant_analytics": _on_silver_table(gold.merchant_analytics),
    "gold_fraud_alerts": _on_silver_table(gold.fraud_alerts),
    "alert_payload": _on_silver_table(gold.alert_messages),
    "post_validation_counts": post_validation_counts,
    "post_validation_stats": _on_silver_table(validate.fraud_stats),
    "post_validation_checks": lambda spark, sf_dir: validate.checks(
        lake.stored_bronze(spark, sf_dir), lake.stored_silver(spark, sf_dir)
    ),
    "bronze_summary": _on_bronze_table(reports.bronze_summary),
    "bronze_summary_sketches": _on_bronze_table(
        lambda bronze: reports.summary_of_sketches(reports.bronze_sketches(bronze))
    ),
    "bronze_preview": _on_bronze_table(reports.bronze_preview),
    "silver_preview": _on_silver_table(reports.silver_preview),
    "fraud_summary": _on_silver_table(reports.fraud_summary),
    "top_flagged": _on_silver_table(reports.top_flagged),
    "gold_by_volume": lambda spark, sf_dir: reports.gold_by_volume(
        gold.merchant_analytics(lake.stored_silver(spark, sf_dir))
    ),
    "recent_alerts": lambda spark, sf_dir: reports.recent_alerts(
        gold.fraud_alerts(lake.stored_silver(spark, sf_dir))
    ),
    "run_summary": run_summary,
    "layout_bronze": _laid_out("bronze_transactions", lake.stored_bronze),
    "layout_silver": _laid_out("silver_transactions", lake.stored_silver),
    "layout_alerts": _laid_out("gold_fraud_alerts", _alerts),
    "geo_hop": _on_silver_table(detect.geo_hop),
    "velocity_spike": _on_silver_table(detect.velocity_spike),
    "rolling_account_spend": _on_silver_table(detect.rolling_account_spend),
    "sliding_category_volume": _on_silver_table(windows.sliding_category_volume),
    "hourly_account_spend": _on_silver_table(windows.hourly_account_spend),
    "hourly_spend_by_account": _on_silver_table(windows.hourly_spend_by_account),
    "hourly_spend_by_category": _on_silver_table(windows.hourly_spend_by_category),
    "currency_rule_join": currency_rule_join,
}

STREAMS: dict[str, Query] = {
    "stream_bronze": streams.stream_bronze,
    "stream_silver": streams.stream_silver,
    "stream_quarantine": streams.stream_quarantine,
    "stream_fraud_alerts": streams.stream_fraud_alerts,
    "stream_alert_sink": streams.stream_alert_sink,
    "stream_gold_merchant": streams.stream_gold_merchant,
    "stream_dq": streams.stream_dq,
    "stream_restart": streams.stream_restart,
    "stream_geo_hop": streams.stream_geo_hop,
    "stream_sliding_volume": streams.stream_sliding_volume,
    "stream_velocity": streams.stream_velocity,
    "stream_late_data": streams.stream_late_data,
    "stream_late_rows": streams.stream_late_rows,
    "stream_currency_join": streams.stream_currency_join,
}


def _comparable(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        session.use_utc(spark)
        return _without_zone(query(spark, sf_dir))

    return run


def queries() -> dict[str, Query]:
    return {name: _comparable(query) for name, query in {**BATCH, **STREAMS}.items()}
