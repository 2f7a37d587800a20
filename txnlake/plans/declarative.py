"""The pipeline as definitions for Spark Declarative Pipelines.

A definitions file of a pipeline project calls `declare` with its source and sink; the pipeline
runner then creates the tables and decides what to run.  The transformations are those of
`txnlake.operators`.
"""

from __future__ import annotations

from pyspark import pipelines as dp
from pyspark.sql import DataFrame, SparkSession

from txnlake.functions.rules import Rule
from txnlake.operators import gold, quality, silver
from txnlake.operators.bronze import to_bronze
from txnlake.operators.layout import CLUSTER_BY
from txnlake.plans import config
from txnlake.sources.kafka import FileSource, KafkaSink, KafkaSource


def _table_options(name: str) -> dict:
    return {
        "name": name,
        "comment": config.COMMENTS[name],
        "table_properties": {"quality": config.QUALITY[name]},
        "cluster_by": CLUSTER_BY.get(name),
    }


def declare(
    source: KafkaSource | FileSource,
    sink: KafkaSink,
    corrupt_policy: str = "drop",
    rules: list[Rule] | None = None,
) -> None:
    """Register all tables, the metric view, the alert sink and its flow."""

    def session() -> SparkSession:
        return SparkSession.active()

    def follow(name: str) -> DataFrame:
        return session().readStream.table(name)

    @dp.table(**_table_options(config.BRONZE))
    def bronze_transactions() -> DataFrame:
        return quality.observe(
            to_bronze(source.load(session())), "bronze", quality.BRONZE_RULES
        )

    @dp.table(**_table_options(config.SILVER))
    def silver_transactions() -> DataFrame:
        return silver.to_silver(follow(config.BRONZE), corrupt_policy, rules, observed=True)

    @dp.table(**_table_options(config.QUARANTINE))
    def silver_quarantine() -> DataFrame:
        return silver.quarantine(follow(config.BRONZE), corrupt_policy)

    @dp.materialized_view(**_table_options(config.GOLD))
    def gold_merchant_analytics() -> DataFrame:
        return gold.merchant_analytics(session().read.table(config.SILVER))

    @dp.table(**_table_options(config.ALERTS))
    def gold_fraud_alerts() -> DataFrame:
        return gold.fraud_alerts(follow(config.SILVER), observed=True)

    dp.create_sink(config.ALERT_SINK, "kafka", sink.options())

    @dp.append_flow(target=config.ALERT_SINK, name="emit_fraud_alerts")
    def emit_fraud_alerts() -> DataFrame:
        return gold.alert_messages(follow(config.SILVER))
