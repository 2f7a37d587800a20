"""Gold: hourly metrics, alert rows and alert messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake import schemas
from txnlake.operators import quality

GROUP_KEYS = ["transaction_date", "transaction_hour", "merchant_category", "country"]

# Fields of the alert message, in order.
MESSAGE_FIELDS = [
    "transaction_id",
    "account_id",
    "card_number_masked",
    "timestamp",
    "amount",
    "currency",
    "transaction_type",
    "merchant_name",
    "merchant_category",
    "city",
    "country",
    "fraud_reasons",
]


# Sums from which the measures of any union of groups can be taken, over rows and over such sums.
STATES = {
    "n": ("count(1)", "sum(n)"),
    "amounts": ("count(amount)", "sum(amounts)"),
    "volume": ("sum(amount)", "sum(volume)"),
    "frauds": ("count_if(is_fraud)", "sum(frauds)"),
    "fraud_amounts": ("count(amount) FILTER (WHERE is_fraud)", "sum(fraud_amounts)"),
    "fraud_volume": ("sum(amount) FILTER (WHERE is_fraud)", "sum(fraud_volume)"),
}
PARTIALS = """
    transaction_date DATE, transaction_hour INT, merchant_category STRING, country STRING,
    n BIGINT, amounts BIGINT, volume DOUBLE, frauds BIGINT, fraud_amounts BIGINT,
    fraud_volume DOUBLE
"""
# A NULL flag is not fraud.  On no rows the count of frauds, the volumes and the rate are NULL, and
# so is the volume of frauds where every row is one without an amount.
MEASURES = {
    "total": "n",
    "volume": "round(volume, 2)",
    "average": "round(volume / nullif(amounts, 0), 2)",
    "frauds": "if(n > 0, frauds, NULL)",
    "fraud_volume": "round(if(fraud_amounts = 0 AND frauds < n, 0.0D, fraud_volume), 2)",
    "rate": "round(frauds * 100.0D / nullif(n, 0), 2)",
}
# The metric view, column by column.
GOLD_MEASURES = {
    "total_transactions": "total",
    "total_volume_usd": "volume",
    "avg_transaction_amount": "average",
    "fraud_transactions_count": "frauds",
    "fraud_volume_usd": "fraud_volume",
    "fraud_rate_pct": "rate",
}


def _states(over: int) -> list[Column]:
    return [F.expr(sql[over]).alias(name) for name, sql in STATES.items()]


def fraud_totals(rows: DataFrame, count, fraud_count, volume, fraud_volume, rate) -> DataFrame:
    """One row of counts, volumes and fraud rate of all transactions, under the given names."""
    names = {"total": count, "volume": volume, "frauds": fraud_count}
    names |= {"fraud_volume": fraud_volume, "rate": rate}
    measures = [F.expr(MEASURES[measure]).alias(name) for measure, name in names.items()]
    return rows.agg(*_states(0)).select(*measures)


def partials(silver: DataFrame) -> DataFrame:
    """Mergeable sums by date, hour, category and country; NULL keys form groups of their own."""
    return silver.groupBy(*GROUP_KEYS).agg(*_states(0))


def added(sums: DataFrame) -> DataFrame:
    """Partial sums of several batches as one of each group."""
    return sums.groupBy(*GROUP_KEYS).agg(*_states(1))


def _measured(sums: DataFrame) -> DataFrame:
    measures = [F.expr(MEASURES[m]).alias(name) for name, m in GOLD_MEASURES.items()]
    return sums.select(*GROUP_KEYS, *measures).select(*schemas.names(schemas.GOLD))


def merged(sums: DataFrame) -> DataFrame:
    """The metric view from the partial sums of any number of batches."""
    return _measured(added(sums))


def merged_sql(relation: str) -> str:
    """`merged` as SQL over a relation of partial sums."""
    keys = ", ".join(GROUP_KEYS)
    states = ", ".join(f"{sql[1]} AS {name}" for name, sql in STATES.items())
    named = {name: f"{MEASURES[m]} AS {name}" for name, m in GOLD_MEASURES.items()}
    columns = ", ".join(named.get(name, name) for name in schemas.names(schemas.GOLD))
    return f"SELECT {columns} FROM (SELECT {keys}, {states} FROM {relation} GROUP BY {keys})"


def merchant_analytics(silver: DataFrame) -> DataFrame:
    """Metrics by date, hour, category and country; NULL keys form groups of their own.

    The volumes add `amount` over all currencies as it stands: nothing is converted to USD.
    Partial aggregation leaves one row per group and task to shuffle, whatever the key skew.
    """
    return _measured(partials(silver))


def fraud_alerts(silver: DataFrame, observed: bool = False) -> DataFrame:
    """Flagged transactions; a NULL flag is not an alert."""
    alerts = silver.filter("is_fraud").select(*schemas.names(schemas.ALERTS))
    return quality.observe(alerts, "gold", quality.GOLD_RULES) if observed else alerts


def alert_messages(silver: DataFrame) -> DataFrame:
    """Keyed JSON alerts: same account, same topic partition.  NULL fields are left out."""
    alerts = silver.filter("is_fraud").withColumn(
        "timestamp", F.col("event_timestamp").cast("string")
    )
    return alerts.select(
        F.col("account_id").alias("key"),
        F.to_json(F.struct(*MESSAGE_FIELDS)).alias("value"),
    )
