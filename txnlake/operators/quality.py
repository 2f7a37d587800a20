"""Expectations: named rules that count violations and may drop the rows that fail."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expectation:
    """A boolean SQL predicate over a layer's output columns; `action` is `warn` or `drop`."""

    name: str
    predicate: str
    action: str = "warn"

    def __post_init__(self):
        if self.action not in ("warn", "drop"):
            raise ValueError(f"unknown action {self.action!r}")

    def holds(self) -> Column:
        """The predicate, with NULL counted as a violation."""
        return F.coalesce(F.expr(self.predicate), F.lit(False))

    def violations(self) -> Column:
        return F.count_if(~self.holds()).alias(self.name)


# Rule names, predicates and actions.
BRONZE_RULES = [
    Expectation("valid_payload", "raw_value IS NOT NULL"),
    Expectation("valid_key", "kafka_key IS NOT NULL"),
    Expectation("valid_timestamp", "kafka_timestamp IS NOT NULL"),
]
SILVER_RULES = [
    Expectation("valid_transaction_id", "transaction_id IS NOT NULL"),
    Expectation("valid_account_id", "account_id IS NOT NULL"),
    Expectation("valid_amount", "amount IS NOT NULL AND amount > 0"),
    Expectation("valid_timestamp", "event_timestamp IS NOT NULL"),
    Expectation("parseable_json", "_rescued_data IS NULL", "drop"),
]
GOLD_RULES = [Expectation("is_valid_fraud_flag", "is_fraud = TRUE")]


def counters(rules: list[Expectation]) -> list[Column]:
    """Aggregates: rows, and violations of each rule."""
    return [F.count(F.lit(1)).alias("total"), *[rule.violations() for rule in rules]]


def observe(df: DataFrame, layer: str, rules: list[Expectation]) -> DataFrame:
    """Count rows and violations while the rows pass through; read them as metric `dq_<layer>`."""
    return df.observe(f"dq_{layer}", *counters(rules))


def drop_failing(df: DataFrame, rules: list[Expectation]) -> DataFrame:
    """Remove the rows that fail a `drop` rule."""
    for rule in rules:
        if rule.action == "drop":
            df = df.filter(rule.holds())
    return df


def apply_expectations(df: DataFrame, layer: str, rules: list[Expectation]) -> DataFrame:
    """Count violations on every row, then drop what the rules say."""
    return drop_failing(observe(df, layer, rules), rules)


def metrics(df: DataFrame, layer: str, rules: list[Expectation]) -> DataFrame:
    """One row per rule: `layer, rule, action, total, violations`, from one aggregate."""
    counted = df.agg(*counters(rules))
    per_rule = F.array(
        *[
            F.struct(
                F.lit(rule.name).alias("rule"),
                F.lit(rule.action).alias("action"),
                F.col(rule.name).alias("violations"),
            )
            for rule in rules
        ]
    )
    return counted.select("total", F.inline(per_rule)).select(
        F.lit(layer).alias("layer"), "rule", "action", "total", "violations"
    )
