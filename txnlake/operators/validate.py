"""Checks after a run, as rows, and the step that fails a run on them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from txnlake.operators.gold import fraud_totals

# Fixed value: highest fraud rate that passes.
MAX_FRAUD_PCT = 50.0


class ValidationError(RuntimeError):
    """A check after the run failed."""


def ensure_namespace(spark: SparkSession, name: str) -> bool:
    """Create the database if it is missing; true when it can be used."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")
    return spark.catalog.databaseExists(name)


def table_counts(**tables: DataFrame) -> DataFrame:
    """One row per table: `table_name, row_count`."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def fraud_stats(silver: DataFrame) -> DataFrame:
    """One row of totals; NULL, not an error, where there are no rows."""
    return fraud_totals(
        silver, "total", "fraud_cnt", "total_vol_usd", "fraud_vol_usd", "fraud_pct"
    )


def checks(
    bronze: DataFrame, silver: DataFrame, max_fraud_pct: float = MAX_FRAUD_PCT
) -> DataFrame:
    """One row per check: `check_name, passed, value, threshold`.

    A fraud rate that cannot be computed does not pass.
    """

    def check(name, value, threshold, passed):
        return F.struct(
            F.lit(name).alias("check_name"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
            F.col(value).alias("value"),
            F.lit(float(threshold)).alias("threshold"),
        )

    def not_empty(layer, count):
        return check(f"{layer}_not_empty", count, 0, F.col(count) > 0)

    rate = check("fraud_rate", "fraud_pct", max_fraud_pct, F.col("fraud_pct") <= max_fraud_pct)
    bronze_rows = bronze.agg(F.count(F.lit(1)).cast("double").alias("rows"))
    silver_rows = fraud_stats(silver).withColumn("rows", F.col("total").cast("double"))
    return bronze_rows.select(F.inline(F.array(not_empty("bronze", "rows")))).unionByName(
        silver_rows.select(F.inline(F.array(not_empty("silver", "rows"), rate)))
    )


CHECK_SCHEMA = "check_name STRING, passed BOOLEAN, value DOUBLE, threshold DOUBLE"


def checks_of(summary: Row, max_fraud_pct: float = MAX_FRAUD_PCT) -> list[tuple]:
    """The rows of `checks`, from a run summary."""
    rate = summary.fraud_pct
    bronze, silver = summary.bronze_rows, summary.silver_rows
    return [
        ("bronze_not_empty", bronze > 0, float(bronze), 0.0),
        ("silver_not_empty", silver > 0, float(silver), 0.0),
        ("fraud_rate", rate is not None and rate <= max_fraud_pct, rate, float(max_fraud_pct)),
    ]


def run_summary(
    bronze: DataFrame,
    silver: DataFrame,
    quarantine: DataFrame,
    metrics: DataFrame,
    alerts: DataFrame,
) -> DataFrame:
    """One row: rows of every table, and volumes and fraud rate of silver."""
    counted = fraud_stats(silver).select(
        F.col("total").alias("silver_rows"),
        "fraud_cnt",
        "total_vol_usd",
        "fraud_vol_usd",
        "fraud_pct",
    )
    others = {
        "bronze_rows": bronze,
        "quarantine_rows": quarantine,
        "gold_rows": metrics,
        "alert_rows": alerts,
    }
    for name, df in others.items():
        counted = counted.withColumn(name, df.agg(F.count(F.lit(1))).scalar())
    return counted


def enforce(checked: list[tuple], result=None) -> None:
    """Raise on the checks that did not pass; the error carries `result`."""
    failed = [f"{name}: {value} against {limit}" for name, ok, value, limit in checked if not ok]
    if failed:
        error = ValidationError("; ".join(failed))
        error.result = result
        raise error
