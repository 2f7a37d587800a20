"""Expectations and the checks after a run."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from rows import flag_texts, messages

from txnlake import schemas
from txnlake.operators import gold, quality, reports, silver, validate
from txnlake.operators.bronze import to_bronze
from txnlake.operators.quality import Expectation


def numbers(spark):
    return spark.createDataFrame([(1,), (2,), (None,), (-1,)], "x INT")


RULES = [Expectation("positive", "x > 0"), Expectation("present", "x IS NOT NULL", "drop")]


def test_metrics_count_null_as_violation(spark):
    found = quality.metrics(numbers(spark), "numbers", RULES).collect()
    assert [tuple(row) for row in found] == [
        ("numbers", "positive", "warn", 4, 2),
        ("numbers", "present", "drop", 4, 1),
    ]


def test_only_drop_rules_remove_rows(spark):
    kept = quality.apply_expectations(numbers(spark), "numbers", RULES)
    assert sorted(row.x for row in kept.collect()) == [-1, 1, 2]


def test_rows_are_counted_before_they_are_dropped(spark):
    seen = Observation("dq_numbers")
    counters = [F.count(F.lit(1)).alias("total"), *[rule.violations() for rule in RULES]]
    quality.drop_failing(numbers(spark).observe(seen, *counters), RULES).collect()
    assert seen.get == {"total": 4, "positive": 2, "present": 1}


def test_unknown_action():
    with pytest.raises(ValueError):
        Expectation("x", "true", "fix")


def test_rules_of_all_layers(spark):
    texts = [*flag_texts(), "broken", None]
    keys = [*[f"acc-{i}" for i in range(len(texts) - 1)], None]
    bronze = to_bronze(messages(spark, texts, keys))

    def violations(df, layer, rules):
        found = quality.metrics(df, layer, rules).collect()
        return {row.rule: (row.total, row.violations) for row in found}

    assert violations(bronze, "bronze", quality.BRONZE_RULES) == {
        "valid_payload": (18, 1),
        "valid_key": (18, 1),
        "valid_timestamp": (18, 0),
    }
    assert violations(silver.flagged(bronze), "silver", quality.SILVER_RULES) == {
        "valid_transaction_id": (18, 2),
        "valid_account_id": (18, 2),
        "valid_amount": (18, 4),
        "valid_timestamp": (18, 2),
        "parseable_json": (18, 1),
    }
    alerts = gold.fraud_alerts(silver.to_silver(bronze))
    assert violations(alerts, "gold", quality.GOLD_RULES) == {"is_valid_fraud_flag": (7, 0)}


def test_checks_pass_and_fail(spark):
    bronze = to_bronze(messages(spark, flag_texts()))
    rows = silver.to_silver(bronze)
    checked = {row.check_name: row for row in validate.checks(bronze, rows).collect()}
    assert all(row.passed for row in checked.values())
    assert checked["fraud_rate"].value == 43.75
    validate.enforce(validate.checks(bronze, rows).collect())
    with pytest.raises(validate.ValidationError, match="fraud_rate: 43.75 against 40.0"):
        validate.enforce(validate.checks(bronze, rows, max_fraud_pct=40).collect())


def test_checks_on_no_rows(spark):
    bronze = spark.createDataFrame([], schemas.BRONZE)
    rows = spark.createDataFrame([], schemas.SILVER)
    found = {row.check_name: row for row in validate.checks(bronze, rows).collect()}
    assert not any(row.passed for row in found.values())
    assert found["fraud_rate"].value is None
    stats = validate.fraud_stats(rows).first()
    assert (stats.total, stats.total_vol_usd, stats.fraud_pct) == (0, None, None)
    with pytest.raises(validate.ValidationError):
        validate.enforce(validate.checks(bronze, rows).collect())


def test_bronze_summary(spark):
    texts = [*flag_texts(), None]
    keys = [*[f"acc-{i % 3}" for i in range(len(texts) - 1)], None]
    bronze = to_bronze(messages(spark, texts, keys))
    for approximate in (False, True):
        row = reports.bronze_summary(bronze, approximate).first()
        assert (row.total_rows, row.unique_accounts, row.null_payloads) == (17, 3, 1)


def test_bronze_summary_from_sketches(spark):
    rows = spark.range(60_000).selectExpr(
        "CASE WHEN id % 10 > 0 THEN concat('acc-', id % 25013) END AS kafka_key",
        "CASE WHEN id % 7 > 0 THEN 'x' END AS raw_value",
        "CASE WHEN id % 11 > 0 THEN timestamp_seconds(1704067200 + id * 13) END AS kafka_timestamp",
    )
    sketches = reports.bronze_sketches(rows)
    assert sketches.count() == 11  # ten dates and the rows without one
    halves = [reports.bronze_sketches(rows.filter(f"hash(kafka_timestamp) % 2 {x} 0")) for x in ("=", "<>")]
    for stored in (sketches, halves[0].unionByName(halves[1])):
        found = reports.summary_of_sketches(stored).first().asDict()
        exact = reports.bronze_summary(rows).first().asDict()
        assert abs(found["unique_accounts"] / exact["unique_accounts"] - 1) < 0.02
        assert {**found, "unique_accounts": 0} == {**exact, "unique_accounts": 0}
    assert reports.summary_of_sketches(sketches.limit(0)).first().total_rows == 0
    assert reports.bronze_summary(rows.limit(0)).first().total_rows == 0


def test_namespace(spark):
    assert validate.ensure_namespace(spark, "txnlake_namespace_test")
    assert validate.ensure_namespace(spark, "txnlake_namespace_test")
