"""Physical plans: what reaches the scan, and how often rows are shuffled."""

import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from rows import messages, payload

from txnlake.operators import detect, gold, reports, silver, windows
from txnlake.operators.bronze import to_bronze
from txnlake.plans import lake
from txnlake.sources import events


def plan_of(df) -> str:
    """The plan as it ran, without the initial plan."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    parts = text.split("+- == Final")[1:]
    return "\n".join(part.split("+- == Initial Plan ==")[0] for part in parts)


def exchanges(plan: str) -> int:
    return len(re.findall(r"(?<!Reused)Exchange (?:hash|range|Single)", plan))


def test_no_shuffle_up_to_the_alerts(spark, sf_dir):
    bronze = lake.stored_bronze(spark, sf_dir)
    for df in (
        to_bronze(lake.raw(spark, sf_dir)),
        silver.to_silver(bronze, observed=True),
        silver.quarantine(bronze),
        gold.fraud_alerts(lake.stored_silver(spark, sf_dir)),
        gold.alert_messages(lake.stored_silver(spark, sf_dir)),
    ):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_alert_filter_reaches_the_scan(spark, sf_dir):
    plan = gold.fraud_alerts(lake.stored_silver(spark, sf_dir))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(is_fraud,true)" in text


def test_gold_reads_six_columns_and_shuffles_once(spark, sf_dir):
    df = gold.merchant_analytics(lake.stored_silver(spark, sf_dir))
    assert exchanges(plan_of(df)) == 1
    scans = df._jdf.queryExecution().optimizedPlan().toString()
    relation = [line for line in scans.splitlines() if "Project" in line][-1]  # at the scan
    for name in ("transaction_hour", "amount", "merchant_category", "country", "is_fraud"):
        assert name in relation
    for name in ("device_id", "account_id", "kafka_offset", "fraud_reasons"):
        assert name not in relation


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("detector", [detect.geo_hop, detect.rolling_account_spend])
def test_one_plan_with_and_without_a_hot_account(spark, sf_dir, detector, hot):
    """Window groups are stretches of an account; nothing is counted or broadcast first."""
    rows = lake.stored_silver(spark, sf_dir)
    if hot:
        third = F.pmod(F.xxhash64("transaction_id"), F.lit(3)) == 0
        rows = rows.withColumn("account_id", F.when(third, "hot").otherwise(F.col("account_id")))
    plan = plan_of(detector(rows))
    assert plan.count("Window [") == 1 and exchanges(plan) == 2
    assert "_stretch" in plan
    assert not any(word in plan for word in ("CartesianProduct", "NestedLoop", "Broadcast"))


def test_panes_are_added_before_they_are_copied(spark, sf_dir):
    plan = plan_of(windows.sliding_category_volume(lake.stored_silver(spark, sf_dir)))
    assert plan.index("Generate explode") < plan.rindex("Exchange hashpartitioning")
    assert "Expand" not in plan


@pytest.mark.parametrize("report", [reports.top_flagged, reports.silver_preview])
def test_top_k_does_not_sort_everything(spark, sf_dir, report):
    df = report(lake.stored_silver(spark, sf_dir))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_arrival_range_reaches_the_scan(spark, sf_dir):
    df = events.messages(spark, sf_dir, datetime(2024, 1, 5), datetime(2024, 1, 6))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in text and "LessThan(ts," in text


CURRENCY = {"US": "USD", "CA": "CAD", "GB": "GBP", "AU": "AUD", "DE": "EUR", "JP": "JPY"}


def either(flags):
    """Three-valued OR."""
    return True if True in flags else None if None in flags else False


def both(left, right):
    """Three-valued AND."""
    return False if False in (left, right) else None if None in (left, right) else True


def expected_flags(kind, amount, country, currency):
    expected = CURRENCY.get(country)
    mismatch = False if expected is None else None if currency is None else currency != expected
    online = None if kind is None else kind == "ONLINE_TRANSFER"
    atm = None if kind is None else kind == "ATM_WITHDRAWAL"
    flags = [
        None if amount is None else amount > 10000,
        both(atm, None if country is None else country != "US"),
        mismatch,
        both(None if amount is None else amount > 5000, online),
    ]
    names = ["HIGH_AMOUNT", "INTERNATIONAL_ATM", "SUSPICIOUS_CURRENCY", "HIGH_VALUE_ONLINE"]
    reasons = ", ".join(name for name, hit in zip(names, flags, strict=True) if hit)
    return (*flags, either(flags), reasons)


def test_flags_of_random_rows(spark):
    rng = random.Random(11)
    drawn = [
        (
            rng.choice(["ATM_WITHDRAWAL", "ONLINE_TRANSFER", "POS_PURCHASE", None]),
            rng.choice([0.01, 4999.99, 5000, 5000.01, 9999.99, 10000, 10000.01, 50000, None]),
            rng.choice([*CURRENCY, "FR", None]),
            rng.choice([*CURRENCY.values(), "CHF", None]),
        )
        for _ in range(400)
    ]
    texts = [payload(i, *row) for i, row in enumerate(drawn)]
    found = silver.to_silver(to_bronze(messages(spark, texts))).orderBy("kafka_offset")
    columns = [
        "is_high_amount", "is_international_atm", "is_suspicious_currency",
        "is_high_value_online", "is_fraud", "fraud_reasons",
    ]
    rows = [tuple(row[name] for name in columns) for row in found.collect()]
    assert rows == [expected_flags(*row) for row in drawn]
