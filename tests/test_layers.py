"""Row fixtures through bronze, silver and gold."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from rows import FLAG_ROWS, flag_texts, messages, payload

from txnlake import schemas
from txnlake.functions.rules import fraud_rules
from txnlake.operators import gold, silver
from txnlake.operators.bronze import to_bronze

FLAGS = [
    "is_high_amount",
    "is_international_atm",
    "is_suspicious_currency",
    "is_high_value_online",
    "is_fraud",
    "fraud_reasons",
]
NORMAL = ("POS_PURCHASE", 42.5, "US", "USD")


def bronze_of(spark, texts, keys=None):
    return to_bronze(messages(spark, texts, keys), F.lit("2024-03-02 00:00:00").cast("timestamp"))


def rows_of(df):
    return [row.asDict() for row in df.orderBy("kafka_offset").collect()]


def test_layer_schemas(spark):
    bronze = bronze_of(spark, flag_texts())
    rows = silver.to_silver(bronze)
    expected = {
        schemas.BRONZE: bronze,
        schemas.SILVER: rows,
        schemas.ALERTS: gold.fraud_alerts(rows),
        schemas.GOLD: gold.merchant_analytics(rows),
        schemas.QUARANTINE: silver.quarantine(bronze),
        schemas.ALERT_MESSAGES: gold.alert_messages(rows),
    }
    for ddl, df in expected.items():
        declared = spark.createDataFrame([], ddl)
        assert df.dtypes == declared.dtypes


def test_bronze_decodes_and_stamps(spark):
    row = bronze_of(spark, ["text"], ["acc-9"]).first()
    assert (row.kafka_key, row.raw_value, row.kafka_offset) == ("acc-9", "text", 0)
    assert row.ingestion_date == date(2024, 3, 2)
    clock = to_bronze(messages(spark, ["text"])).first()
    assert clock.ingestion_timestamp.date() == clock.ingestion_date


def test_flags_of_every_row(spark):
    found = rows_of(silver.to_silver(bronze_of(spark, flag_texts())))
    assert [tuple(row[name] for name in FLAGS) for row in found] == [row[4:] for row in FLAG_ROWS]


def test_fields_are_typed_and_flat(spark):
    row = silver.to_silver(bronze_of(spark, [payload(7, *NORMAL)])).first()
    assert row.event_timestamp == datetime(2024, 3, 1, 10, 0, 1, 234000)
    assert (row.transaction_date, row.transaction_hour) == (date(2024, 3, 1), 10)
    assert (row.merchant_id, row.merchant_name, row.merchant_category) == (
        "m-1", "Shell", "GAS_STATION",
    )
    assert (row.city, row.country, row.latitude, row.longitude) == ("Somewhere", "US", 1.5, -2.5)


UNREADABLE = ['{"transaction_id":"tx-1","amo', "plain text", '[{"transaction_id":"tx-1"}]']
WRONG_TYPE = [payload(1, *NORMAL, amount="12.5"), payload(2, *NORMAL, amount="x")]


def test_unreadable_messages_go_to_quarantine(spark):
    bronze = bronze_of(spark, [*UNREADABLE, *WRONG_TYPE, payload(3, *NORMAL)])
    assert [row["transaction_id"] for row in rows_of(silver.to_silver(bronze))] == ["tx-003"]
    rejected = rows_of(silver.quarantine(bronze))
    assert [row["raw_value"] for row in rejected] == [*UNREADABLE, *WRONG_TYPE]
    assert all(row["_rescued_data"] == row["raw_value"] for row in rejected)


def test_keep_policy_leaves_unreadable_messages_in(spark):
    carries_key = payload(3, *NORMAL, _rescued_data="x")
    bronze = bronze_of(spark, [*UNREADABLE, *WRONG_TYPE, carries_key])
    kept = rows_of(silver.to_silver(bronze, corrupt_policy="keep"))
    assert [row["transaction_id"] for row in kept] == [None, None, None, "tx-001", "tx-002"]
    assert all(row["amount"] is None and row["_rescued_data"] is None for row in kept)
    rejected = rows_of(silver.quarantine(bronze, corrupt_policy="keep"))
    assert [row["_rescued_data"] for row in rejected] == ["x"]


def test_drop_policy_ignores_an_unknown_key(spark):
    bronze = bronze_of(spark, [payload(3, *NORMAL, _rescued_data="x")])
    row = silver.to_silver(bronze).first()
    assert (row.transaction_id, row._rescued_data) == ("tx-003", None)


def test_unknown_policy(spark):
    with pytest.raises(ValueError):
        silver.to_silver(bronze_of(spark, ["{}"]), corrupt_policy="other")


@pytest.mark.parametrize("policy", ["drop", "keep"])
@pytest.mark.parametrize("text", ["garbage", ""])
def test_bad_timestamp_is_null(spark, policy, text):
    bronze = bronze_of(spark, [payload(1, *NORMAL, timestamp=text)])
    row = silver.to_silver(bronze, corrupt_policy=policy).first()
    assert (row.transaction_id, row.event_timestamp, row.transaction_hour) == ("tx-001", None, None)


@pytest.mark.parametrize("policy", ["drop", "keep"])
def test_empty_payloads_and_missing_keys_stay(spark, policy):
    bronze = bronze_of(spark, [None, "", payload(2, *NORMAL)], ["acc-0", "acc-1", None])
    kept = rows_of(silver.to_silver(bronze, corrupt_policy=policy))
    assert [row["transaction_id"] for row in kept] == [None, None, "tx-002"]
    assert [row["is_fraud"] for row in kept] == [None, None, False]


def test_last_of_two_equal_keys_wins(spark):
    text = payload(1, *NORMAL)[:-1] + ', "currency": "EUR"}'
    assert silver.to_silver(bronze_of(spark, [text])).first().currency == "EUR"


def test_thresholds_are_parameters(spark):
    rules = fraud_rules(high_amount=10, high_online_amount=1, home_country="GB")
    found = rows_of(silver.to_silver(bronze_of(spark, flag_texts()[:4]), rules=rules))
    assert [row["is_high_amount"] for row in found] == [True] * 4
    assert found[3]["is_international_atm"] is False


@pytest.mark.parametrize("policy, readers", [("drop", 1), ("keep", 2)])
def test_one_parse_per_message(spark, tmp_path, policy, readers):
    path = str(tmp_path / "bronze")
    bronze_of(spark, flag_texts()).write.parquet(path)
    bronze = spark.read.schema(schemas.BRONZE).parquet(path)
    rows = silver.to_silver(bronze, policy).filter("is_fraud")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") + plan.count("get_json_object") == readers


def test_alerts_skip_null_flags(spark):
    rows = silver.to_silver(bronze_of(spark, flag_texts()))
    expected = [f"tx-{i:03d}" for i, row in enumerate(FLAG_ROWS) if row[8]]
    alerts = gold.fraud_alerts(rows).orderBy("transaction_id").collect()
    assert [row.transaction_id for row in alerts] == expected
    sent = gold.alert_messages(rows).collect()
    assert sorted(json.loads(row.value)["transaction_id"] for row in sent) == expected


def test_alert_message_fields(spark):
    rows = silver.to_silver(bronze_of(spark, [flag_texts()[8], flag_texts()[12]]))
    full, without_currency = gold.alert_messages(rows).orderBy("key").collect()[::-1]
    fields = json.loads(full.value)
    assert full.key == fields["account_id"] == "acc-8"
    assert list(fields) == gold.MESSAGE_FIELDS
    assert fields["timestamp"] == "2024-03-01 10:00:01.234"
    assert fields["fraud_reasons"] == "HIGH_AMOUNT, INTERNATIONAL_ATM, SUSPICIOUS_CURRENCY"
    assert "currency" not in json.loads(without_currency.value)


def test_gold_measures(spark):
    rows = silver.to_silver(bronze_of(spark, flag_texts()))
    groups = {row.country: row for row in gold.merchant_analytics(rows).collect()}
    assert groups["GB"].total_transactions == 2
    assert groups["GB"].total_volume_usd == 12200.0
    assert groups["GB"].avg_transaction_amount == 6100.0
    assert groups["GB"].fraud_rate_pct == 100.0
    # A NULL country is a group; its NULL flags are not fraud.
    assert groups[None].total_transactions == 2
    assert (groups[None].fraud_transactions_count, groups[None].fraud_volume_usd) == (0, 0.0)
    us = [row for row in FLAG_ROWS if row[2] == "US"]
    assert groups["US"].total_transactions == len(us)
    assert groups["US"].fraud_transactions_count == sum(1 for row in us if row[8])
    assert groups["US"].fraud_volume_usd == round(sum(row[1] for row in us if row[8]), 2)


def test_flag_and_reasons_agree(spark, sf_dir):
    from txnlake.plans import lake

    rows = lake.stored_silver(spark, sf_dir)
    assert rows.filter("coalesce(is_fraud, false) <> (fraud_reasons <> '')").count() == 0
    bronze = lake.stored_bronze(spark, sf_dir)
    assert rows.count() + silver.quarantine(bronze).count() == bronze.count()
    total = gold.merchant_analytics(rows).agg(F.sum("total_transactions")).first()[0]
    assert total == rows.count()
