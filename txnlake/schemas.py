"""Schemas and column orders of every layer, as DDL text."""

# Field names, types and order of the payment message.
PAYLOAD = """
    transaction_id STRING, account_id STRING, card_number_masked STRING, `timestamp` STRING,
    amount DOUBLE, currency STRING, transaction_type STRING,
    merchant STRUCT<merchant_id: STRING, name: STRING, category: STRING>,
    location STRUCT<city: STRING, country: STRING, lat: DOUBLE, lon: DOUBLE>,
    device_id STRING
"""

# The columns Spark's Kafka source produces, in its order.
KAFKA = """
    key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT,
    timestamp TIMESTAMP, timestampType INT
"""

BRONZE = """
    kafka_key STRING, raw_value STRING, kafka_topic STRING, kafka_partition INT,
    kafka_offset BIGINT, kafka_timestamp TIMESTAMP, ingestion_timestamp TIMESTAMP,
    ingestion_date DATE
"""

SILVER = """
    transaction_id STRING, account_id STRING, card_number_masked STRING,
    event_timestamp TIMESTAMP, transaction_date DATE, transaction_hour INT,
    amount DOUBLE, currency STRING, transaction_type STRING,
    merchant_id STRING, merchant_name STRING, merchant_category STRING,
    city STRING, country STRING, latitude DOUBLE, longitude DOUBLE, device_id STRING,
    is_fraud BOOLEAN, fraud_reasons STRING, is_high_amount BOOLEAN,
    is_international_atm BOOLEAN, is_suspicious_currency BOOLEAN, is_high_value_online BOOLEAN,
    kafka_partition INT, kafka_offset BIGINT, kafka_timestamp TIMESTAMP,
    ingestion_timestamp TIMESTAMP, _rescued_data STRING
"""

ALERTS = """
    transaction_id STRING, account_id STRING, card_number_masked STRING,
    event_timestamp TIMESTAMP, amount DOUBLE, currency STRING, transaction_type STRING,
    merchant_name STRING, merchant_category STRING, city STRING, country STRING,
    is_fraud BOOLEAN, fraud_reasons STRING, is_high_amount BOOLEAN,
    is_international_atm BOOLEAN, is_suspicious_currency BOOLEAN, is_high_value_online BOOLEAN,
    ingestion_timestamp TIMESTAMP
"""

GOLD = """
    transaction_date DATE, transaction_hour INT, merchant_category STRING, country STRING,
    total_transactions BIGINT, total_volume_usd DOUBLE, avg_transaction_amount DOUBLE,
    fraud_transactions_count BIGINT, fraud_volume_usd DOUBLE, fraud_rate_pct DOUBLE
"""

ALERT_MESSAGES = "key STRING, value STRING"

QUARANTINE = BRONZE + ", _rescued_data STRING"


def names(ddl: str) -> list[str]:
    """Column names of a flat DDL string, in order."""
    return [field.split()[0].strip("`") for field in ddl.split(",")]
