"""The same queries as SQL for an independent engine, over the same tables."""

from __future__ import annotations

# Messages, decoded messages, parsed payloads and flagged transactions, built from `events` alone.
LAYERS = """
facts AS (
  SELECT event_id, user_id, ts, event_type, value,
    CASE WHEN event_id % 33 = 0 THEN 'GB'
      ELSE ['US','US','US','US','CA','GB','AU','JP'][user_id % 8 + 1] END AS country,
    ['GROCERY','ELECTRONICS','RESTAURANT','GAS_STATION','TRAVEL','HEALTHCARE','ENTERTAINMENT',
     'RETAIL'][CAST(json_extract_string(props, '$.k') AS INTEGER) % 8 + 1] AS category
  FROM events
),
places(place, city, lat, lon) AS (
  VALUES ('US', 'Northport', '41.5123', '-73.2511'), ('CA', 'Lakeview', '45.1234', '-76.4321'),
    ('GB', 'Westbridge', '52.3111', '-1.1222'), ('AU', 'Southbay', '-34.2333', '150.5444'),
    ('JP', 'Eastfield', '36.4555', '138.9666')
),
shops(shop_category, shop) AS (
  VALUES ('GROCERY', 'Green Basket'), ('ELECTRONICS', 'Volt Corner'), ('RESTAURANT', 'Blue Spoon'),
    ('GAS_STATION', 'Red Pump'), ('TRAVEL', 'Far Lines'), ('HEALTHCARE', 'Well Chemist'),
    ('ENTERTAINMENT', 'Night Reel'), ('RETAIL', 'Main Store')
),
currencies(of_country, expected) AS (
  VALUES ('US', 'USD'), ('CA', 'CAD'), ('GB', 'GBP'), ('AU', 'AUD'), ('DE', 'EUR'), ('JP', 'JPY')
),
messages AS (
  SELECT event_id, user_id, ts,
    '{"transaction_id":"tx-' || event_id || '","account_id":"acc-' || user_id
    || '","card_number_masked":"4532-XXXX-XXXX-'
    || lpad(CAST(user_id % 10000 AS VARCHAR), 4, '0')
    || '","timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z"'
    || CASE WHEN event_id % 89 = 0 THEN ''
         ELSE ',"amount":' || CAST(CAST(round(value * 50, 2) AS DECIMAL(18,2)) AS VARCHAR) END
    || CASE WHEN event_id % 79 = 0 THEN '' ELSE ',"currency":"' ||
         CASE WHEN event_id % 73 = 0 THEN 'BRL' WHEN event_id % 33 = 0 THEN 'USD' ELSE expected END
         || '"' END
    || ',"transaction_type":"' || CASE event_type WHEN 'click' THEN 'POS_PURCHASE'
         WHEN 'view' THEN 'MOBILE_PAYMENT' WHEN 'purchase' THEN 'ONLINE_TRANSFER'
         WHEN 'signup' THEN 'DIRECT_DEPOSIT' WHEN 'error' THEN 'ATM_WITHDRAWAL' END
    || '","merchant":{"merchant_id":"m-' || (1000 + event_id % 9000) || '","name":"' || shop
    || '","category":"' || category || '"},"location":{"city":"' || city || '"'
    || CASE WHEN event_id % 83 = 0 THEN '' ELSE ',"country":"' ||
         CASE WHEN event_id % 73 = 0 THEN 'BR' ELSE country END || '"' END
    || ',"lat":' || lat || ',"lon":' || lon || '},"device_id":"dev-web-'
    || (10000 + user_id) || '"}' AS text
  FROM facts JOIN places ON place = country JOIN shops ON shop_category = category
    JOIN currencies ON of_country = country
),
bronze AS (
  SELECT 'acc-' || user_id AS kafka_key,
    CASE WHEN event_id % 97 = 0 THEN substr(text, 1, 40) ELSE text END AS raw_value,
    'banking.transactions' AS kafka_topic, CAST(user_id % 3 AS INTEGER) AS kafka_partition,
    event_id AS kafka_offset, ts AS kafka_timestamp,
    TIMESTAMP '2024-02-01 00:00:00' AS ingestion_timestamp, DATE '2024-02-01' AS ingestion_date
  FROM messages
),
parsed AS (
  SELECT *, CASE WHEN json_valid(raw_value) THEN CAST(raw_value AS JSON) END AS doc FROM bronze
),
typed AS (
  SELECT doc->>'$.transaction_id' AS transaction_id, doc->>'$.account_id' AS account_id,
    doc->>'$.card_number_masked' AS card_number_masked,
    strptime(doc->>'$.timestamp', '%Y-%m-%dT%H:%M:%S.%gZ') AS event_timestamp,
    CAST(doc->>'$.amount' AS DOUBLE) AS amount, doc->>'$.currency' AS currency,
    doc->>'$.transaction_type' AS transaction_type,
    doc->>'$.merchant.merchant_id' AS merchant_id, doc->>'$.merchant.name' AS merchant_name,
    doc->>'$.merchant.category' AS merchant_category, doc->>'$.location.city' AS city,
    doc->>'$.location.country' AS country, CAST(doc->>'$.location.lat' AS DOUBLE) AS latitude,
    CAST(doc->>'$.location.lon' AS DOUBLE) AS longitude, doc->>'$.device_id' AS device_id,
    kafka_partition, kafka_offset, kafka_timestamp, ingestion_timestamp,
    CASE WHEN doc IS NULL THEN raw_value END AS _rescued_data,
    kafka_key, raw_value, kafka_topic, ingestion_date
  FROM parsed
),
ruled AS (
  SELECT typed.*, expected,
    amount > 10000 AS is_high_amount,
    transaction_type = 'ATM_WITHDRAWAL' AND country <> 'US' AS is_international_atm,
    expected IS NOT NULL AND expected <> currency AS is_suspicious_currency,
    amount > 5000 AND transaction_type = 'ONLINE_TRANSFER' AS is_high_value_online
  FROM typed LEFT JOIN currencies ON of_country = country
),
flagged AS (
  SELECT *, CAST(event_timestamp AS DATE) AS transaction_date,
    CAST(hour(event_timestamp) AS INTEGER) AS transaction_hour,
    is_high_amount OR is_international_atm OR is_suspicious_currency OR is_high_value_online
      AS is_fraud,
    concat_ws(', ', CASE WHEN is_high_amount THEN 'HIGH_AMOUNT' END,
      CASE WHEN is_international_atm THEN 'INTERNATIONAL_ATM' END,
      CASE WHEN is_suspicious_currency THEN 'SUSPICIOUS_CURRENCY' END,
      CASE WHEN is_high_value_online THEN 'HIGH_VALUE_ONLINE' END) AS fraud_reasons
  FROM ruled
),
silver AS (SELECT * FROM flagged WHERE _rescued_data IS NULL),
gold AS (
  SELECT transaction_date, transaction_hour, merchant_category, country,
    CAST(count(*) AS BIGINT) AS total_transactions,
    round(sum(amount), 2) AS total_volume_usd,
    round(avg(amount), 2) AS avg_transaction_amount,
    CAST(sum(CASE WHEN is_fraud THEN 1 ELSE 0 END) AS BIGINT) AS fraud_transactions_count,
    round(sum(CASE WHEN is_fraud THEN amount ELSE 0.0 END), 2) AS fraud_volume_usd,
    round(CAST(sum(CASE WHEN is_fraud THEN 1 ELSE 0 END) AS DOUBLE) * 100.0 / count(*), 2)
      AS fraud_rate_pct
  FROM silver GROUP BY ALL
)
"""

BRONZE = """kafka_key, raw_value, kafka_topic, kafka_partition, kafka_offset, kafka_timestamp,
  ingestion_timestamp, ingestion_date"""
PARSED = """transaction_id, account_id, card_number_masked, event_timestamp, transaction_date,
  transaction_hour, amount, currency, transaction_type, merchant_id, merchant_name,
  merchant_category, city, country, latitude, longitude, device_id, kafka_partition, kafka_offset,
  kafka_timestamp, ingestion_timestamp, _rescued_data"""
FLAGS = """is_fraud, fraud_reasons, is_high_amount, is_international_atm, is_suspicious_currency,
  is_high_value_online"""
ALERTS = f"""transaction_id, account_id, card_number_masked, event_timestamp, amount, currency,
  transaction_type, merchant_name, merchant_category, city, country, {FLAGS}, ingestion_timestamp"""


def _with_layers(select: str) -> str:
    return f"WITH {LAYERS.strip()}\n{select.strip()}"


def _metrics(layer: str, source: str, rules: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{name}' AS rule, '{action}' AS action, "
        f"CAST(count(*) AS BIGINT) AS total, "
        f"CAST(count(*) - count(*) FILTER (WHERE {predicate}) AS BIGINT) AS violations "
        f"FROM {source}"
        for name, predicate, action in rules
    )


DQ_BRONZE = _metrics(
    "bronze",
    "bronze",
    [
        ("valid_payload", "raw_value IS NOT NULL", "warn"),
        ("valid_key", "kafka_key IS NOT NULL", "warn"),
        ("valid_timestamp", "kafka_timestamp IS NOT NULL", "warn"),
    ],
)
DQ_SILVER = _metrics(
    "silver",
    "flagged",
    [
        ("valid_transaction_id", "transaction_id IS NOT NULL", "warn"),
        ("valid_account_id", "account_id IS NOT NULL", "warn"),
        ("valid_amount", "amount IS NOT NULL AND amount > 0", "warn"),
        ("valid_timestamp", "event_timestamp IS NOT NULL", "warn"),
        ("parseable_json", "_rescued_data IS NULL", "drop"),
    ],
)
DQ_GOLD = _metrics(
    "gold",
    "(SELECT * FROM silver WHERE is_fraud) AS alerts",
    [("is_valid_fraud_flag", "is_fraud = TRUE", "warn")],
)

SILVER_ROWS = f"SELECT {PARSED}, {FLAGS} FROM silver"
ALERT_ROWS = f"SELECT {ALERTS} FROM silver WHERE is_fraud"

STATS = """
SELECT CAST(count(*) AS BIGINT) AS total,
  CAST(sum(CASE WHEN is_fraud THEN 1 ELSE 0 END) AS BIGINT) AS fraud_cnt,
  round(CAST(sum(CASE WHEN is_fraud THEN 1 ELSE 0 END) AS DOUBLE) * 100.0 / count(*), 2)
    AS fraud_pct,
  round(sum(amount), 2) AS total_vol_usd,
  round(sum(CASE WHEN is_fraud THEN amount ELSE 0.0 END), 2) AS fraud_vol_usd
FROM silver
"""

MESSAGE = """
SELECT account_id AS key,
  '{"transaction_id":"' || transaction_id || '","account_id":"' || account_id
  || '","card_number_masked":"' || card_number_masked || '","timestamp":"'
  || CAST(event_timestamp AS VARCHAR) || '"'
  || coalesce(',"amount":' || CAST(amount AS VARCHAR), '')
  || coalesce(',"currency":"' || currency || '"', '') || ',"transaction_type":"' || transaction_type
  || '","merchant_name":"' || merchant_name || '","merchant_category":"' || merchant_category
  || '","city":"' || city || '"' || coalesce(',"country":"' || country || '"', '')
  || ',"fraud_reasons":"'
  || fraud_reasons || '"}' AS value
FROM silver WHERE is_fraud
"""

HOPS = """
SELECT account_id, transaction_id, event_timestamp, country, previous_transaction_id,
  previous_timestamp, previous_country, round(gap, 3) AS gap_seconds,
  round(km, 3) AS distance_km,
  round(CASE WHEN gap > 0 THEN km / (gap / 3600) END, 2) AS speed_kmh
FROM (
  SELECT *, (epoch_us(event_timestamp) - epoch_us(previous_timestamp)) / 1e6 AS gap,
    2 * 6371.0 * asin(least(1.0, sqrt(
      pow(sin(radians(latitude - plat) / 2), 2)
      + cos(radians(plat)) * cos(radians(latitude)) * pow(sin(radians(longitude - plon) / 2), 2)
    ))) AS km
  FROM (
    SELECT *, lag(transaction_id) OVER w AS previous_transaction_id,
      lag(event_timestamp) OVER w AS previous_timestamp, lag(country) OVER w AS previous_country,
      lag(latitude) OVER w AS plat, lag(longitude) OVER w AS plon
    FROM silver
    WINDOW w AS (PARTITION BY account_id ORDER BY event_timestamp, transaction_id)
  )
)
WHERE country <> previous_country AND gap <= 3600
"""

TRAILING = """
SELECT account_id, transaction_id, event_timestamp, amount,
  CAST(count(*) OVER w AS BIGINT) AS txn_count,
  round(coalesce(sum(amount) OVER w, 0), 2) AS rolling_spend,
  CAST(coalesce(sum(CASE WHEN isnan(amount) OR abs(amount) >= 1e32 THEN 1 ELSE 0 END) OVER w, 0)
    AS BIGINT) AS unsummed
FROM silver
WINDOW w AS (PARTITION BY account_id ORDER BY event_timestamp
  RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)
"""


def _sliding(key: str, minutes: int, slide: int) -> str:
    """Windows aligned to multiples of the slide; every row is in `minutes / slide` of them."""
    step = slide * 60 * 1000000
    return f"""
SELECT window_start, window_start + INTERVAL {minutes} MINUTE AS window_end, {key},
  CAST(count(*) AS BIGINT) AS txn_count, round(sum(amount), 2) AS volume
FROM (
  SELECT {key}, amount, make_timestamp(
    (epoch_us(event_timestamp) // {step} - back) * {step}) AS window_start
  FROM silver, range({minutes // slide}) AS shifts(back)
)
GROUP BY ALL
"""


HOURLY = """
SELECT date_trunc('hour', event_timestamp) AS hour_start, account_id, merchant_category,
  CAST(count(*) AS BIGINT) AS txn_count, round(sum(amount), 2) AS spend,
  round(avg(amount), 2) AS avg_spend
FROM {rows} GROUP BY ALL
"""

# The watermark at the end of a stream: windows that end later are still open.
WATERMARK = "(SELECT max(event_timestamp) FROM silver) - INTERVAL 10 MINUTE"

def _quarter_end(quarters: int) -> str:
    return f"""(
  SELECT make_timestamp((epoch_us(min(ts))
    + {quarters} * ((epoch_us(max(ts)) - epoch_us(min(ts))) // 4)) // 1000 * 1000) FROM events)"""


FIRST_QUARTER_END = _quarter_end(1)

PREVIEW = """transaction_id, account_id, amount, currency, transaction_type, merchant_name,
  merchant_category, city, country, is_fraud, fraud_reasons"""


def oracle_sql() -> dict[str, str]:
    batch = {
        "bronze_decode": f"SELECT {BRONZE} FROM bronze",
        "silver_parse": f"SELECT {PARSED} FROM flagged",
        "silver_parse_literal": f"""
            SELECT {PARSED.replace("_rescued_data", "CAST(NULL AS VARCHAR) AS _rescued_data")},
              {FLAGS} FROM flagged""",
        "silver_fraud_flags": SILVER_ROWS,
        "quarantine": f"SELECT {BRONZE}, _rescued_data FROM typed WHERE _rescued_data IS NOT NULL",
        "dq_bronze": DQ_BRONZE,
        "dq_silver": DQ_SILVER,
        "dq_gold": DQ_GOLD,
        "gold_merchant_analytics": "SELECT * FROM gold",
        "gold_fraud_alerts": ALERT_ROWS,
        "alert_payload": MESSAGE,
        "post_validation_counts": """
            SELECT 'bronze_transactions' AS table_name, CAST(count(*) AS BIGINT) AS row_count
            FROM bronze
            UNION ALL SELECT 'silver_transactions', CAST(count(*) AS BIGINT) FROM silver
            UNION ALL SELECT 'gold_merchant_analytics', CAST(count(*) AS BIGINT) FROM gold
            UNION ALL SELECT 'gold_fraud_alerts', CAST(count(*) AS BIGINT) FROM silver
            WHERE is_fraud""",
        "post_validation_stats": STATS,
        "post_validation_checks": f"""
            SELECT 'bronze_not_empty' AS check_name, count(*) > 0 AS passed,
              CAST(count(*) AS DOUBLE) AS value, CAST(0 AS DOUBLE) AS threshold FROM bronze
            UNION ALL SELECT 'silver_not_empty', count(*) > 0, CAST(count(*) AS DOUBLE),
              CAST(0 AS DOUBLE) FROM silver
            UNION ALL SELECT 'fraud_rate', coalesce(fraud_pct <= 50, FALSE), fraud_pct,
              CAST(50 AS DOUBLE) FROM ({STATS}) AS stats""",
        "bronze_summary": """
            SELECT CAST(count(*) AS BIGINT) AS total_rows,
              CAST(count(DISTINCT kafka_key) AS BIGINT) AS unique_accounts,
              min(kafka_timestamp) AS earliest_message, max(kafka_timestamp) AS latest_message,
              CAST(sum(CASE WHEN raw_value IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_payloads
            FROM bronze""",
        "bronze_summary_sketches": """
            SELECT CAST(count(*) AS BIGINT) AS total_rows,
              CAST(count(DISTINCT kafka_key) AS BIGINT) AS unique_accounts,
              min(kafka_timestamp) AS earliest_message, max(kafka_timestamp) AS latest_message,
              CAST(sum(CASE WHEN raw_value IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_payloads
            FROM bronze""",
        "bronze_preview": f"""
            SELECT {BRONZE} FROM bronze
            ORDER BY kafka_topic, kafka_partition, kafka_offset LIMIT 10""",
        "silver_preview": f"SELECT {PREVIEW} FROM silver ORDER BY transaction_id LIMIT 20",
        "fraud_summary": """
            SELECT CAST(count(*) AS BIGINT) AS total_transactions,
              CAST(sum(CASE WHEN is_fraud THEN 1 ELSE 0 END) AS BIGINT) AS fraud_count,
              round(CAST(sum(CASE WHEN is_fraud THEN 1 ELSE 0 END) AS DOUBLE) * 100.0 / count(*),
                2) AS fraud_pct,
              CAST(count(*) FILTER (WHERE is_high_amount) AS BIGINT) AS high_amount_count,
              CAST(count(*) FILTER (WHERE is_international_atm) AS BIGINT) AS intl_atm_count,
              CAST(count(*) FILTER (WHERE is_suspicious_currency) AS BIGINT)
                AS suspicious_currency_count,
              CAST(count(*) FILTER (WHERE is_high_value_online) AS BIGINT)
                AS high_value_online_count
            FROM silver""",
        "top_flagged": """
            SELECT transaction_id, account_id, amount, currency, transaction_type, city, country,
              fraud_reasons
            FROM silver WHERE is_fraud ORDER BY amount DESC NULLS LAST, transaction_id LIMIT 20""",
        "gold_by_volume": "SELECT * FROM gold ORDER BY total_volume_usd DESC NULLS LAST",
        "recent_alerts": """
            SELECT transaction_id, account_id, amount, currency, merchant_name, city, country,
              fraud_reasons, event_timestamp
            FROM silver WHERE is_fraud
            ORDER BY event_timestamp DESC NULLS LAST, transaction_id LIMIT 25""",
        "run_summary": f"""
            SELECT total AS silver_rows, fraud_cnt, total_vol_usd, fraud_vol_usd, fraud_pct,
              (SELECT CAST(count(*) AS BIGINT) FROM bronze) AS bronze_rows,
              (SELECT CAST(count(*) AS BIGINT) FROM typed WHERE _rescued_data IS NOT NULL)
                AS quarantine_rows,
              (SELECT CAST(count(*) AS BIGINT) FROM gold) AS gold_rows,
              (SELECT CAST(count(*) AS BIGINT) FROM silver WHERE is_fraud) AS alert_rows
            FROM ({STATS}) AS stats""",
        "layout_bronze": f"SELECT {BRONZE} FROM bronze",
        "layout_silver": SILVER_ROWS,
        "layout_alerts": ALERT_ROWS,
        "geo_hop": HOPS,
        "velocity_spike": f"""
            SELECT account_id, transaction_id, event_timestamp, amount, txn_count
            FROM ({TRAILING}) AS counted WHERE txn_count >= 3""",
        "rolling_account_spend": TRAILING,
        "sliding_category_volume": _sliding("merchant_category", 5, 1),
        "hourly_account_spend": HOURLY.format(rows="silver"),
        "hourly_spend_by_account": HOURLY.format(rows="silver").replace(
            "account_id, merchant_category", "account_id"),
        "hourly_spend_by_category": HOURLY.format(rows="silver").replace(
            "account_id, merchant_category", "merchant_category"),
        "currency_rule_join": """
            SELECT transaction_id, country, currency, expected AS expected_currency,
              is_suspicious_currency FROM silver""",
    }
    streams = {
        "stream_bronze": batch["bronze_decode"],
        "stream_silver": batch["silver_fraud_flags"],
        "stream_quarantine": batch["quarantine"],
        "stream_fraud_alerts": batch["gold_fraud_alerts"],
        "stream_alert_sink": batch["alert_payload"],
        "stream_gold_merchant": batch["gold_merchant_analytics"],
        "stream_dq": f"{DQ_BRONZE} UNION ALL {DQ_SILVER}",
        "stream_restart": batch["silver_fraud_flags"],
        "stream_currency_join": batch["currency_rule_join"],
        "stream_geo_hop": batch["geo_hop"],
        "stream_sliding_volume": f"""
            SELECT * FROM ({_sliding("merchant_category", 5, 1)}) AS windows
            WHERE window_end <= {WATERMARK}""",
        "stream_velocity": f"""
            SELECT * FROM ({_sliding("account_id", 60, 10)}) AS windows
            WHERE txn_count >= 3 AND window_end <= {WATERMARK}""",
        "stream_late_data": f"""
            SELECT * FROM ({HOURLY.format(rows=f'''(
              SELECT * FROM silver
              WHERE NOT coalesce(
                country = 'JP' AND event_timestamp < {FIRST_QUARTER_END}, FALSE)
            ) AS in_time''')}) AS hours
            WHERE hour_start + INTERVAL 1 HOUR <= {WATERMARK}""",
        "stream_late_rows": f"""
            SELECT transaction_id, account_id, event_timestamp,
              round((epoch_us(watermark) - epoch_us(event_timestamp)) / 1e6, 3) AS delay_seconds
            FROM silver, (
              SELECT max(event_timestamp) - INTERVAL 10 MINUTE AS watermark FROM silver
              WHERE event_timestamp < {_quarter_end(3)}
                AND NOT coalesce(
                  country = 'JP' AND event_timestamp < {FIRST_QUARTER_END}, FALSE)) AS before
            WHERE country = 'JP' AND event_timestamp < {FIRST_QUARTER_END}
              AND date_trunc('hour', event_timestamp) + INTERVAL 1 HOUR <= watermark""",
    }
    return {name: _with_layers(select) for name, select in {**batch, **streams}.items()}
