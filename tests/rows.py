"""Hand-written payments with the flags they must get, and messages that do not parse."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from txnlake import schemas

T, F, N = True, False, None

# type, amount, country, currency -> high, atm, currency, online, is_fraud, reasons
FLAG_ROWS = [
    ("POS_PURCHASE", 42.5, "US", "USD", F, F, F, F, F, ""),
    ("WIRE_TRANSFER", 10000.00, "US", "USD", F, F, F, F, F, ""),
    ("WIRE_TRANSFER", 10000.01, "US", "USD", T, F, F, F, T, "HIGH_AMOUNT"),
    ("ATM_WITHDRAWAL", 200, "GB", "GBP", F, T, F, F, T, "INTERNATIONAL_ATM"),
    ("POS_PURCHASE", 300, "JP", "USD", F, F, T, F, T, "SUSPICIOUS_CURRENCY"),
    ("ONLINE_TRANSFER", 5000.01, "US", "USD", F, F, F, T, T, "HIGH_VALUE_ONLINE"),
    ("ONLINE_TRANSFER", 5000.00, "US", "USD", F, F, F, F, F, ""),
    ("ONLINE_TRANSFER", 15000, "US", "USD", T, F, F, T, T, "HIGH_AMOUNT, HIGH_VALUE_ONLINE"),
    ("ATM_WITHDRAWAL", 12000, "GB", "USD", T, T, T, F, T,
     "HIGH_AMOUNT, INTERNATIONAL_ATM, SUSPICIOUS_CURRENCY"),
    ("POS_PURCHASE", 50, "FR", "EUR", F, F, F, F, F, ""),
    ("POS_PURCHASE", None, "US", "USD", N, F, F, F, N, ""),
    ("POS_PURCHASE", 50, "US", None, F, F, N, F, N, ""),
    ("POS_PURCHASE", 20000, "US", None, T, F, N, F, T, "HIGH_AMOUNT"),
    ("ATM_WITHDRAWAL", 50, None, "USD", F, N, F, F, N, ""),
    ("POS_PURCHASE", -5, "US", "USD", F, F, F, F, F, ""),
    # No type, country or currency at all, as in a hand-typed smoke message.
    (None, 100, None, None, F, N, F, F, N, ""),
]


def payload(number: int, kind, amount, country, currency, /, **changes) -> str:
    """A message text; None leaves the field out."""
    document = {
        "transaction_id": f"tx-{number:03d}",
        "account_id": f"acc-{number}",
        "card_number_masked": "4532-XXXX-XXXX-0001",
        "timestamp": "2024-03-01T10:00:01.234Z",
        "amount": amount,
        "currency": currency,
        "transaction_type": kind,
        "merchant": {"merchant_id": "m-1", "name": "Shell", "category": "GAS_STATION"},
        "location": {"city": "Somewhere", "country": country, "lat": 1.5, "lon": -2.5},
        "device_id": "dev-web-1",
    }
    document.update(changes)
    document["location"] = {k: v for k, v in document["location"].items() if v is not None}
    return json.dumps({k: v for k, v in document.items() if v is not None})


def flag_texts() -> list[str]:
    return [payload(i, *row[:4]) for i, row in enumerate(FLAG_ROWS)]


SENT = datetime(2024, 3, 1, 10, 0, 2, tzinfo=timezone.utc)


def messages(spark: SparkSession, texts: list[str | None], keys: list | None = None) -> DataFrame:
    """Kafka-shaped rows of the given texts."""
    keys = keys or [f"acc-{i}" for i in range(len(texts))]
    rows = [
        (
            None if key is None else bytearray(key, "utf8"),
            None if text is None else bytearray(text, "utf8"),
            "banking.transactions",
            0,
            offset,
            SENT,
            0,
        )
        for offset, (key, text) in enumerate(zip(keys, texts, strict=True))
    ]
    return spark.createDataFrame(rows, schemas.KAFKA)
