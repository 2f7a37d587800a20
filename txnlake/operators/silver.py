"""Silver: typed, flat, flagged transactions; unreadable messages go to quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake import schemas
from txnlake.functions.rules import Rule, flag
from txnlake.operators import quality

RESCUED = "_rescued_data"
KEPT = "kept"
# What only a message that is not kept carries on, beside the columns that both have.
RAW_ONLY = [n for n in schemas.names(schemas.QUARANTINE) if n not in schemas.names(schemas.SILVER)]


def _with_payload(bronze: DataFrame, corrupt_policy: str) -> DataFrame:
    """Bronze columns plus the payload's fields and `_rescued_data`.

    `drop`: the text of a message that does not fit the schema lands in `_rescued_data`.
    `keep`: such a message becomes a row of NULLs, and `_rescued_data` is whatever the payload
    itself carries under that key.

    The generator keeps the parse in one place: a filter on a parsed field is not pushed below
    it, where the optimiser would parse every message a second time.
    """
    if corrupt_policy == "drop":
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RESCUED}
        payload = F.from_json("raw_value", f"{schemas.PAYLOAD}, {RESCUED} STRING", options)
        return bronze.select("*", F.inline(F.array(payload)))
    if corrupt_policy == "keep":
        payload = F.from_json("raw_value", schemas.PAYLOAD, {"mode": "PERMISSIVE"})
        rescued = F.get_json_object("raw_value", f"$.{RESCUED}")
        read = F.struct(payload.alias("payload"), rescued.alias(RESCUED))
        return bronze.select("*", F.inline(F.array(read))).select("*", "payload.*").drop("payload")
    raise ValueError(f"corrupt_policy must be 'drop' or 'keep', not {corrupt_policy!r}")


def parse(bronze: DataFrame, corrupt_policy: str = "drop", carried: tuple = ()) -> DataFrame:
    """Parse and flatten every message, readable or not, without fraud flags.

    `carried` are columns of bronze that go along.
    """
    event_time = F.try_to_timestamp(F.col("timestamp"))
    return _with_payload(bronze, corrupt_policy).select(
        "transaction_id",
        "account_id",
        "card_number_masked",
        event_time.alias("event_timestamp"),
        F.to_date(event_time).alias("transaction_date"),
        F.hour(event_time).alias("transaction_hour"),
        "amount",
        "currency",
        "transaction_type",
        "merchant.merchant_id",
        F.col("merchant.name").alias("merchant_name"),
        F.col("merchant.category").alias("merchant_category"),
        "location.city",
        "location.country",
        F.col("location.lat").alias("latitude"),
        F.col("location.lon").alias("longitude"),
        "device_id",
        "kafka_partition",
        "kafka_offset",
        "kafka_timestamp",
        "ingestion_timestamp",
        RESCUED,
        *carried,
    )


def flagged(
    bronze: DataFrame, corrupt_policy: str = "drop", rules: list[Rule] | None = None
) -> DataFrame:
    """Silver's columns for every message, before any row is dropped."""
    return flag(parse(bronze, corrupt_policy), rules).select(*schemas.names(schemas.SILVER))


def to_silver(
    bronze: DataFrame,
    corrupt_policy: str = "drop",
    rules: list[Rule] | None = None,
    observed: bool = False,
) -> DataFrame:
    """Silver rows; `observed` also counts rule violations as the metric `dq_silver`."""
    rows = flagged(bronze, corrupt_policy, rules)
    if observed:
        return quality.apply_expectations(rows, "silver", quality.SILVER_RULES)
    return quality.drop_failing(rows, quality.SILVER_RULES)


def split(
    bronze: DataFrame, corrupt_policy: str = "drop", rules: list[Rule] | None = None
) -> DataFrame:
    """Silver and quarantine in one pass: silver's columns, those of quarantine beside, and `kept`.

    Each message is parsed once.  The raw columns are NULL in rows that silver keeps.
    """
    rows = flag(parse(bronze, corrupt_policy, tuple(RAW_ONLY)), rules)
    kept = F.lit(True)
    for rule in quality.SILVER_RULES:
        if rule.action == "drop":
            kept = kept & rule.holds()
    rows = rows.withColumn(KEPT, kept)
    raw = [F.when(~F.col(KEPT), F.col(name)).alias(name) for name in RAW_ONLY]
    return rows.select(*schemas.names(schemas.SILVER), *raw, KEPT)


def quarantine(bronze: DataFrame, corrupt_policy: str = "drop") -> DataFrame:
    """The messages silver drops, unchanged, with the text that could not be read."""
    rejected = _with_payload(bronze, corrupt_policy).filter(F.col(RESCUED).isNotNull())
    return rejected.select(*schemas.names(schemas.QUARANTINE))
