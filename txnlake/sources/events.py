"""Payment messages derived from the `events` test table, in the shape of Kafka's source."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.functions.rules import COUNTRY_CURRENCY

# Fixed values of the derivation: kinds by event type, countries by user, an invented merchant for
# each category and an invented city for each country.
TYPE_OF_EVENT = {
    "click": "POS_PURCHASE",
    "view": "MOBILE_PAYMENT",
    "purchase": "ONLINE_TRANSFER",
    "signup": "DIRECT_DEPOSIT",
    "error": "ATM_WITHDRAWAL",
}
COUNTRY_OF_USER = ["US", "US", "US", "US", "CA", "GB", "AU", "JP"]
MERCHANT_OF_CATEGORY = {
    "GROCERY": "Green Basket",
    "ELECTRONICS": "Volt Corner",
    "RESTAURANT": "Blue Spoon",
    "GAS_STATION": "Red Pump",
    "TRAVEL": "Far Lines",
    "HEALTHCARE": "Well Chemist",
    "ENTERTAINMENT": "Night Reel",
    "RETAIL": "Main Store",
}
CITY_OF_COUNTRY = {
    "US": ("Northport", "41.5123", "-73.2511"),
    "CA": ("Lakeview", "45.1234", "-76.4321"),
    "GB": ("Westbridge", "52.3111", "-1.1222"),
    "AU": ("Southbay", "-34.2333", "150.5444"),
    "JP": ("Eastfield", "36.4555", "138.9666"),
}
FOREIGN_EVERY = 33
# Fields that some messages lack, and a country that no rule knows.
NO_AMOUNT_EVERY = 89
NO_COUNTRY_EVERY = 83
NO_CURRENCY_EVERY = 79
UNKNOWN_EVERY = 73
UNKNOWN_COUNTRY, UNKNOWN_CURRENCY = "BR", "BRL"
MALFORMED_EVERY = 97
MALFORMED_LENGTH = 40
TOPIC = "banking.transactions"
PARTITIONS = 3


def _lookup(values: dict, key: Column) -> Column:
    pairs = [F.lit(item) for pair in values.items() for item in pair]
    return F.create_map(*pairs)[key]


def _nth(values: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(value) for value in values]), index.cast("int"))


def extent(spark: SparkSession, sf_dir: str) -> tuple[int, datetime, datetime]:
    """Number of events, first and last event time."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return tuple(events.agg(F.count(F.lit(1)), F.min("ts"), F.max("ts")).first())


def messages(
    spark: SparkSession,
    sf_dir: str,
    since: datetime | None = None,
    until: datetime | None = None,
    untimed: bool = True,
) -> DataFrame:
    """Events as keyed JSON messages; some texts are cut short and so do not parse, some lack a field.

    `since` and `until` (exclusive) select what arrives in one go; they reach the Parquet scan.
    Events without a time are there with `untimed`.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    chosen = F.lit(True)
    if since is not None:
        chosen = chosen & (F.col("ts") >= F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        chosen = chosen & (F.col("ts") < F.lit(until).cast("timestamp_ntz"))
    if since is not None or until is not None:
        no_time = F.col("ts").isNull()
        events = events.filter(chosen | no_time if untimed else chosen & ~no_time)
    event_id, user_id = F.col("event_id"), F.col("user_id")
    foreign = event_id % FOREIGN_EVERY == 0
    home = _nth(COUNTRY_OF_USER, user_id % len(COUNTRY_OF_USER))
    slot = F.get_json_object("props", "$.k").cast("int") % len(MERCHANT_OF_CATEGORY)
    places = {name: F.col("country") for name in ("city", "lat", "lon")}
    for position, name in enumerate(places):
        places[name] = _lookup(
            {country: place[position] for country, place in CITY_OF_COUNTRY.items()},
            F.col("country"),
        )
    facts = events.withColumns(
        {
            "sent_at": F.col("ts").cast("timestamp"),
            "country": F.when(foreign, "GB").otherwise(home),
            "category": _nth(list(MERCHANT_OF_CATEGORY), slot),
        }
    )

    def every(n: int) -> Column:
        return event_id % n == 0

    unknown = every(UNKNOWN_EVERY)
    amount = F.round(F.col("value") * 50, 2).cast("decimal(18,2)")
    currency = (
        F.when(unknown, UNKNOWN_CURRENCY)
        .when(foreign, "USD")
        .otherwise(_lookup(COUNTRY_CURRENCY, F.col("country")))
    )
    country = F.when(unknown, UNKNOWN_COUNTRY).otherwise(F.col("country"))
    payload = F.struct(
        F.concat(F.lit("tx-"), event_id.cast("string")).alias("transaction_id"),
        F.concat(F.lit("acc-"), user_id.cast("string")).alias("account_id"),
        F.concat(
            F.lit("4532-XXXX-XXXX-"), F.lpad((user_id % 10000).cast("string"), 4, "0")
        ).alias("card_number_masked"),
        F.date_format("sent_at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"),
        F.when(~every(NO_AMOUNT_EVERY), amount).alias("amount"),
        F.when(~every(NO_CURRENCY_EVERY), currency).alias("currency"),
        _lookup(TYPE_OF_EVENT, F.col("event_type")).alias("transaction_type"),
        F.struct(
            F.concat(F.lit("m-"), (event_id % 9000 + 1000).cast("string")).alias("merchant_id"),
            _lookup(MERCHANT_OF_CATEGORY, F.col("category")).alias("name"),
            F.col("category"),
        ).alias("merchant"),
        F.struct(
            places["city"].alias("city"),
            F.when(~every(NO_COUNTRY_EVERY), country).alias("country"),
            places["lat"].cast("decimal(9,4)").alias("lat"),
            places["lon"].cast("decimal(9,4)").alias("lon"),
        ).alias("location"),
        F.concat(F.lit("dev-web-"), (user_id + 10000).cast("string")).alias("device_id"),
    )
    text = F.to_json(payload)
    cut = F.substring(text, 1, MALFORMED_LENGTH)
    return facts.select(
        F.concat(F.lit("acc-"), user_id.cast("string")).cast("binary").alias("key"),
        F.when(event_id % MALFORMED_EVERY == 0, cut).otherwise(text).cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        (user_id % PARTITIONS).cast("int").alias("partition"),
        event_id.alias("offset"),
        F.col("sent_at").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
