"""The four row-local fraud rules as Column expressions.

A rule is three-valued: it is NULL where an input it needs is missing, and the combined flag
keeps SQL's OR (true OR NULL is true, false OR NULL is NULL).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import chain
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Thresholds, home country and the expected currency of each country.
HIGH_AMOUNT_ABOVE = 10000.0
HIGH_ONLINE_AMOUNT_ABOVE = 5000.0
HOME_COUNTRY = "US"
COUNTRY_CURRENCY = {
    "US": "USD",
    "CA": "CAD",
    "GB": "GBP",
    "AU": "AUD",
    "DE": "EUR",
    "JP": "JPY",
}


@dataclass(frozen=True)
class Rule:
    """A named fraud rule: `flag` is its boolean column, `reason` its text in `fraud_reasons`."""

    reason: str
    flag: str
    condition: Column


def expected_currency(country: Column, currencies: dict[str, str] | None = None) -> Column:
    """Currency of a country from a literal map; NULL where the country is unknown."""
    pairs = chain.from_iterable((currencies or COUNTRY_CURRENCY).items())
    return F.create_map(*[F.lit(text) for text in pairs])[country]


def differs_from_expected(expected: Column, currency: Column) -> Column:
    """False without an expectation, NULL where there is one but the currency is missing."""
    return F.when(expected.isNull(), F.lit(False)).otherwise(currency != expected)


def fraud_rules(
    high_amount: float = HIGH_AMOUNT_ABOVE,
    high_online_amount: float = HIGH_ONLINE_AMOUNT_ABOVE,
    home_country: str = HOME_COUNTRY,
    currencies: dict[str, str] | None = None,
) -> list[Rule]:
    """The rules in the order in which their reasons are listed."""
    amount, kind = F.col("amount"), F.col("transaction_type")
    country, currency = F.col("country"), F.col("currency")
    expected = expected_currency(country, currencies)
    return [
        Rule("HIGH_AMOUNT", "is_high_amount", amount > high_amount),
        Rule(
            "INTERNATIONAL_ATM",
            "is_international_atm",
            (kind == "ATM_WITHDRAWAL") & (country != home_country),
        ),
        Rule(
            "SUSPICIOUS_CURRENCY",
            "is_suspicious_currency",
            differs_from_expected(expected, currency),
        ),
        Rule(
            "HIGH_VALUE_ONLINE",
            "is_high_value_online",
            (kind == "ONLINE_TRANSFER") & (amount > high_online_amount),
        ),
    ]


def flag(transactions: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Add one boolean per rule, `is_fraud` and the comma-separated `fraud_reasons`."""
    rules = rules or fraud_rules()
    flagged = transactions.withColumns({rule.flag: rule.condition for rule in rules})
    reasons = [F.when(F.col(rule.flag), F.lit(rule.reason)) for rule in rules]
    return flagged.withColumns(
        {
            "is_fraud": reduce(or_, [F.col(rule.flag) for rule in rules]),
            "fraud_reasons": F.concat_ws(", ", *reasons),
        }
    )
