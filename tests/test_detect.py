"""Detection against plain Python, with a hot account."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from txnlake import schemas
from txnlake.operators import detect, timeline, windows

START = datetime(2024, 3, 1, 10, 0, 0)
PLACES = {"US": (40.7128, -74.006), "JP": (35.6762, 139.6503), "GB": (51.5074, -0.1278)}
COLUMNS = (
    "account_id STRING, transaction_id STRING, event_timestamp TIMESTAMP, amount DOUBLE, "
    "country STRING, latitude DOUBLE, longitude DOUBLE, currency STRING, merchant_category STRING"
)


def visits(spark, rows):
    """Rows of (account, id, seconds after start, amount, country)."""
    filled = [
        (a, i, None if s is None else START + timedelta(seconds=s), amount, c,
         *(PLACES.get(c) or (None, None)), "USD", "RETAIL" if s is None or int(s) % 2 else "TRAVEL")
        for a, i, s, amount, c in rows
    ]
    return spark.createDataFrame(filled, COLUMNS)


def skewed(count=600, accounts=12, seed=5):
    """Half of the rows belong to one account; many share an instant."""
    rng = random.Random(seed)
    rows = []
    for number in range(count):
        account = "hot" if rng.random() < 0.5 else f"acc-{rng.randrange(accounts)}"
        second = rng.randrange(0, 20000, 5) if rng.random() < 0.7 else rng.randrange(0, 600)
        rows.append((account, f"tx-{number:05d}", second, round(rng.uniform(1, 500), 2),
                     rng.choice(list(PLACES))))
    return rows


SPANS = [1, 60, 900, 3600, 100_000]


def python_trailing(rows, seconds):
    found = {}
    for account, number, at, _, _ in rows:
        span = [r for r in rows if r[0] == account and at - seconds <= r[2] <= at]
        found[number] = (len(span), round(math.fsum(r[3] for r in span), 2))
    return found


@pytest.mark.parametrize("seconds", SPANS)
def test_trailing_sums(spark, seconds):
    rows = skewed()
    found = detect.rolling_account_spend(visits(spark, rows), seconds).collect()
    assert {r.transaction_id: (r.txn_count, r.rolling_spend) for r in found} == python_trailing(
        rows, seconds
    )
    assert len(found) == len(rows) and {r.unsummed for r in found} == {0}


@pytest.mark.parametrize("seconds", SPANS)
def test_previous_row(spark, seconds):
    rows = skewed()
    df = visits(spark, rows)
    placed = timeline.with_previous(
        df, "account_id", "event_timestamp", "transaction_id", ["transaction_id"], seconds
    )
    found = {r.transaction_id: r.previous and r.previous.transaction_id for r in placed.collect()}
    expected, last = {}, {}
    for account, number, at, *_ in sorted(rows, key=lambda r: (r[2], r[1])):
        near = account in last and at - last[account][1] <= seconds
        expected[number] = last[account][0] if near else None
        last[account] = (number, at)
    assert found == expected


def test_amounts_that_no_sum_can_hold(spark):
    rows = [("a", f"tx-{i}", i, amount, "US") for i, amount in
            enumerate([1.5, 1e300, float("nan"), float("inf"), None, 2.0])]
    found = detect.rolling_account_spend(visits(spark, rows)).collect()
    last = max(found, key=lambda r: r.event_timestamp)
    assert (last.txn_count, last.rolling_spend, last.unsummed) == (6, 3.5, 3)


def test_many_rows_in_one_instant(spark):
    rows = [("hot", f"tx-{i:04d}", 7, 0.25, "US") for i in range(300)]
    rows += [("hot", f"ty-{i:04d}", 7 + 60 * i, 0.5, "JP") for i in range(1, 4)]
    rows += [("a", "tz-1", 7, 1.0, "US")]
    df = visits(spark, rows)
    found = detect.rolling_account_spend(df, 100).collect()
    sums = {r.transaction_id: (r.txn_count, r.rolling_spend) for r in found}
    assert sums == python_trailing(rows, 100)
    hops = [(r.transaction_id, r.previous_transaction_id) for r in detect.geo_hop(df, 100).collect()]
    assert hops == [("ty-0001", "tx-0299")]


def test_geo_hop(spark):
    rows = [
        ("a", "tx-1", 0, 1.0, "US"),
        ("a", "tx-2", 30, 1.0, "JP"),
        ("a", "tx-3", 30 + 3600, 1.0, "GB"),
        ("a", "tx-4", 30 + 7200 + 0.001, 1.0, "US"),
        ("b", "tx-5", 0, 1.0, "US"),
        ("b", "tx-6", 60, 1.0, "US"),
        ("b", "tx-7", 60, 1.0, "JP"),
        (None, "tx-8", 0, 1.0, "US"),
        (None, "tx-9", 10, 1.0, "JP"),
        ("c", "tx-10", None, 1.0, "JP"),
        ("c", "tx-11", 5, 1.0, "US"),
    ]
    found = {r.transaction_id: r for r in detect.geo_hop(visits(spark, rows), 3600).collect()}
    assert set(found) == {"tx-2", "tx-3", "tx-7"}
    assert found["tx-2"].previous_transaction_id == "tx-1"
    assert found["tx-2"].gap_seconds == 30.0
    assert found["tx-2"].distance_km == pytest.approx(10848, abs=10)
    assert found["tx-2"].speed_kmh == pytest.approx(found["tx-2"].distance_km * 120, rel=1e-6)
    assert found["tx-7"].speed_kmh is None


def test_velocity(spark):
    burst = [("a", f"tx-{i}", 40 * i, 1.0, "US") for i in range(4)]
    edge = [
        ("b", "tx-b1", 0, 1.0, "US"),
        ("b", "tx-b2", 1800, 1.0, "US"),
        ("b", "tx-b3", 3600, 1.0, "US"),
        ("c", "tx-c1", 0, 1.0, "US"),
        ("c", "tx-c2", 1800, 1.0, "US"),
        ("c", "tx-c3", 3660, 1.0, "US"),
    ]
    found = detect.velocity_spike(visits(spark, burst + edge)).collect()
    assert {r.transaction_id: r.txn_count for r in found} == {
        "tx-2": 3, "tx-3": 4, "tx-b3": 3,
    }


def test_trailing_sums_match_spark_window(spark, sf_dir):
    from txnlake.plans import lake

    rows = lake.stored_silver(spark, sf_dir)
    frame = (
        Window.partitionBy("account_id")
        .orderBy(F.unix_micros("event_timestamp"))
        .rangeBetween(-86_400_000_000, 0)
    )
    plain = rows.select("transaction_id", F.count(F.lit(1)).over(frame).alias("txn_count"))
    ours = detect.rolling_account_spend(rows, 86_400)
    assert ours.select("transaction_id", "txn_count").exceptAll(plain).count() == 0
    assert plain.count() == ours.count()


def test_panes_equal_sliding_windows(spark):
    df = visits(spark, skewed())
    for window, slide in ((5, 1), (60, 10), (3, 3)):
        panes = windows.sliding_category_volume(df, window, slide)
        plain = windows.sliding_volume(
            df, ["merchant_category"], f"{window} minutes", f"{slide} minutes"
        )
        assert sorted(map(tuple, panes.collect())) == sorted(map(tuple, plain.collect()))


def test_panes_need_a_multiple(spark):
    with pytest.raises(ValueError):
        windows.sliding_category_volume(visits(spark, []), 5, 2)


def test_hourly_spend(spark):
    rows = [("a", "1", 0, 1.0, "US"), ("a", "2", 3598, 2.0, "US"), ("a", "3", 3600, 4.0, "US")]
    found = windows.hourly_account_spend(visits(spark, rows)).orderBy("hour_start").collect()
    assert [(r.hour_start.hour, r.txn_count, r.spend, r.avg_spend) for r in found] == [
        (10, 2, 3.0, 1.5), (11, 1, 4.0, 4.0),
    ]


def test_currency_join_equals_map_rule(spark, sf_dir):
    from txnlake.plans import lake, queries

    joined = queries.currency_rule_join(spark, sf_dir)
    flagged = lake.stored_silver(spark, sf_dir).select("transaction_id", "is_suspicious_currency")
    ours = joined.select("transaction_id", "is_suspicious_currency")
    assert ours.exceptAll(flagged).count() == flagged.exceptAll(ours).count() == 0


def test_currency_join_nulls(spark):
    pairs = spark.createDataFrame([("US", "USD")], "country STRING, currency STRING")
    rows = spark.createDataFrame(
        [("1", "US", "USD"), ("2", "US", "EUR"), ("3", "US", None), ("4", "FR", "EUR"),
         ("5", None, "USD")],
        "transaction_id STRING, country STRING, currency STRING",
    )
    found = detect.currency_rule_join(rows, pairs).collect()
    assert {r.transaction_id: r.is_suspicious_currency for r in found} == {
        "1": False, "2": True, "3": None, "4": False, "5": False,
    }


def test_a_country_listed_twice_multiplies_nothing(spark):
    pairs = spark.createDataFrame(
        [("US", "USD"), ("US", "EUR"), ("US", "USD")], "country STRING, currency STRING"
    )
    rows = spark.createDataFrame(
        [("1", "US", "USD")], "transaction_id STRING, country STRING, currency STRING"
    )
    assert detect.currency_rule_join(rows, pairs).count() == 1


def test_schema_names():
    assert schemas.names("a STRING, `b` INT") == ["a", "b"]
