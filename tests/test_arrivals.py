"""Arrivals cover all rows once, in time order, also where there is no time or no row."""

import pytest
from pyspark.sql import functions as F

from txnlake.plans import lake, streams


@pytest.fixture
def odd_dir(spark, sf_dir, tmp_path):
    """The events with some times missing."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    no_time = F.col("event_id") % 50 == 0
    path = f"{tmp_path}/odd"
    events.withColumn("ts", F.when(~no_time, F.col("ts"))).write.parquet(f"{path}/events.parquet")
    return path


def test_arrivals(spark, sf_dir, tmp_path):
    path = str(tmp_path / "silver")
    latest, seen, runs = None, 0, 0
    for _ in lake.silver_arrivals(spark, sf_dir, path):
        rows = spark.read.parquet(path)
        count, last = rows.agg(F.count(F.lit(1)), F.max("event_timestamp")).first()
        if latest is not None:
            assert rows.filter(F.col("event_timestamp") > F.lit(latest)).count() == count - seen
        latest, seen, runs = last, count, runs + 1
    silver = lake.stored_silver(spark, sf_dir)
    assert runs == lake.QUARTERS and seen == silver.count()
    assert spark.read.parquet(path).exceptAll(silver).count() == 0


def test_overlapping_arrivals_cover_all_rows(spark, sf_dir, tmp_path):
    path, latest, out_of_order = str(tmp_path / "silver"), None, 0
    seen = 0
    for _ in lake.silver_arrivals(spark, sf_dir, path, overlap_seconds=300_000):
        rows = spark.read.parquet(path)
        count, last = rows.agg(F.count(F.lit(1)), F.max("event_timestamp")).first()
        if latest is not None:
            out_of_order += count - seen - rows.filter(F.col("event_timestamp") > latest).count()
        latest, seen = last, count
    silver = lake.stored_silver(spark, sf_dir)
    assert out_of_order > 0
    assert seen == silver.count() and spark.read.parquet(path).exceptAll(silver).count() == 0


def test_delayed_rows_come_last(spark, sf_dir, tmp_path):
    path = str(tmp_path / "silver")
    late = "country = 'JP'"
    in_first = []
    for _ in lake.silver_arrivals(spark, sf_dir, path, late):
        cut = lake.arrival_bounds(spark, sf_dir)[0]
        early = F.col("event_timestamp") < lake._time(cut)
        in_first.append(spark.read.parquet(path).filter(late).filter(early).count())
    assert in_first[:3] == [0, 0, 0] and in_first[3] > 0
    silver = lake.stored_silver(spark, sf_dir)
    assert spark.read.parquet(path).count() == silver.count()


def test_messages_arrive_once(spark, sf_dir, odd_dir, tmp_path):
    for number, source in enumerate((sf_dir, odd_dir)):
        path = f"{tmp_path}/messages-{number}"
        for _ in lake.message_arrivals(spark, source, path):
            pass
        everything = lake.raw(spark, source)
        landed = spark.read.parquet(path)
        assert landed.count() == everything.count()
        assert landed.exceptAll(everything).count() == 0


def test_streams_take_rows_without_a_time(spark, odd_dir, tmp_path):
    stream, batch = streams.stream_silver(spark, odd_dir), lake.stored_silver(spark, odd_dir)
    assert batch.filter("event_timestamp IS NULL").count() > 0
    assert stream.exceptAll(batch).count() == batch.exceptAll(stream).count() == 0
    path = f"{tmp_path}/silver"
    for _ in lake.silver_arrivals(spark, odd_dir, path):
        pass
    assert spark.read.parquet(path).count() == batch.count()


def test_streams_take_an_empty_table(spark, sf_dir, tmp_path):
    path = f"{tmp_path}/empty"
    spark.read.parquet(f"{sf_dir}/events.parquet").limit(0).write.parquet(f"{path}/events.parquet")
    assert streams.stream_silver(spark, path).count() == 0
    assert streams.stream_geo_hop(spark, path).count() == 0


def test_date_folders_are_pruned(spark, sf_dir, tmp_path, monkeypatch):
    seen = []
    plain = type(lake.stored_silver(spark, sf_dir)).write.fget

    def watched(df):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df)

    monkeypatch.setattr(type(lake.stored_silver(spark, sf_dir)), "write", property(watched))
    for _ in lake.silver_arrivals(spark, sf_dir, f"{tmp_path}/silver"):
        pass
    assert all("PartitionFilters: [isnotnull(transaction_date" in plan for plan in seen[:3])
