"""Per-account order and trailing sums that hold up when one account has most of the rows.

A plain window over an account sorts the whole account in one task.  Here a timeline is always cut
into stretches of the time that a row can look back, and a row's answer lies in its own stretch or
the one before.  Window groups are (account, stretch), whatever the account has in all; the plan is
the same at every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SECOND = 1_000_000  # microseconds


def _placed(df: DataFrame, key: str, time: str, seconds: int) -> DataFrame:
    """Rows that have a place on a timeline, with the number of their stretch."""
    rows = df.filter(F.col(key).isNotNull() & F.col(time).isNotNull())
    return rows.withColumn("_stretch", F.floor(F.unix_micros(time) / (seconds * SECOND)))


def with_previous(
    df: DataFrame,
    key: str,
    time: str,
    tie_break: str,
    carried: Sequence[str],
    seconds: int,
) -> DataFrame:
    """Add `previous`: the `carried` columns of the key's row before, in time and tie order.

    NULL where the row before lies further back than `seconds`, or there is none.  Rows without
    key or time are left out.  Of each stretch only the last row goes on to the next one.
    """
    rows = _placed(df, key, time, seconds)
    values = F.struct(*carried)
    last = F.max_by(values, F.struct(time, tie_break)).alias("_carry")
    carry = rows.groupBy(key, "_stretch").agg(last, F.max(time).alias("_carry_time"))
    carry = carry.select(
        key,
        (F.col("_stretch") + 1).alias("_stretch"),
        F.struct(F.col("_carry_time").alias("time"), F.col("_carry").alias("values")).alias("_carry"),
    )
    every = rows.withColumn("_own", F.lit(True)).unionByName(
        carry.withColumn("_own", F.lit(False)), allowMissingColumns=True
    )
    # A row carried over comes before all rows of the stretch.
    order = [F.col("_own"), F.col(time), F.col(tie_break)]
    before = Window.partitionBy(key, "_stretch").orderBy(*order)
    here = F.struct(F.col(time).alias("time"), values.alias("values"))
    seen = F.lag(F.when(F.col("_own"), here).otherwise(F.col("_carry"))).over(before)
    near = F.unix_micros(time) - F.unix_micros("_seen.time") <= seconds * SECOND
    return (
        every.withColumn("_seen", seen)
        .filter("_own")
        .withColumn("previous", F.when(near, F.col("_seen.values")))
        .select(*df.columns, "previous")
    )


def with_trailing_sums(
    df: DataFrame,
    key: str,
    time: str,
    seconds: int,
    measures: dict[str, Column],
) -> DataFrame:
    """Add sums of `measures` over the key's rows of the `seconds` up to and including each row.

    Both ends belong to the span, and so do all rows of the same instant.  Measures must be
    exact (BIGINT or DECIMAL): a span is the sum of all rows so far less the sum of those that
    are too old.  Both only ever grow along the timeline, which costs one addition per row,
    where a frame that slides adds up its whole span for every row.

    A row also counts in the next stretch, as an instant of its own sums: rows are first added up by
    instant, so what goes on is one row for each instant.
    """
    rows = _placed(df, key, time, seconds).withColumn("_at", F.unix_micros(time))
    values = {f"_m_{name}": F.coalesce(value, F.lit(0)) for name, value in measures.items()}
    carry = (
        rows.withColumns(values)
        .groupBy(key, "_stretch", "_at")
        .agg(*[F.sum(name).alias(name) for name in values])
        .withColumn("_stretch", F.col("_stretch") + 1)
        .withColumn("_own", F.lit(False))
    )
    own = rows.withColumns(values).withColumn("_own", F.lit(True))
    in_stretch = Window.partitionBy(key, "_stretch").orderBy("_at")
    until_now = in_stretch.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    too_old = in_stretch.rangeBetween(Window.unboundedPreceding, -seconds * SECOND - 1)
    sums = {
        name: F.sum(f"_m_{name}").over(until_now)
        - F.coalesce(F.sum(f"_m_{name}").over(too_old), F.lit(0))
        for name in measures
    }
    return (
        own.unionByName(carry, allowMissingColumns=True)
        .withColumns(sums)
        .filter("_own")
        .select(*df.columns, *measures)
    )
