"""Sharding by proportional stratified interleaving.

Rows are put in seeded random order within their source and get the fraction of the source that
lies before them, moved on by a part of a row that a hash of the source chooses, so that sources of
one or two rows spread as well.  Sorted by that fraction, every stretch of the table has the mixture
of the whole, so equal cuts give shards of equal row counts and equal mixture.  Both rankings count
in buckets of a uniform value: a rank is the rows of earlier buckets plus the place within the
bucket, so no source, however large or small, is sorted in one task with many others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnlake.llm.common import RID, numbered, stored

SHARDS = 24
SEED = 20240131
BUCKETS = 1024
BUCKET_ROWS = 100_000


def _bucket_of_hash(buckets: int):
    """Grows with the hash, from 0 to `buckets` - 1."""
    top = F.shiftright("h", 33) + F.lit(1 << 30)
    return F.shiftright(top * F.lit(buckets), 31)


def interleave(
    docs: DataFrame,
    shards: int = SHARDS,
    seed: int = SEED,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """One row for each row: doc_id, source, size, text_crc32, law, shard, slot, grown_shard.

    The law is `rows`: row counts of shards differ by one at most.  For each source, so do its rows
    in a shard from its share, by at most two where sources are few; sources of a row or two are
    spread by chance.  The size is the bytes of the text, none for null, plus 8.  A null source is a
    source of its own; a row without an id, or whose id more than BUCKET_ROWS rows have, is shuffled
    by its place in the scan.  Rows that are alike in every value are interchangeable.  An empty
    table gives an empty result.  Other columns are not read.
    """
    blank = F.coalesce(F.col("raw"), F.lit(""))
    slim = stored(
        numbered(
            docs,
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            F.col(text).alias("raw"),
        ).select(
            "doc_id",
            "source",
            F.col("source").isNull().alias("no_source"),
            F.coalesce("source", F.lit("")).alias("src"),
            (F.octet_length(blank) + F.lit(8)).cast("long").alias("size"),
            F.crc32(blank.cast("binary")).alias("text_crc32"),
            RID,
        ),
        "shard-rows",
    )
    total = slim.count()
    buckets = max(BUCKETS, -(-total // BUCKET_ROWS))
    ties = ["h", "doc_id", "text_crc32", "size"]

    # At most one id for each BUCKET_ROWS rows.
    hot = slim.groupBy("doc_id").agg(F.count(F.lit(1)).alias("of_id"))
    hot = hot.filter(F.col("doc_id").isNotNull() & (F.col("of_id") > BUCKET_ROWS))
    h = (
        F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit(seed), RID))
        .when(F.col("of_id").isNull(), F.xxhash64(F.lit(seed), "doc_id"))
        .otherwise(F.xxhash64(F.lit(seed), "doc_id", RID))
    )
    hashed = (
        slim.join(F.broadcast(hot), "doc_id", "left")
        .withColumn("h", h)
        .drop("of_id", RID)
        .withColumn("b", _bucket_of_hash(buckets))
    )
    place = ["no_source", "src", "b"]
    of_source = Window.partitionBy("no_source", "src")
    before = of_source.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        hashed.groupBy(*place)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            *place,
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
            F.sum("n").over(of_source).alias("n_source"),
        )
    )
    rank = F.col("start") + F.row_number().over(Window.partitionBy(*place).orderBy(*ties)) - 1
    moved = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "no_source", "src"), 11)
    fraction = (F.col("rank") + moved / F.lit(float(1 << 53))) / F.col("n_source")
    ranked = stored(
        hashed.join(starts, place)
        .withColumn("rank", rank)
        .withColumn("fraction", fraction)
        .withColumn("c", F.least(F.floor(F.col("fraction") * buckets), F.lit(buckets - 1)))
        .drop("b", "start", "rank", "n_source"),
        "shard-ranks",
    )

    in_order = Window.orderBy("c").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (
        ranked.groupBy("c")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("c", F.coalesce(F.sum("n").over(in_order), F.lit(0)).alias("start"))
    )
    within = Window.partitionBy("c").orderBy("fraction", "no_source", "src", *ties)
    return (
        ranked.join(cuts, "c")
        .withColumn("at", F.col("start") + F.row_number().over(within) - 1)
        .withColumn("shard", F.expr(f"int(`at` * {shards} div {max(total, 1)})"))
        .withColumn(
            "slot", F.expr(f"`at` - (shard * bigint({total}) + {shards - 1}) div {shards}")
        )
        .select(
            "doc_id",
            "source",
            "size",
            "text_crc32",
            F.lit("rows").alias("law"),
            "shard",
            "slot",
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
