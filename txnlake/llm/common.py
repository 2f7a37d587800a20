"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake import session

RID = "_rid"
RID_TYPE = "struct<file: long, row: long>"

# Rows of one Arrow batch between Spark and Python.  Texts are long: Spark's default of 10,000 rows
# would hold tens of MB at a time in every worker, and as much beside the heap of its executor.
BATCH_ROWS = "1000"


def small_batches(df: DataFrame) -> DataFrame:
    """`df`; its session sends rows to Python in small batches from now on."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df: DataFrame, *columns: Column | str) -> DataFrame:
    """The given columns and a number for each row: a hash of its file's path, and its place there.

    Ids may be null or repeated, so operators tell rows apart by this number.  `df` has to be read
    from files, not be the output of a shuffle or a union (that raises).  However the files are cut
    into tasks, now, when a task is run again or in a second scan, a row has the same number.
    """
    place = df.metadataColumn("_metadata")
    number = F.struct(
        F.xxhash64(place["file_path"]).alias("file"), place["row_index"].alias("row")
    )
    return small_batches(df).select(*columns, number.alias(RID))


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written to the shared folder and read back: lineage ends here."""
    path = session.scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows_of(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of `docs` whose numbers are in `chosen`, with all their columns as they were."""
    whole = numbered(docs, F.struct("*").alias("_row"))
    return whole.join(chosen.select(RID), RID, "left_semi").select("_row.*")


def nulls_last(column: str) -> list[Column]:
    """Two ordering values; for use in structs, where nulls would come first."""
    return [F.col(column).isNull().alias(f"{column}_null"), F.col(column)]


def byte_slices(sizes, limit: int):
    """Consecutive (start, end) row ranges of at most `limit` bytes, one row at least."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if len(sizes) > start:
        yield start, len(sizes)
