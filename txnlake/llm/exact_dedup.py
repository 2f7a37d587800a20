"""Exact deduplication by skew-safe combining.

Rows are grouped three times, each time by digest *and* whole text, so that no two different texts
ever meet: within a task (the map side of the first aggregation), within a salted digest group, and
over the salts of a digest.  A text that a third of all rows carry reaches the last step as one row
for each salt.  What leaves the groups is a winner and a size; a row finds its group by digest, and
by whole text where a digest stands for several texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import RID, numbered, nulls_last, rows_of, stored

WHITE_SPACE = " \t\n\v\f\r"
SALTS = 16


def without_white_space(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for char in WHITE_SPACE:
        out = F.replace(out, F.lit(char), F.lit(""))
    return out


def sha256_of(text: Column) -> Column:
    return F.sha2(text, 256)


def _groups(rows: DataFrame, salts: int) -> DataFrame:
    """One row for each text: digest, norm, winner, size."""
    rank = F.struct(
        (-F.col("n_chars")).alias("shorter"), *nulls_last("id"), F.col(RID)
    )
    salted = rows.groupBy("digest", "norm", F.pmod(F.xxhash64(RID), F.lit(salts)).alias("salt")).agg(
        F.min(rank).alias("best"), F.count(F.lit(1)).alias("n")
    )
    return (
        salted.groupBy("digest", "norm")
        .agg(F.min("best").alias("best"), F.sum("n").alias("group_size"))
        .select(
            "digest",
            "norm",
            F.col("best.id").alias("keep_id"),
            F.col(f"best.{RID}").alias("keep_rid"),
            "group_size",
        )
    )


def exact_dedup(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256_of,
) -> DataFrame:
    """One row for each row of `docs`: doc_id, keep_id, group_size, kept, text_sha256, _rid.

    Texts are equal when identical without white space; null counts as empty.  Of equal texts the
    row with most code points stays, then the smallest doc_id (a null id comes last), then the
    first row.  Exactly one row of a group is kept, also where ids repeat.  Other columns are not
    read.  An empty table gives an empty result.  `digest` only finds candidates.
    """
    raw = numbered(docs, F.col(doc_id).alias("id"), F.col(text).alias("raw"))
    rows = raw.select(
        RID,
        "id",
        F.coalesce(F.char_length("raw"), F.lit(0)).alias("n_chars"),
        without_white_space(F.col("raw")).alias("norm"),
    ).withColumn("digest", digest(F.col("norm")))
    groups = stored(_groups(rows, salts).drop("norm"), "exact-groups")
    several = groups.groupBy("digest").count().filter("count > 1").select("digest")
    named = rows.withColumn("text_sha256", sha256_of(F.col("norm")))
    if several.isEmpty():
        joined = named.drop("norm").join(groups, "digest")
    else:
        several = stored(several, "exact-several")
        alone = named.drop("norm").join(groups.join(several, "digest", "left_anti"), "digest")
        mixed = rows.join(several, "digest", "left_semi")
        told = (
            named.join(several, "digest", "left_semi")
            .join(_groups(mixed, salts), ["digest", "norm"])
            .drop("norm")
        )
        joined = alone.unionByName(told)
    return joined.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        (F.col(RID) == F.col("keep_rid")).alias("kept"),
        "text_sha256",
        RID,
    )


def kept_rows(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    return rows_of(docs, exact_dedup(docs, text, doc_id).filter("kept"))
