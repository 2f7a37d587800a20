"""Line dedup by a deletion-neighbourhood join.

Two lines are alike when one word changed, dropped or put in makes them equal.  A line of n words
emits, hashed, its n variants with one word deleted; and, as the shorter line of a pair, its n + 1
variants with a word missing at a gap.  A variant's key has the length of the longer line, the
place, and the words before and after it, so lines with equal keys are all within one edit of each
other, and the earliest of them stands for the group: no pairs are made within it.

An edit leaves one half of the longer line as it is.  Only lines that share a half with another line
take part, and only with the variants of the other half: the rest cannot have a partner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import RID, numbered, nulls_last, stored

MIN_WORDS = 8
BLOCK = 256  # words of a long line that are hashed at a time; no effect on the result
WHITE_SPACE = r"[\x20\x09\x0B-\x0D]+"


def words_of(line: Column) -> Column:
    return F.filter(F.split(line, WHITE_SPACE), lambda w: w != "")


def _lines(rows: DataFrame) -> DataFrame:
    """Rows (_rid, doc_id, line_no, line) of lines that have a word."""
    split = F.posexplode(F.split(F.col("text"), "\n", -1)).alias("line_no", "line")
    return rows.select(RID, "doc_id", split).filter(F.col("line").rlike(r"[^\x20\x09\x0B-\x0D]"))


def _half_keys(n: Column) -> Column:
    """Keys of both halves of the line itself, and of the line as the shorter one of a pair."""

    def key(side: str, size: Column, words: Column) -> Column:
        return F.xxhash64(F.lit(side), size, F.array_join(words, " "))

    def front(size):
        return key("front", size, F.slice("w", F.lit(1), F.floor(size / 2).cast("int")))

    def rear(size):
        count = (size - F.floor(size / 2)).cast("int")
        return key("rear", size, F.slice("w", n - count + 1, count))

    return F.array(front(n), rear(n), front(n + 1), rear(n + 1))


def _running(words: Column, side: int = 1) -> Column:
    """Hashes of the first 0, 1, 2, ... words, each of the one before and the next word.

    With `side` -1 of the last words, from the end on.  Every step copies the hashes it adds to, so
    a long line is hashed in blocks of words: first the hash that each block starts from, then the
    hashes within each block.  `words` has to be a column, not made anew at every use.
    """

    def one_more(hashes: Column, word: Column) -> Column:
        return F.concat(hashes, F.array(F.xxhash64(F.element_at(hashes, -1), word)))

    def places(block: Column) -> Column:
        return F.sequence(block * BLOCK + 1, F.least(block * BLOCK + BLOCK, F.size(words)))

    zero = F.lit(0).cast("long")
    blocks = F.sequence(F.lit(0), F.floor((F.size(words) - 1) / BLOCK).cast("int"))
    starts = F.aggregate(
        blocks,
        F.array(zero),
        lambda all_, block: F.concat(
            all_,
            F.array(
                F.aggregate(
                    places(block),
                    F.element_at(all_, -1),
                    lambda last, at: F.xxhash64(last, F.element_at(words, at * side)),
                )
            ),
        ),
    )

    def within(block: Column, start: Column) -> Column:
        hashes = F.aggregate(
            places(block),
            F.array(start),
            lambda all_, at: one_more(all_, F.element_at(words, at * side)),
        )
        return F.slice(hashes, 2, BLOCK)

    paired = F.arrays_zip(blocks.alias("block"), F.slice(starts, 1, F.size(blocks)).alias("start"))
    long_line = F.concat(
        F.array(zero),
        F.flatten(F.transform(paired, lambda b: within(b["block"], b["start"]))),
    )
    short_line = F.aggregate(words if side > 0 else F.reverse(words), F.array(zero), one_more)
    return F.when(F.size(words) <= BLOCK, short_line).otherwise(long_line)


def _variants(lines: DataFrame) -> DataFrame:
    """Rows (key, no) for lines (no, line, matched): variants where the edit can be."""

    def span(kind: int, first: Column, last: Column, longer: Column) -> Column:
        places = F.when(
            F.array_contains("matched", F.lit(kind)) & (first <= last), F.sequence(first, last)
        ).otherwise(F.array().cast("array<int>"))
        return F.transform(
            places,
            lambda p: F.xxhash64(
                longer, p, F.element_at("ahead", p + 1), F.element_at("behind", longer - p)
            ),
        )

    n = F.col("n")
    half = F.floor(n / 2).cast("int")
    half_longer = F.floor((n + 1) / 2).cast("int")
    zero = F.lit(0)
    keys = F.concat(
        span(0, half, n - 1, n),
        span(1, zero, half - 1, n),
        span(2, half_longer, n, n + 1),
        span(3, zero, half_longer - 1, n + 1),
    )
    words = lines.select("no", "matched", words_of(F.col("line")).alias("w"))
    hashed = words.select(
        "no",
        "matched",
        F.size("w").alias("n"),
        _running(F.col("w")).alias("ahead"),
        _running(F.col("w"), -1).alias("behind"),
    )
    return hashed.select(F.explode(keys).alias("key"), "no")


def within_one_edit(a: Column, b: Column) -> Column:
    """Whether two arrays of words differ by one word changed, dropped or put in at most."""
    longer = F.when(F.size(a) >= F.size(b), a).otherwise(b)
    shorter = F.when(F.size(a) >= F.size(b), b).otherwise(a)
    n = F.size(shorter)
    same = F.zip_with(shorter, F.slice(longer, F.lit(1), n), lambda x, y: x == y)
    at = F.array_position(same, False).cast("int")
    first = F.when(at == 0, n + 1).otherwise(at)
    changed = F.size(F.filter(same, lambda x: ~x)) <= 1
    dropped = F.slice(longer, first + 1, F.size(longer)) == F.slice(shorter, first, F.size(longer))
    return F.when(F.size(longer) == n, changed).otherwise((F.size(longer) == n + 1) & dropped)


def dedup_lines(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """One row for each row of `docs`: doc_id, n_lines, n_kept, kept (line numbers from 0), _rid.

    Lines are compared as words between white space.  A line goes when an equal line comes earlier
    (by doc_id, null last, then by row, then by line), or, from `min_words` words on for both, an
    earlier line, itself kept or not, that differs by one word.  Lines without a word are left alone
    and not counted.  Null and empty texts have no lines.  Repeated rows are documents of their own,
    so the first one keeps its lines.  An empty table gives an empty result.  Other columns are not
    read.  Equal lines are found by 128-bit hashes; a difference of one word is verified.
    """
    rows = numbered(docs, F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    lines = _lines(rows).withColumn("w", words_of(F.col("line")))
    joined = F.array_join("w", " ")
    n = F.size("w")
    place = [*nulls_last("doc_id"), F.col(RID), F.col("line_no")]
    keys = F.when(n >= min_words, _half_keys(n))
    first = (
        lines.groupBy(
            F.xxhash64(joined).alias("h1"), F.xxhash64(F.lit(1), joined).alias("h2")
        )
        .agg(F.min(F.struct(*place, keys.alias("keys"))).alias("first"))
        .select("h1", "h2", "first.*")
    )
    first = stored(first, "lines-first")

    halves = first.filter("keys is not null").select(
        RID, "line_no", F.posexplode("keys").alias("kind", "key")
    )
    shared = halves.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    # Written, as the groups below: a join of two plain shuffles can be split where a key is hot.
    shared = stored(shared, "lines-shared")
    takers = (
        halves.join(shared, "key")
        .groupBy(RID, "line_no")
        .agg(F.collect_set("kind").alias("matched"))
        .groupBy(RID)
        .agg(F.collect_list(F.struct("line_no", "matched")).alias("of"))
    )  # as many as the document has lines
    chosen = (
        rows.join(takers, RID)
        .select(RID, "doc_id", F.split("text", "\n", -1).alias("lines"), F.explode("of").alias("t"))
        .select(
            RID,
            "doc_id",
            F.col("t.line_no").alias("line_no"),
            F.col("t.matched").alias("matched"),
            F.element_at("lines", F.col("t.line_no") + 1).alias("line"),
        )
    )
    # Numbers in order of place, so that the earliest line is the one with the least number.
    chosen = stored(
        chosen.orderBy(F.col("doc_id").asc_nulls_last(), RID, "line_no").withColumn(
            "no", F.monotonically_increasing_id()
        ),
        "lines-chosen",
    )
    variants = _variants(chosen)
    groups = variants.groupBy("key").agg(F.min("no").alias("least"), F.max("no").alias("most"))
    groups = stored(groups.filter("least < most").select("key", "least"), "lines-groups")
    pairs = (
        variants.join(groups, "key")
        .filter("least < no")
        .select("no", "least")
        .distinct()
    )
    texts = chosen.select("no", RID, "line_no", words_of(F.col("line")).alias("w"))
    earlier = texts.select(F.col("no").alias("least"), F.col("w").alias("v"))
    gone = (
        pairs.join(texts, "no")
        .join(earlier, "least")
        .filter(within_one_edit(F.col("w"), F.col("v")))
        .select(RID, "line_no")
        .distinct()
    )
    kept = (
        first.select(RID, "line_no")
        .join(gone, [RID, "line_no"], "left_anti")
        .groupBy(RID)
        .agg(F.array_sort(F.collect_list("line_no")).alias("kept"))
    )
    with_words = F.filter(
        F.split(F.coalesce("text", F.lit("")), "\n", -1),
        lambda line: line.rlike(r"[^\x20\x09\x0B-\x0D]"),
    )
    counted = rows.select(RID, "doc_id", F.size(with_words).cast("long").alias("n_lines"))
    none = F.array().cast("array<int>")
    return counted.join(kept, RID, "left").select(
        "doc_id",
        "n_lines",
        F.coalesce(F.size("kept"), F.lit(0)).cast("long").alias("n_kept"),
        F.coalesce("kept", none).alias("kept"),
        RID,
    )


def keep_lines(docs: DataFrame, min_words: int = MIN_WORDS, text: str = "text", **names):
    """The rows of `docs` with the lines that stay; lines without a word stay as well."""
    kept = dedup_lines(docs, min_words, text, **names).select(RID, F.col("kept").alias("_kept"))
    rows = numbered(docs, F.struct("*").alias("_row")).join(kept, RID)
    lines = F.split(F.col("_row").getField(text), "\n", -1)
    stays = F.filter(
        F.transform(
            lines,
            lambda line, i: F.struct(
                line.alias("line"),
                (
                    F.array_contains("_kept", i) | ~line.rlike(r"[^\x20\x09\x0B-\x0D]")
                ).alias("stays"),
            ),
        ),
        lambda x: x["stays"],
    )
    out = F.array_join(F.transform(stays, lambda x: x["line"]), "\n")
    return rows.select(F.col("_row").withField(text, out).alias("_row")).select("_row.*")
