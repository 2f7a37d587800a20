"""Benchmark decontamination: a prefix-filtered join of item windows with documents.

A window (some consecutive words of an item, or a whole short item) is contained in a document
only if all of its shingles are, so its rarest shingle is prefix enough.  Four steps:

1. count, over all documents, the shingles that occur in items: the order by rarity;
2. file each window under its rarest shingle; a window with a shingle that no document has
   cannot occur and goes;
3. join document shingles with these, and drop a pair where the window would begin before
   the first word or end after the last (length and positional bounds);
4. compare the words of the window with those of the document.

Documents are read twice and never shuffled: tasks send on the shingles that a bit table
of fixed size admits, each with as many words around it as a window filed under it can need, by a
second table of fixed size.  The tables let some others pass, or some words more; the join drops those.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import RID, RID_TYPE, byte_slices, numbered, rows_of, stored
from txnlake.llm.words import buffers, words_of

WINDOW = 10
SHINGLE = 5
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TABLE_BITS = 24  # the bit table takes 2 MB at any size of the benchmark
REACH_BITS = 19  # a table of 4 MB
CHUNK_BYTES = 1 << 20
CUT = 1 << 15  # bits of one bitmap of Spark's


def words_column(text: Column) -> Column:
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(F.coalesce(low, F.lit("")), F.lit(WORD), F.lit(0))


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows (item_id, window): all windows of each item, words joined by a space."""
    words = items.select("item_id", words_column(F.col("text")).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1)))
    runs = F.transform(starts, lambda i: F.array_join(F.slice("w", i, window), " "))
    return words.select("item_id", F.explode(F.array_distinct(runs)).alias("window")).distinct()


def _window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """Rows (window, n, m, h, off): the shingles of each window, of m words each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {k: [] for k in ("window", "n", "m", "h", "off")}
            for text in batch.column(0).to_pylist():
                data = np.frombuffer(text.encode(), np.uint8)
                words = words_of(data, np.array([0, len(data)]))
                n = len(words.starts)
                m = min(shingle, n)
                hashes, at = words.shingles(m)
                for h, off in zip(hashes.view(np.int64).tolist(), at.tolist(), strict=True):
                    for key, value in zip(out, (text, n, m, h, off), strict=True):
                        out[key].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    schema = pa.schema(
        [("window", pa.string()), ("n", pa.int32()), ("m", pa.int32()), ("h", pa.int64()),
         ("off", pa.int32())]
    )
    return windows.mapInArrow(run, "window string, n int, m int, h long, off int")


def _bit_table(hashes: DataFrame) -> np.ndarray:
    """Bits of all values of column h by their first TABLE_BITS bits."""
    slot = F.shiftrightunsigned("h", 64 - TABLE_BITS)
    parts = (
        hashes.select(slot.alias("slot"))
        .groupBy(F.floor(F.col("slot") / CUT).cast("int").alias("part"))
        .agg(F.expr(f"bitmap_construct_agg(slot % {CUT})").alias("bits"))
        .collect()  # 2 MB at most
    )
    bits = np.zeros((1 << TABLE_BITS) // 8, np.uint8)
    for part, own in parts:
        at = part * (CUT // 8)
        bits[at : at + CUT // 8] = np.frombuffer(bytes(own), np.uint8)
    return bits


def _reach_table(prefixes: DataFrame) -> np.ndarray:
    """By the first REACH_BITS bits of h: the most words before and from the shingle in a window."""
    slot = F.shiftrightunsigned("h", 64 - REACH_BITS).cast("int")
    most = prefixes.groupBy(slot.alias("slot")).agg(
        F.max("off").cast("int").alias("before"), F.max(F.col("n") - F.col("off")).alias("after")
    )
    rows = most.toArrow()  # one row for each slot at most
    reach = np.zeros((1 << REACH_BITS, 2), np.int32)
    for i, side in enumerate(("before", "after")):
        reach[np.asarray(rows["slot"]), i] = np.asarray(rows[side])
    return reach


def _admitted(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes >> np.uint64(64 - TABLE_BITS)
    held = bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)
    return np.flatnonzero(held & 1)


def _chunks(batch: pa.RecordBatch, column: str):
    """Row ranges of a batch with their words, about CHUNK_BYTES at a time."""
    data, offsets = buffers(batch.column(column))
    for a, b in byte_slices(np.diff(offsets).tolist(), CHUNK_BYTES):
        yield a, b, words_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])


def _seen(texts: DataFrame, bits, lengths: list[int]) -> DataFrame:
    """Rows (h, n): admitted shingles of the documents, counted for each chunk of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, words in _chunks(batch, "text"):
                found = [np.zeros(0, np.uint64)]
                for m in lengths:
                    hashes, _ = words.shingles(m)
                    found.append(hashes[_admitted(bits.value, hashes)])
                h, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"]
                )

    return texts.mapInArrow(run, "h long, n long")


def _probes(rows: DataFrame, bits, reach, lengths: list[int]) -> DataFrame:
    """For each document its number of words and its admitted shingles with their surroundings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, words in _chunks(batch, "text"):
                where, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for m in lengths:
                    h, at = words.shingles(m)
                    take = _admitted(bits.value, h)
                    where.append(at[take])
                    hashes.append(h[take].view(np.int64))
                at, h = np.concatenate(where), np.concatenate(hashes)
                order = np.argsort(at, kind="stable")
                at, h = at[order], h[order]
                doc = np.searchsorted(words.first, at, "right") - 1
                sides = reach.value[h.view(np.uint64) >> np.uint64(64 - REACH_BITS)]
                begin = np.maximum(words.first[doc], at - sides[:, 0])
                end = np.minimum(words.first[doc + 1], at + sides[:, 1])
                around = [words.text(x, y) for x, y in zip(begin, end, strict=True)]
                probes = pa.StructArray.from_arrays(
                    [
                        pa.array(h, pa.int64()),
                        pa.array(at - words.first[doc], pa.int32()),
                        pa.array(at - begin, pa.int32()),
                        pa.array(around, pa.string()),
                    ],
                    names=["h", "pos", "lead", "around"],
                )
                per_doc = np.searchsorted(at, words.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(RID).slice(a, b - a),
                        pa.array(np.diff(words.first), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(per_doc, pa.int32()), probes),
                    ],
                    names=[RID, "n_words", "probes"],
                )

    probe = "array<struct<h: long, pos: int, lead: int, around: string>>"
    return rows.select(RID, "text").mapInArrow(run, f"{RID} {RID_TYPE}, n_words long, probes {probe}")


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    shingle: int = SHINGLE,
    text: str = "text",
) -> DataFrame:
    """One row for each row of `docs`: _rid, n_words, hits, item_ids.

    `items` has (item_id, text).  Words are runs of digits, letters and non-ASCII characters, A-Z
    lower-cased.  `hits` are the places (start, n) of windows in the document, `item_ids` the
    sorted ids, as text, of items with such a window.  Null and empty texts have no words and no
    hits; an item without words has no window; an item without an id hits words but is not named.
    Repeated items and ids count once, repeated documents each for themselves.  Empty tables give
    no hits or no rows.  Other columns are not read.
    """
    spark = docs.sparkSession
    of_items = stored(item_windows(items, window), "item-windows")
    shingles = stored(
        _window_shingles(of_items.select("window").distinct(), shingle), "item-shingles"
    )
    lengths = sorted(r.m for r in shingles.select("m").distinct().collect())  # 1 to `shingle`
    rows = numbered(docs, F.col(text).alias("text"))

    every = spark.sparkContext.broadcast(_bit_table(shingles))
    counts = _seen(rows.select("text"), every, lengths).groupBy("h").agg(F.sum("n").alias("seen"))
    rarity = shingles.select("h").distinct().join(counts, "h", "left").fillna(0, ["seen"])
    prefixes = stored(
        shingles.join(rarity, "h")
        .groupBy("window", "n", "m")
        .agg(F.min(F.struct("seen", "h", "off")).alias("rarest"))
        .filter("rarest.seen > 0")
        .select("window", "n", "rarest.h", "rarest.off"),
        "item-prefixes",
    )

    rare = spark.sparkContext.broadcast(_bit_table(prefixes))
    reach = spark.sparkContext.broadcast(_reach_table(prefixes))
    probes = _probes(rows, rare, reach, lengths).select(
        RID, "n_words", F.explode_outer("probes").alias("p")
    )
    # Documents without a probe get a key of their own, so that they do not meet in one task.
    keyed = probes.withColumn("h", F.coalesce("p.h", F.xxhash64(RID)))
    start = F.col("p.pos") - F.col("off")
    fits = (start >= 0) & (start + F.col("n") <= F.col("n_words"))
    around = F.regexp_extract_all(F.col("p.around"), F.lit(WORD), F.lit(0))
    inside = F.array_join(F.slice(around, F.col("p.lead") - F.col("off") + 1, F.col("n")), " ")
    equal = F.when(F.col("p").isNotNull() & fits, inside == F.col("window"))
    hit = F.when(equal, F.struct(start.alias("start"), F.col("n")))
    found = (
        keyed.join(prefixes, "h", "left")
        .select(RID, "n_words", hit.alias("hit"), F.when(equal, F.col("window")).alias("window"))
        .groupBy(RID, "n_words")
        .agg(F.collect_set("hit").alias("hits"), F.collect_set("window").alias("windows"))
    )
    named = found.select(RID, "n_words", "hits", F.explode_outer("windows").alias("w"))
    named = named.withColumn(
        "window", F.coalesce("w", F.concat(F.lit("\n"), F.col(RID).cast("string")))
    )
    return (
        named.join(of_items, "window", "left")
        .groupBy(RID, "n_words", "hits")
        .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    )


def words_hit(hits: Column) -> Column:
    """How many words the hits cover."""
    covered = F.transform(hits, lambda h: F.sequence(h["start"], h["start"] + h["n"] - 1))
    return F.size(F.array_distinct(F.flatten(covered))).cast("long")


def clean_rows(docs: DataFrame, items: DataFrame, **parameters) -> DataFrame:
    """The rows of `docs` without a hit, with all their columns."""
    return rows_of(docs, decontaminate(docs, items, **parameters).filter(F.size("hits") == 0))
