"""Substring dedup over sliding runs of sentences.

Every run of consecutive sentences that is just long enough is hashed and joined with all others; a
run that occurred before, in an earlier document or earlier in its own, loses its sentences.  From
each sentence two runs are taken, one onwards and one backwards, each up to the first sentence with
which it has RUN_WORDS words, and of two sentences at least, or one of LONE_WORDS words.  So any
shared stretch of whole sentences with RUN_WORDS words, in two sentences or more, or of one sentence
with LONE_WORDS words, is covered from end to end.  Both are far below the 50 words of a passage
that matters: where its first and last sentences are glued to other text, the whole sentences in
between have to be enough.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import RID, RID_TYPE, numbered, nulls_last, stored

RUN_WORDS = 12
LONE_WORDS = 25
# One set of characters at the front, which `re` looks for without trying the rest everywhere.
SENTENCE_END = re.compile(r"[.!?。！？｡।؟۔\n](?:(?<=[.!?])\s+|(?<![.!?])\s*)")
# Scripts without blanks between words: a word is one character, or four of an alphabet.
SINGLE = "\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\uff66-\uff9d\U00020000-\U0003ffff"
FOURS = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff"
MARKS = "\u3000-\u303f\uff00-\uff65"
NO_BLANKS = re.compile(f"[{SINGLE}{FOURS}]")
UNITS = re.compile(f"[{SINGLE}]|[{FOURS}]{{1,4}}|[^\\s{SINGLE}{FOURS}{MARKS}]+")


def sentences(text: str) -> tuple[list[str], list[int]]:
    """The sentences, white space made single, and where each begins; the end of the text last.

    What stands between two sentences belongs to the first of them.
    """
    out, starts, at = [], [], 0
    for end in [*(m.end() for m in SENTENCE_END.finditer(text)), len(text)]:
        plain = " ".join(text[at:end].split())
        if plain:
            out.append(plain)
            starts.append(at)
        at = end
    return out, [*starts, len(text)]


def n_words(sentence: str) -> int:
    if sentence.isascii() or not NO_BLANKS.search(sentence):
        return sentence.count(" ") + 1
    return len(UNITS.findall(sentence))


def runs(plain: list[str], run_words: int, lone_words: int) -> list[tuple[int, int]]:
    """(first, last) sentence of all runs, sorted."""
    n = len(plain)
    sizes = np.fromiter((n_words(s) for s in plain), np.int64, n)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    at = np.arange(n)
    least = np.where(sizes >= lone_words, at, at + 1)
    onward = np.maximum(np.searchsorted(ends, starts + run_words), least)
    least = np.where(sizes >= lone_words, at, at - 1)
    back = np.minimum(np.searchsorted(starts, ends - run_words, "right") - 1, least)
    found = {(i, int(onward[i])) for i in range(n) if onward[i] < n}
    found |= {(int(back[i]), i) for i in range(n) if back[i] >= 0}
    return sorted(found)


def _hashed(rows: DataFrame, run_words: int, lone_words: int) -> DataFrame:
    """Rows (_rid, doc_id, n_sentences, runs); `own` marks a run that came before in the same text."""

    def one(text: str):
        plain, _ = sentences(text)
        digest = xxhash.xxh3_128_digest
        marks = b"".join(digest(s.encode()) for s in plain)
        found, seen = [], set()
        for a, b in runs(plain, run_words, lone_words):
            key = digest(marks[16 * a : 16 * b + 16])
            found.append((key, a, b, key in seen))
            seen.add(key)
        return len(plain), found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for start in range(0, big.num_rows, 500):
                batch = big.slice(start, 500)
                sizes, found = zip(*(one(t.as_py() or "") for t in batch.column("text")), strict=True)
                every = [r for f in found for r in f]
                keys = np.frombuffer(b"".join(r[0] for r in every), np.int64)
                ends = np.cumsum([0, *map(len, found)])
                flat = pa.StructArray.from_arrays(
                    [
                        pa.array(keys[::2]),
                        pa.array(keys[1::2]),
                        pa.array([r[1] for r in every], pa.int32()),
                        pa.array([r[2] for r in every], pa.int32()),
                        pa.array([r[3] for r in every], pa.bool_()),
                    ],
                    names=["h1", "h2", "a", "b", "own"],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(RID),
                        batch.column("doc_id"),
                        pa.array(sizes, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat),
                    ],
                    names=[RID, "doc_id", "n_sentences", "runs"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    one_run = "struct<h1: long, h2: long, a: int, b: int, own: boolean>"
    return rows.mapInArrow(
        run, f"{RID} {RID_TYPE}, doc_id {kind}, n_sentences long, runs array<{one_run}>"
    )


def _cut(rows: DataFrame, kind: str) -> DataFrame:
    """Rows (doc_id, n_sentences, n_removed, text) for rows with the spans to go, null for none.

    Only texts that lose something are cut into sentences again.
    """

    def one(text: str, spans):
        plain, starts = sentences(text)
        gone = np.zeros(len(plain) + 1, np.int64)
        for s in spans:
            gone[s["a"]] += 1
            gone[s["b"] + 1] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        pieces = [text[a:b] for a, b, g in zip(starts[:-1], starts[1:], gone, strict=True) if not g]
        return int(gone.sum()), "".join(pieces).rstrip()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for start in range(0, big.num_rows, 500):
                batch = big.slice(start, 500)
                losing = pc.is_valid(batch.column("spans"))
                some = batch.filter(losing)
                pairs = zip(some.column("text"), some.column("spans"), strict=True)
                found = [one(t.as_py(), s.as_py()) for t, s in pairs]
                removed = np.zeros(batch.num_rows, np.int64)
                removed[np.asarray(losing)] = [f[0] for f in found]
                left = pa.array([f[1] for f in found], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(RID),
                        batch.column("doc_id"),
                        batch.column("n_sentences"),
                        pa.array(removed),
                        pc.replace_with_mask(batch.column("text").cast(pa.string()), losing, left),
                    ],
                    names=[RID, "doc_id", "n_sentences", "n_removed", "text"],
                )

    return rows.select(RID, "doc_id", "n_sentences", "text", "spans").mapInArrow(
        run,
        f"{RID} {RID_TYPE}, doc_id {kind}, n_sentences long, n_removed long, text string",
    )


def dedup_substrings(
    docs: DataFrame,
    run_words: int = RUN_WORDS,
    lone_words: int = LONE_WORDS,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """One row for each row of `docs`: doc_id, n_sentences, n_removed, text (what is left), _rid.

    The first place of a run is the one with the smallest doc_id (null last), then the first row,
    then the first sentence.  Sentences end at `.`, `!` or `?` before white space, at the full
    stops of other scripts and at line breaks; they are equal when identical with white space made single.  A null text stays null, an
    empty text and a text without repeats stay as they are; a text may end up empty.  Repeated rows
    count as documents of their own, so the later one loses its runs.  An empty table gives an empty
    result.  Other columns are not read.  Runs are compared by 128-bit hashes.
    """
    rows = numbered(docs, F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # Texts are cut into sentences and hashed once; both readers of the runs take what is written.
    hashed = stored(_hashed(rows, run_words, lone_words), "runs")
    spans = hashed.select(RID, "doc_id", F.explode("runs").alias("r")).select(
        F.col("r.h1").alias("h1"),
        F.col("r.h2").alias("h2"),
        F.col("r.own").alias("own"),
        F.struct("r.a", "r.b").alias("span"),
        RID,
        "doc_id",
    )
    first = (
        spans.filter("not own")
        .groupBy("h1", "h2")
        .agg(
            F.min(F.struct(*nulls_last("doc_id"), F.col(RID))).alias("first"),
            F.count(F.lit(1)).alias("n"),
        )
        .filter("n > 1")
        .select("h1", "h2", F.col(f"first.{RID}").alias("first_rid"))
    )
    # Written, so that the join below is one of two plain shuffles: Spark then splits the
    # partition of a run that very many documents share.
    first = stored(first, "runs-first")
    elsewhere = F.coalesce(F.col(RID) != F.col("first_rid"), F.lit(False))
    gone = (
        spans.drop("doc_id")
        .join(first, ["h1", "h2"], "left")
        .filter(F.col("own") | elsewhere)
        .groupBy(RID)
        .agg(F.collect_set("span").alias("spans"))
    )  # at most two spans for each sentence of the document
    kind = rows.schema["doc_id"].dataType.simpleString()
    sizes = hashed.select(RID, "n_sentences").join(gone, RID, "left")
    return _cut(rows.join(sizes, RID), kind)
