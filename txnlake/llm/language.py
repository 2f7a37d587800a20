"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of its subwords, byte runs of three and four within a word or
at its ends, hashed to a fixed number of buckets.  Embeddings and the softmax on top are trained by
stochastic gradient descent in numpy on a bounded sample of labelled rows.  Part of the sample is
held back to fit a temperature, after which a score is the chance to be right; a text whose best
score stays below `MIN_SCORE` is rejected.

Prediction needs only the product of both matrices, one row of class scores for each bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlake.llm.common import RID, RID_TYPE, byte_slices, numbered, small_batches
from txnlake.llm.words import buffers, cuts_between_words

BUCKETS = 1 << 14
DIMENSIONS = 16
PER_LANGUAGE = 600  # rows of the training sample at most, for each language
LARGEST_SAMPLE = 20_000  # all languages together, but one row for each language at least
EPOCHS = 30
BATCH = 32
RATE = 0.5
MIN_SCORE = 0.5
UNKNOWN = "und"
CHUNK_BYTES = 1 << 19
SEED = 7


@dataclass
class Model:
    """Class scores for each bucket, already divided by the temperature, and a bias."""

    languages: list[str]
    scores: np.ndarray
    bias: np.ndarray


def _letters() -> np.ndarray:
    """Byte values with all that is no letter turned into a space."""
    out = np.full(256, 0x20, np.uint8)
    out[0x61:0x7B] = np.arange(0x61, 0x7B)
    out[0x80:] = np.arange(0x80, 0x100)
    return out


LETTERS = _letters()


def subwords(data: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS):
    """Buckets of all subwords of lower-cased texts, and the text that each belongs to."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    text = np.repeat(np.arange(n), sizes)
    # A space goes between texts and at both ends.
    padded = np.full(len(data) + n + 3, 0x20, np.uint8)
    padded[np.arange(len(data)) + text + 1] = LETTERS[data]
    owner = np.repeat(np.arange(n), sizes + 1)
    b = padded.astype(np.uint32)
    letter = padded != 0x20
    m = len(data) + n
    middle = letter[1 : m + 1]
    three = b[:m] * np.uint32(0x01000193) ^ b[1 : m + 1] * np.uint32(0x9E3779B1)
    three ^= b[2 : m + 2] * np.uint32(0x85EBCA6B)
    four = (three + np.uint32(0x27D4EB2F)) ^ b[3 : m + 3] * np.uint32(0xC2B2AE35)
    at3 = np.flatnonzero(middle)
    at4 = np.flatnonzero(middle & letter[2 : m + 2])
    hashes = np.concatenate([three[at3], four[at4]])
    hashes ^= hashes >> np.uint32(15)
    hashes *= np.uint32(0x2C1B3C6D)
    owners = np.concatenate([owner[at3], owner[at4]])
    return (hashes >> np.uint32(32 - buckets.bit_length() + 1)).astype(np.int64), owners


def _chunks(texts: pa.Array):
    data, offsets = buffers(pc.utf8_lower(pc.fill_null(texts, "")))
    for a, b in byte_slices(np.diff(offsets).tolist(), CHUNK_BYTES):
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def _pieces(data: np.ndarray, offsets: np.ndarray):
    """A chunk as it is, or a long text (such a chunk has no other) in pieces between words."""
    if len(data) <= 2 * CHUNK_BYTES:
        yield data, offsets
        return
    places = cuts_between_words(data, CHUNK_BYTES)
    for a, b in zip(places[:-1], places[1:], strict=True):
        yield data[a:b], np.array([0, b - a])


def _counted(rows: DataFrame) -> DataFrame:
    """Rows (place, lang, fold, bucket[], n[]) for rows (place, lang, fold, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in _chunks(batch.column("text")):
                parts = []
                for piece, borders in _pieces(data, offsets):
                    bucket, owner = subwords(piece, borders)
                    parts.append(np.unique(owner * BUCKETS + bucket, return_counts=True))
                keys, counts = (np.concatenate(arrays) for arrays in zip(*parts, strict=True))
                key, part = np.unique(keys, return_inverse=True)
                n = np.bincount(part, counts, len(key))
                ends = np.searchsorted(key // BUCKETS, np.arange(b - a + 1))
                ends = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("place").slice(a, b - a),
                        batch.column("lang").slice(a, b - a),
                        batch.column("fold").slice(a, b - a),
                        pa.ListArray.from_arrays(ends, pa.array(key % BUCKETS, pa.int16())),
                        pa.ListArray.from_arrays(ends, pa.array(n, pa.float32())),
                    ],
                    names=["place", "lang", "fold", "bucket", "n"],
                )

    schema = "place long, lang string, fold int, bucket array<short>, n array<float>"
    return rows.select("place", "lang", "fold", "text").mapInArrow(run, schema)


class Example(NamedTuple):
    """A row of the sample: its buckets, and how many of its subwords are in each."""

    place: int
    lang: str
    fold: int
    bucket: np.ndarray
    n: np.ndarray


def _examples(sample: DataFrame) -> list[Example]:
    """The sample at the driver, six bytes for each bucket of a row."""
    out = []
    for batch in sample.toArrow().to_batches():
        plain = (batch.column(name).to_pylist() for name in ("place", "lang", "fold"))
        lists = (batch.column("bucket"), batch.column("n"))
        values = [np.asarray(c.values) for c in lists]
        starts = [np.asarray(c.offsets) for c in lists]
        for i, row in enumerate(zip(*plain, strict=True)):
            out.append(Example(*row, *(v[s[i] : s[i + 1]] for v, s in zip(values, starts, strict=True))))
    return sorted(out, key=lambda e: (e.place, e.lang))


def _softmax(scores: np.ndarray) -> np.ndarray:
    out = np.exp(scores - scores.max(axis=1, keepdims=True))
    return out / out.sum(axis=1, keepdims=True)


def train(rows: list[Example], languages: list[str]) -> Model:
    """Fit embeddings, softmax and temperature to the rows of a sample."""
    rng = np.random.default_rng(SEED)
    k = len(languages)
    embed = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weight = rng.normal(0, 0.1, (DIMENSIONS, k)).astype(np.float32)
    bias = np.zeros(k, np.float32)
    target = np.array([languages.index(r.lang) for r in rows])
    held = np.array([r.fold == 0 for r in rows])
    if held.all() or not held.any():
        held[:] = False

    def dense(chosen):
        x = np.zeros((len(chosen), BUCKETS), np.float32)
        for i, j in enumerate(chosen):
            n = rows[j].n
            x[i, rows[j].bucket] = n / max(n.sum(), 1)
        return x

    learn = np.flatnonzero(~held)
    steps, done = max(1, EPOCHS * -(-len(learn) // BATCH)), 0
    for _ in range(EPOCHS):
        rng.shuffle(learn)
        for i in range(0, len(learn), BATCH):
            chosen = learn[i : i + BATCH]
            x, rate = dense(chosen), RATE * (1 - done / steps)
            done += 1
            hidden = x @ embed
            error = _softmax(hidden @ weight + bias)
            error[np.arange(len(chosen)), target[chosen]] -= 1
            error /= len(chosen)
            back = error @ weight.T
            weight -= rate * (hidden.T @ error)
            bias -= rate * error.sum(axis=0)
            # A mean of many subwords moves each embedding little: its step is larger.
            embed -= 50 * rate * (x.T @ back)

    scores = embed @ weight
    known = np.flatnonzero(held) if held.any() else learn
    raw = np.concatenate(
        [dense(known[i : i + 256]) @ scores + bias for i in range(0, len(known), 256)]
    )
    truth = target[known]

    def loss(t):
        return -np.log(_softmax(raw / t)[np.arange(len(truth)), truth] + 1e-12).mean()

    t = min(np.geomspace(0.1, 10, 81), key=loss)
    return Model(languages, (scores / t).astype(np.float32), (bias / t).astype(np.float32))


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def learnable(doc_id: Column) -> Column:
    return F.coalesce(remainder(doc_id) != 2, F.lit(False))


def fit(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang"
) -> Model | None:
    """A model from the rows whose id allows it; None where no such row has a language.

    Of each language min(PER_LANGUAGE, LARGEST_SAMPLE / languages) rows are taken, those with the
    smallest hashes of id and text, whatever the size and order of the table; all rows of a language
    that has fewer.  Rows alike in id and text count once.
    """
    rows = small_batches(docs).select(
        F.col(text).alias("text"),
        F.col(lang).alias("lang"),
        F.xxhash64(F.lit(SEED), F.col(doc_id), F.col(text)).alias("place"),
        learnable(F.col(doc_id)).alias("usable"),
    ).filter("usable and lang is not null and text is not null")
    sample = _examples(_counted(_sampled(rows.drop("usable"))))
    if not sample:
        return None
    return train(sample, sorted({r.lang for r in sample}))


def _sampled(rows: DataFrame) -> DataFrame:
    """The rows (lang, place, fold, text) of the sample, from rows (lang, place, text).

    More than enough rows are drawn by their hash, so that only these have to be ranked.
    """
    rows = rows.withColumn("at", F.shiftrightunsigned("place", 11))
    seen = (
        rows.groupBy("lang")
        .agg(F.approx_count_distinct("place").alias("n"), F.min("at").alias("least"))
        .collect()
    )  # one entry for each language
    each = max(1, min(PER_LANGUAGE, LARGEST_SAMPLE // max(1, len(seen))))
    enough = 1.5 * each + 50  # the number of rows is known to a few hundredths
    cuts = [
        (r.lang, max(r.least, int(min(1.0, enough / max(1, r.n)) * (1 << 53)))) for r in seen
    ]
    cuts = rows.sparkSession.createDataFrame(cuts, "lang string, cut long")
    drawn = rows.join(F.broadcast(cuts), "lang").filter("at <= cut")
    order = Window.partitionBy("lang").orderBy("at", "place")
    ranked = drawn.dropDuplicates(["lang", "place"]).withColumn("rank", F.row_number().over(order))
    # The first row of a language is never held back: each language is learned.
    fold = F.when(F.col("rank") == 1, 1).otherwise(F.pmod("place", F.lit(5))).cast("int")
    return ranked.filter(F.col("rank") <= each).select("place", "lang", fold.alias("fold"), "text")


def _judged(model: Model, texts: pa.Array, readable: pa.Array):
    """For row ranges: number of the language and score."""
    for a, b, data, offsets in _chunks(texts):
        total, n = np.zeros((b - a, len(model.languages))), np.zeros(b - a, np.int64)
        for piece, borders in _pieces(data, offsets):
            bucket, owner = subwords(piece, borders)
            for i in range(len(model.languages)):
                total[:, i] += np.bincount(owner, model.scores[bucket, i], b - a)
            n += np.bincount(owner, minlength=b - a)
        chance = _softmax(total / np.maximum(n, 1)[:, None] + model.bias)
        own = np.asarray(readable.slice(a, b - a))
        best = np.where(own, chance.argmax(axis=1), len(model.languages))
        yield a, b, best, np.where(own, chance.max(axis=1), 0.0)


def _readable(text: str) -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("readable")


def predict(
    docs: DataFrame, model: Model | None, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """One row for each row of `docs`: doc_id, lang_pred, score, rejected, _rid.

    A null text, or one without a letter, is `und` with score 0 and rejected; so is every text
    when there is no model.  Other texts get the most likely language; they are rejected when its
    score is below MIN_SCORE.  Only the text is looked at, whole; repeated rows are treated alike.
    An empty table gives an empty result.
    """
    rows = numbered(
        docs,
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("text"),
        _readable(text),
    )
    if model is None:
        return rows.select(
            "doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
            F.lit(True).alias("rejected"), RID,
        )
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x languages numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*shared.value.languages, UNKNOWN], object)
        for batch in batches:
            for a, b, best, score in _judged(shared.value, batch.column("text"), batch.column("readable")):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(RID).slice(a, b - a),
                        batch.column("doc_id").slice(a, b - a),
                        pa.array(names[best], pa.string()),
                        pa.array(score),
                    ],
                    names=[RID, "doc_id", "lang_pred", "score"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"{RID} {RID_TYPE}, doc_id {kind}, lang_pred string, score double")
    rejected = (F.col("lang_pred") == UNKNOWN) | (F.col("score") < MIN_SCORE)
    return out.select("doc_id", "lang_pred", "score", rejected.alias("rejected"), RID)


def known_rows(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang"):
    """The rows of `docs` that `predict` does not reject, with all their columns.

    Rows pass through the task that judges them; nothing is shuffled.
    """
    model = fit(docs, text, doc_id, lang)
    if model is None:
        return docs.limit(0)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct("*").alias("row"), _readable(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.struct_field(batch.column("row"), [text])
            for a, b, best, score in _judged(shared.value, texts, batch.column("readable")):
                told = (best < len(shared.value.languages)) & (score >= MIN_SCORE)
                own = batch.column("row").slice(a, b - a).filter(pa.array(told))
                yield pa.RecordBatch.from_arrays([own], names=["row"])

    kept = rows.mapInArrow(run, T.StructType([rows.schema["row"]]))
    return kept.select("row.*")
