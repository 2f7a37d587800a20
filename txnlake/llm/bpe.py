"""Byte-level BPE by merge replay over a block of texts.

Words do not influence each other, so the distinct words of many texts are encoded together: an
inverted index leads from the rank of a token pair to the places where the pair stands in any word.
Ranks are taken from low to high; one merge is applied at all its places at once, and only the pairs
with the touched neighbours are looked up again and filed.  Texts are then put together from the
tokens of their words.  A block is bounded in bytes; words met before are remembered, up to a bound.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import RID, RID_TYPE, byte_slices, numbered

BLOCK_BYTES = 4 << 20
REMEMBERED = 200_000  # words
OUT_TOKENS = 1_000_000  # of a batch that leaves a task


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a rank file: base64 of the token, a space, the rank."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


class Merges:
    """Vocabulary tables: token bytes, and the rank that each mergeable pair of tokens has."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        tokens: list[bytes] = [b""] * self.size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.r_[0, np.cumsum(self.lengths)[:-1]]
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = rank
        order = np.array(sorted(pairs), np.int64)
        self.pairs = order
        self.merged = np.array([pairs[k] for k in order.tolist()], np.int64)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it has none."""
        key = left * self.size + right
        at = np.searchsorted(self.pairs, key)
        at[at == len(self.pairs)] = 0
        return np.where(self.pairs[at] == key, self.merged[at], -1)


def replay(merges: Merges, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all words, one after the other, and where each word's tokens begin."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes)
    total = int(sizes.sum())
    token = merges.of_byte[np.frombuffer(b"".join(words), np.uint8)]
    after = np.arange(1, total + 1)
    after[ends[sizes > 0] - 1] = -1
    before = np.arange(-1, total - 1)
    before[(ends - sizes)[sizes > 0]] = -1
    alive = np.ones(total, bool)
    rank_at = np.full(total, -1, np.int64)  # rank of the pair that begins here
    index: dict[int, list[np.ndarray]] = {}
    waiting: list[int] = []

    def file(places: np.ndarray) -> None:
        ranks = rank_at[places]
        order = np.argsort(ranks, kind="stable")
        places, ranks = places[order], ranks[order]
        cuts = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]])
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(ranks)], strict=True):
            rank = int(ranks[a])
            if rank not in index:
                index[rank] = []
                heapq.heappush(waiting, rank)
            index[rank].append(places[a:b])

    pairs = np.flatnonzero(after >= 0)
    rank_at[pairs] = merges.rank_of(token[pairs], token[after[pairs]])
    pairs = pairs[rank_at[pairs] >= 0]
    if len(pairs):
        file(pairs)
    while waiting:
        rank = heapq.heappop(waiting)
        found = index.pop(rank)
        places = found[0] if len(found) == 1 else np.concatenate(found)
        places = np.unique(places[rank_at[places] == rank])
        if not len(places):
            continue
        # Of places that overlap, as in a a a, the left ones merge: every other of a run.
        if len(places) > 1:
            linked = np.r_[False, after[places[:-1]] == places[1:]]
            if linked.any():
                at = np.arange(len(places))
                first = np.maximum.accumulate(np.where(linked, 0, at))
                places = places[(at - first) % 2 == 0]
        right = after[places]
        beyond = after[right]
        token[places] = rank
        after[places] = beyond
        inner = beyond >= 0
        before[beyond[inner]] = places[inner]
        alive[right] = False
        rank_at[right] = -1
        left = before[places]
        touched = np.concatenate([places, left[left >= 0]])
        rank_at[touched] = -1
        touched = touched[after[touched] >= 0]
        rank_at[touched] = merges.rank_of(token[touched], token[after[touched]])
        touched = touched[rank_at[touched] >= 0]
        if len(touched):
            file(touched)
    kept = np.r_[0, np.cumsum(alive)]
    return token[alive], kept[np.r_[0, ends]]


class Encoder:
    """Encodes blocks of texts; remembers the tokens of words."""

    def __init__(self, merges: Merges, pattern: str):
        self.merges = merges
        self.pattern = regex.compile(pattern)
        self.forget()

    def forget(self) -> None:
        self.places = _Places()
        self.tokens = np.zeros(0, np.int32)
        self.starts = np.zeros(1, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts, one after the other, and where each text's ids begin."""
        if len(self.places) > REMEMBERED:
            self.forget()
        known, places = len(self.places), self.places
        found = [
            np.array([places[w] for w in self.pattern.findall(text)], np.int64) for text in texts
        ]
        fresh = [w.encode() for w in list(places)[known:]]
        self._learn(fresh)
        every = np.concatenate([np.zeros(0, np.int64), *found])
        sizes = np.diff(self.starts)[every]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[every] - (ends - sizes), sizes) + np.arange(sizes.sum())
        counts = np.cumsum([len(f) for f in found])
        return self.tokens[at], np.r_[0, np.r_[0, ends][counts]]

    def _learn(self, words: list[bytes]) -> None:
        """Tokens of new words: a word that is a token as it stands, or its replayed merges."""
        whole = [self.merges.ranks.get(w, -1) for w in words]
        rest = [w for w, rank in zip(words, whole, strict=True) if rank < 0]
        tokens, starts = replay(self.merges, rest)
        whole = np.array(whole, np.int64)
        sizes = np.ones(len(words), np.int64)
        sizes[whole < 0] = np.diff(starts)
        out = np.empty(int(sizes.sum()), np.int32)
        is_whole = np.repeat(whole >= 0, sizes)
        out[is_whole] = whole[whole >= 0]
        out[~is_whole] = tokens
        self.tokens = np.r_[self.tokens, out]
        self.starts = np.r_[self.starts, self.starts[-1] + np.cumsum(sizes)]


class _Places(dict):
    """Numbers words in the order in which they are first met."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def decode_ids(merges: Merges, ids: np.ndarray) -> np.ndarray:
    """Bytes of all tokens, one after the other."""
    sizes = merges.lengths[ids]
    ends = np.cumsum(sizes)
    at = np.repeat(merges.starts[ids] - (ends - sizes), sizes) + np.arange(sizes.sum())
    return merges.bytes[at]


def encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    text: str = "text",
    doc_id: str = "doc_id",
    decoded: bool = False,
) -> DataFrame:
    """One row for each row of `docs`: doc_id, ids (array of int), _rid.

    With `decoded` also the bytes that the ids decode to, made in the same task: `decode` does the
    same for stored ids, but after `encode` it would be a second Python worker with a second copy of
    the vocabulary beside the first.

    Every match of the pattern is encoded by itself, as ordinary text: no special tokens.  Null
    and empty texts have no ids.  Repeated rows are treated alike; an empty table gives an empty
    result; other columns are not read.  `ranks` is a vocabulary, broadcast to the tasks.
    """
    rows = numbered(docs, F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(Merges(ranks))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value, pattern)
        for batch in batches:
            column = batch.column("text")
            sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
            for a, b in byte_slices(sizes, BLOCK_BYTES):
                texts = [t or "" for t in column.slice(a, b - a).to_pylist()]
                ids, starts = encoder.encode(texts)
                for x, y in byte_slices(np.diff(starts).tolist(), OUT_TOKENS):
                    own = pa.array(ids[starts[x] : starts[y]], pa.int32())
                    ends = starts[x : y + 1] - starts[x]
                    columns = {
                        RID: batch.column(RID).slice(a + x, y - x),
                        "doc_id": batch.column("doc_id").slice(a + x, y - x),
                        "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), own),
                    }
                    if decoded:
                        columns["decoded"] = _decoded(shared.value, ids[starts[x] : starts[y]], ends)
                    yield pa.RecordBatch.from_pydict(columns)
        # What is kept for the next batch would stay with the worker through later stages.
        pa.default_memory_pool().release_unused()

    schema = f"{RID} {RID_TYPE}, doc_id {kind}, ids array<int>"
    out = rows.mapInArrow(run, f"{schema}, decoded binary" if decoded else schema)
    return out.select("doc_id", "ids", *(["decoded"] if decoded else []), RID)


def _decoded(merges: Merges, ids: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Bytes of each text, for the ids of texts that begin at `starts`."""
    ends = np.r_[0, np.cumsum(merges.lengths[ids])][starts].astype(np.int32)
    data = decode_ids(merges, ids)
    return pa.Array.from_buffers(
        pa.binary(), len(starts) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)]
    )


def decode(rows: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """`rows` (doc_id, ids, _rid) with the decoded bytes of the ids added."""
    shared = rows.sparkSession.sparkContext.broadcast(Merges(ranks))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("ids")
            starts = np.asarray(column.offsets, np.int64)
            for a, b in byte_slices(np.diff(starts).tolist(), OUT_TOKENS):
                ids = np.asarray(column.values)[starts[a] : starts[b]]
                texts = _decoded(shared.value, ids, starts[a : b + 1] - starts[a])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(a, b - a) for c in ("doc_id", "ids", RID)), texts],
                    names=["doc_id", "ids", RID, "decoded"],
                )

    return rows.select("doc_id", "ids", RID).mapInArrow(
        run, f"doc_id {kind}, ids array<int>, {RID} {RID_TYPE}, decoded binary"
    )


def digests(rows: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of rows (doc_id, ids, decoded)."""
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
