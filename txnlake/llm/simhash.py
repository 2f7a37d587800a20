"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within the radius have a common variant within half the radius of each.  A
fingerprint therefore emits all its variants within half the radius, and equal variants meet.  The
shuffle carries them factored: variants of the first bits are rows of the shuffle, one for each
prefix within half the radius, and the task that gets a prefix makes the variants of the other
bits with what is left of the radius.  That moves 56 rows for a fingerprint instead of 2,081 at 64 bits
and radius 4, and a task holds one prefix group at a time.  A group that would make too many variants,
as near copies without end do, is shuffled once more by a longer prefix.

Fingerprints that share a variant are all within the radius of each other, so a star of links stands
for the group; each task reduces its links to a forest.  Only distinct fingerprints take part; equal
ones are linked anyway.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import RID, RID_TYPE, numbered, nulls_last, rows_of, stored
from txnlake.llm.components import components

SHINGLE = 4
RADIUS = 4
SEED = 42
BITS = 64
LEAST_PREFIX = 10
PREFIX_ROWS = 1024  # distinct fingerprints for each prefix value, on average
MORE_BITS = 6  # of prefix, for a group that is too large
GROUP_VARIANTS = 50_000_000  # made by the task of one group; on average it is some millions
ROW_VARIANTS = 64  # a row counts as so many at least, which bounds the rows of a group
BLOCK_VARIANTS = 2_000_000


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles, repeats included: bits set in over half their hashes."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes).tolist()
    n = len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest
    runs = zip(starts, ends[shingle - 1 :].tolist(), strict=False)
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in runs), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for i in range(0, n, 1 << 16):
        rows = hashes[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(rows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Rows (_rid, doc_id, fp) for rows (_rid, doc_id, text); fp is signed."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            found = (fingerprint(t.as_py() or b"", shingle) for t in texts)
            fps = np.fromiter(found, np.uint64, len(texts)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(RID), batch.column("doc_id"), pa.array(fps)],
                names=[RID, "doc_id", "fp"],
            )

    return rows.mapInArrow(run, f"{RID} {RID_TYPE}, doc_id {kind}, fp long")


def ball(bits: int, radius: int) -> list[tuple[int, int]]:
    """(mask, number of bits) of all masks of up to `radius` bits, few bits first."""
    return [
        (sum(1 << i for i in chosen), size)
        for size in range(radius + 1)
        for chosen in itertools.combinations(range(bits), size)
    ]


def _variants(fps: np.ndarray, left: np.ndarray, bits: int):
    """Blocks of (variant, index of the fingerprint); equal variants come in the same block.

    A block too large is cut by four more bits, as the shuffle cuts by the first ones.
    """
    sizes = [sum(math.comb(bits, k) for k in range(r + 1)) for r in range(int(left.max()) + 1)]
    many = sum(int((left == r).sum()) * size for r, size in enumerate(sizes))
    if many > BLOCK_VARIANTS and bits >= 8:
        part = (fps >> np.uint64(bits - 4)) & np.uint64(15)
        for value in range(16):
            cost = np.bitwise_count(part ^ np.uint64(value)).astype(np.int64)
            near = np.flatnonzero(cost <= left)
            if len(near) > 1:
                for block, at in _variants(fps[near], left[near] - cost[near], bits - 4):
                    yield block, near[at]
        return
    low = fps & np.uint64((1 << bits) - 1)
    masks = np.array([m for m, _ in ball(bits, len(sizes) - 1)], np.uint64)
    values, owners = [], []
    for r, size in enumerate(sizes):
        own = np.flatnonzero(left == r)
        values.append((low[own][:, None] ^ masks[:size][None, :]).ravel())
        owners.append(np.repeat(own, size))
    yield np.concatenate(values), np.concatenate(owners)


def _forest(pairs: np.ndarray, n: int) -> list[tuple[int, int]]:
    """The pairs that join two trees."""
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for a, b in pairs.tolist():
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept


def links_of_group(fps: np.ndarray, left: np.ndarray, bits: int, radius: int):
    """Index pairs of fingerprints that share a variant: enough to connect all that do."""
    kept = np.zeros((0, 2), np.int64)
    for values, owners in _variants(fps, left, bits):
        order = np.argsort(values, kind="stable")
        values, owners = values[order], owners[order]
        fresh = np.r_[True, values[1:] != values[:-1]]
        heads = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
        pairs = np.stack([owners[heads], owners], 1)[~fresh]
        pairs = np.unique(np.r_[kept, pairs[pairs[:, 0] != pairs[:, 1]]], axis=0)
        apart = np.bitwise_count(fps[pairs[:, 0]] ^ fps[pairs[:, 1]])
        verified = pairs[apart <= radius]
        kept = np.array(_forest(verified, len(fps)), np.int64).reshape(-1, 2)
    return kept


def _lengthened(rows: DataFrame, used: int, step: int, reach: int) -> DataFrame:
    """Rows (prefix, fp, left): prefixes of `used` bits get `step` more, with all their variants."""
    masks = F.array(
        *[F.struct(F.lit(m).cast("long").alias("m"), F.lit(k).alias("k"))
          for m, k in ball(step, reach)]
    )
    fitting = F.filter(masks, lambda x: x["k"] <= F.col("left"))
    own = F.shiftrightunsigned("fp", BITS - used - step).bitwiseAND(F.lit((1 << step) - 1))
    return rows.select("prefix", "fp", "left", F.explode(fitting).alias("x")).select(
        F.shiftleft("prefix", step).bitwiseOR(own.bitwiseXOR(F.col("x.m"))).alias("prefix"),
        "fp",
        (F.col("left") - F.col("x.k")).alias("left"),
    )


def _large_prefixes(rows: DataFrame, rest: int, reach: int, most: int) -> DataFrame:
    """The prefixes whose groups would make more than `most` variants of the other bits."""
    sizes = [sum(math.comb(rest, k) for k in range(r + 1)) for r in range(reach + 1)]
    costs = F.array(*[F.lit(max(size, ROW_VARIANTS)).cast("long") for size in sizes])
    cost = F.sum(F.element_at(costs, F.col("left") + 1)).alias("cost")
    return rows.groupBy("prefix").agg(cost).filter(F.col("cost") > most).select("prefix")


def _linked(rows: DataFrame, rest: int, radius: int) -> DataFrame:
    """Links (u, v) within the groups of equal prefix."""

    def run(group: pa.Table) -> pa.Table:
        fps = group.column("fp").to_numpy().view(np.uint64)
        left = group.column("left").to_numpy().astype(np.int64)
        pairs = links_of_group(fps, left, rest, radius)
        ends = fps.view(np.int64)[pairs]
        return pa.table({"u": ends.min(axis=1), "v": ends.max(axis=1)})

    return rows.groupBy("prefix").applyInArrow(run, "u long, v long")


def links(
    nodes: DataFrame, radius: int = RADIUS, group_variants: int = GROUP_VARIANTS
) -> DataFrame:
    """Pairs (u, v) of fingerprints within the radius, for distinct rows (fp).

    Not every pair, but enough to connect all that such pairs connect.  `group_variants` bounds the
    work of one group; the pairs connect the same whatever it is.
    """
    if radius % 2:
        raise ValueError("the radius has to be even: its halves meet in the middle")
    reach = radius // 2
    n = nodes.count()
    step = max(LEAST_PREFIX, math.ceil(math.log2(max(n, 1) / PREFIX_ROWS))) if n else LEAST_PREFIX
    rows = nodes.select(F.lit(0).cast("long").alias("prefix"), "fp", F.lit(reach).alias("left"))
    used, found = 0, None
    while True:
        rows, used = _lengthened(rows, used, step, reach), used + step
        rest = BITS - used
        large = stored(_large_prefixes(rows, rest, reach, group_variants), "large-prefixes")
        # A group of equal whole variants has no more rows than the ball has variants.
        last = rest == 0 or large.isEmpty()
        own = _linked(rows if last else rows.join(large, "prefix", "left_anti"), rest, radius)
        found = own if found is None else found.unionByName(own)
        if last:
            return found.distinct()
        rows = stored(rows.join(large, "prefix", "left_semi"), "large-groups")
        step = min(MORE_BITS, rest)


def simhash(
    docs: DataFrame,
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """One row for each row of `docs`: doc_id, fp, component_id, kept, _rid.

    Rows whose fingerprints differ in at most `radius` bits are linked; component_id is the
    smallest doc_id reachable, null where all ids are.  The first row with that id is kept (of rows
    without ids the first one).  Null and empty texts have fingerprint zero and are linked like
    others; a text of fewer words is one shingle.  Equal rows are linked and one is kept.  An empty
    table gives an empty result.  Other columns are not read.
    """
    rows = numbered(docs, F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    marked = stored(fingerprints(rows, shingle), "fingerprints")
    first = F.min(F.struct(*nulls_last("doc_id"), F.col(RID)))
    nodes = stored(marked.groupBy("fp").agg(first.alias("first")), "fingerprint-nodes")
    roots = components(links(nodes.select("fp"), radius))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    heads = rooted.groupBy("root").agg(F.min("first").alias("head"))
    classes = stored(rooted.join(heads, "root").select("fp", "head"), "fingerprint-classes")
    return marked.join(classes, "fp").select(
        "doc_id",
        "fp",
        F.col("head.doc_id").alias("component_id"),
        (F.col(RID) == F.col(f"head.{RID}")).alias("kept"),
        RID,
    )


def kept_rows(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **parameters):
    """The rows of `docs` that stay, one of each component, with all their columns."""
    return rows_of(docs, simhash(docs, text=text, doc_id=doc_id, **parameters).filter("kept"))
