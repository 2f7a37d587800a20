"""Prefix trie of conversations by the Euler-tour technique.

Four parts, none of which needs a whole conversation, a whole list of children or the whole tour in
one task:

1. Prefixes.  Turns are sorted over the cluster by conversation and place.  A prefix is known by its
   depth and by the XOR of hashes of (place, turn), 2 x 64 bits, a running value that can be
   taken up where the part before has stopped.  Equal prefixes are one node.
2. Arcs.  Each node gets an arc that enters it and one that leaves it.  Nodes are sorted once more,
   each behind its parent, siblings by conversation: the row that follows names the next arc.
3. List ranking.  Nodes are numbered by conversation, so most arcs lead to a node near by.  Blocks of
   numbers contract the stretches of the tour within them to one element each; blocks of blocks go on
   until one stretch is left, and the sums before each element are handed back down.  Where a block
   would get too large, neighbours are first merged in pairs that a coin chooses.
4. Sums.  The tour's running sums of nodes, leaves and savings, taken at both arcs of a node, give
   the totals of its subtree as their difference.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnlake.llm.common import RID, numbered, stored

BLOCK_NODES = 100_000
BLOCK_ELEMENTS = 500_000
FAN = 16
MOST_TAKEN = 8
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
UNKNOWN = -2  # what the next or the last partition has to say

KEY = ["depth", "k1", "k2"]
WEIGHTS = ["nodes", "leaves", "saved"]


def _xor(one: Column | str, other: Column | str) -> Column:
    one, other = (F.col(c) if isinstance(c, str) else c for c in (one, other))
    return one.bitwiseXOR(other)


def _sorted(rows: DataFrame, order: list, label: str) -> DataFrame:
    """`rows` sorted over the cluster and stored, with partition p and place i in it."""
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return stored(ranged.select("*", F.spark_partition_id().alias("p"), place.alias("i")), label)


def _by_partition(df: DataFrame, rows: list[tuple], ddl: str) -> DataFrame:
    """`df` with values for each of its partitions p: as many rows as there are partitions."""
    small = df.sparkSession.createDataFrame(rows, f"p int, {ddl}")
    return df.join(F.broadcast(small), "p")


def _turn_hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "depth", "h1", "h2")


def prefixes(
    turns: DataFrame,
    donor: Column | None = None,
    taken: Column | None = None,
    most_taken: int = MOST_TAKEN,
) -> DataFrame:
    """Rows (conv, depth, k1, k2, x1, x2, bytes, ends): every prefix of every conversation.

    `turns` has (conv, turn, role, text).  A conversation may begin with the first `taken` turns of
    another one, `donor`, in place of as many of its own; both are columns of `conv`, and `taken` is
    at most `most_taken`.  k1 and k2 tell a prefix, x1 and x2 its last turn at that depth, `bytes`
    are those of the last text, and `ends` says that the conversation has no more turns.
    """
    content = [F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))]
    slim = numbered(
        turns.filter(F.col("conv").isNotNull()),
        "conv",
        "turn",
        F.xxhash64(F.lit(1), *content).alias("h1"),
        F.xxhash64(F.lit(2), *content).alias("h2"),
        F.octet_length(content[1]).cast("long").alias("bytes"),
    )
    order = ["conv", F.col("turn").asc_nulls_first(), "h1", "h2", RID]
    rows = _sorted(slim, order, "trie-turns").select("p", "i", "conv", "h1", "h2", "bytes")

    # The rows of a conversation in each partition, and how many come before.
    parts = rows.groupBy("p", "conv").agg(F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy("conv").orderBy("p")
    before = F.sum("n").over(own.rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(
        "p",
        "conv",
        F.coalesce(before, F.lit(0)).alias("before"),
        F.sum("n").over(Window.partitionBy("conv")).alias("n_own"),
        F.count(F.lit(1)).over(Window.partitionBy("conv")).alias("n_parts"),
    )
    parts = stored(parts, "trie-parts")

    convs = parts.filter("before = 0").select(
        "conv",
        "n_own",
        (F.lit(None).cast("long") if donor is None else donor).alias("donor"),
        (F.lit(0) if taken is None else taken).cast("long").alias("taken"),
    )
    first = F.row_number().over(Window.partitionBy("conv").orderBy("p", "i"))
    wanted = convs.select(F.col("donor").alias("conv")).distinct()
    heads = (
        rows.withColumn("depth", first)
        .filter(F.col("depth") <= most_taken)  # tasks cut a conversation before it is shuffled
        .join(wanted, "conv")
        .withColumn("depth", F.col("depth").cast("long"))
        .select("conv", "depth", "bytes", _turn_hash(1).alias("x1"), _turn_hash(2).alias("x2"))
        .groupBy(F.col("conv").alias("donor"))
        .agg(F.array_sort(F.collect_list(F.struct("depth", "x1", "x2", "bytes"))).alias("head"))
    )  # of at most `most_taken` turns

    def head_key(x: str, depth: Column) -> Column:
        return F.aggregate(
            F.slice("head", F.lit(1), depth.cast("int")),
            F.lit(0).cast("long"),
            lambda total, turn: total.bitwiseXOR(turn[x]),
        )

    convs = convs.join(heads, "donor", "left").select(
        "conv",
        "n_own",
        "taken",
        F.coalesce("head", F.array().cast("array<struct<depth:long,x1:long,x2:long,bytes:long>>"))
        .alias("head"),
    )
    used = F.least("taken", F.size("head").cast("long"))
    convs = stored(
        convs.withColumn("used", used).select(
            "*",
            head_key("x1", F.col("used")).alias("k1"),
            head_key("x2", F.col("used")).alias("k2"),
            (F.col("used") + F.greatest(F.col("n_own") - F.col("taken"), F.lit(0))).alias("total"),
        ),
        "trie-conversations",
    )

    # A hot conversation is in many partitions, each of which meets its own row of `info`.
    info = parts.join(
        convs.select("conv", "taken", "used", "total", "k1", "k2"), "conv"
    ).drop("n_own", "n_parts")
    within = Window.partitionBy("p", "conv").orderBy("i")
    running = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    later = (
        rows.join(info, ["p", "conv"])
        .withColumn("at", F.col("before") + F.row_number().over(within))
        .filter(F.col("at") > F.col("taken"))
        .withColumn("depth", F.col("used") + F.col("at") - F.col("taken"))
        .select("*", _turn_hash(1).alias("x1"), _turn_hash(2).alias("x2"))
        .select(
            "p",
            "conv",
            "depth",
            _xor("k1", F.bit_xor("x1").over(running)).alias("k1"),
            _xor("k2", F.bit_xor("x2").over(running)).alias("k2"),
            "x1",
            "x2",
            "bytes",
            (F.col("depth") == F.col("total")).alias("ends"),
        )
    )
    later = stored(later, "trie-later")
    # What earlier partitions add: a conversation in several is the first or last in each of
    # them, so there are two rows for each partition at most.
    spread = parts.filter("n_parts > 1").select("p", "conv")
    added = (
        later.join(F.broadcast(spread), ["p", "conv"])
        .groupBy("p", "conv")
        .agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
        .select(
            "p",
            "conv",
            F.bit_xor("x1").over(own.rowsBetween(Window.unboundedPreceding, -1)).alias("a1"),
            F.bit_xor("x2").over(own.rowsBetween(Window.unboundedPreceding, -1)).alias("a2"),
        )
    )
    zero = F.lit(0).cast("long")
    later = later.join(F.broadcast(added), ["p", "conv"], "left").select(
        "conv",
        "depth",
        _xor("k1", F.coalesce("a1", zero)).alias("k1"),
        _xor("k2", F.coalesce("a2", zero)).alias("k2"),
        "x1",
        "x2",
        "bytes",
        "ends",
    )
    depths = F.explode(F.sequence(zero, F.col("used"))).alias("depth")
    turn = F.get("head", F.col("depth").cast("int") - 1)
    given = convs.select("conv", "total", "head", depths).select(
        "conv",
        "depth",
        head_key("x1", F.col("depth")).alias("k1"),
        head_key("x2", F.col("depth")).alias("k2"),
        F.coalesce(turn["x1"], zero).alias("x1"),
        F.coalesce(turn["x2"], zero).alias("x2"),
        F.coalesce(turn["bytes"], zero).alias("bytes"),
        (F.col("depth") == F.col("total")).alias("ends"),
    )
    return later.unionByName(given)


def _joined_ids(rows: DataFrame) -> DataFrame:
    """Rows (depth, k1, k2, first, ids): stretches of sorted ids, joined by commas."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [np.asarray(batch.column(name)) for name in KEY]
            new = np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0)]
            starts = np.flatnonzero(new)
            conv = batch.column("conv").to_pylist()
            ends = [*starts[1:].tolist(), len(conv)]
            texts = [
                ",".join(map(str, conv[a:b])) for a, b in zip(starts.tolist(), ends, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(k[starts]) for k in keys), batch.column("conv").take(pa.array(starts)),
                 pa.array(texts, pa.string())],
                names=[*KEY, "first", "ids"],
            )

    return rows.select(*KEY, "conv").mapInArrow(
        run, "depth long, k1 long, k2 long, first long, ids string"
    )


def _digests(ends: DataFrame) -> DataFrame:
    """Rows (depth, k1, k2, sha) for rows (depth, k1, k2, conv): SHA-256 of the sorted ids.

    The ids of a node go through one digest, as they must, but in stretches, never as one value.
    """
    order = [*KEY, "conv"]
    pieces = _joined_ids(ends.repartitionByRange(*order).sortWithinPartitions(*order))
    placed = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        done: list[tuple] = []

        def out():
            columns = [*zip(*done, strict=True)] or [[], [], [], []]
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[*KEY, "sha"]
            )

        for batch in batches:
            keys = zip(*(batch.column(name).to_pylist() for name in KEY), strict=True)
            for own, ids in zip(keys, batch.column("ids").to_pylist(), strict=True):
                if own == key:
                    digest.update(b",")
                else:
                    if key is not None:
                        done.append((*key, digest.hexdigest()))
                    key, digest = own, hashlib.sha256()
                digest.update(ids.encode())
            yield out()
            done = []
        if key is not None:
            done.append((*key, digest.hexdigest()))
            yield out()

    return placed.mapInArrow(run, "depth long, k1 long, k2 long, sha string")


def _numbered_nodes(rows: DataFrame) -> tuple[DataFrame, int]:
    """Nodes with numbers in order of (conv, depth), and how many there are; the root is 0."""
    nodes = rows.groupBy(*KEY).agg(
        F.min("conv").alias("conv"),
        F.count(F.lit(1)).alias("n_convs"),
        F.min("x1").alias("x1"),
        F.min("x2").alias("x2"),
        F.min("bytes").alias("bytes"),
    )
    ended = _digests(rows.filter("ends").select(*KEY, "conv"))
    nodes = _sorted(nodes.join(ended, KEY, "left"), ["conv", "depth"], "trie-nodes")
    counts = sorted(map(tuple, nodes.groupBy("p").count().collect()))  # one for each partition
    starts = np.cumsum([0, *(n for _, n in counts)]).tolist()
    offsets = [(p, start) for (p, _), start in zip(counts, starts[:-1], strict=True)]
    nodes = _by_partition(nodes, offsets, "start long")
    return nodes.withColumn("id", F.col("start") + F.col("i")).drop("p", "i", "start"), starts[-1]


def _links(nodes: DataFrame) -> DataFrame:
    """Rows (kind, id, conv, saved, lead, parent, parent_conv), two for each node but the root.

    Kind 0 stands for the node as a parent, and `lead` is its first child; kind 1 for the node as a
    child, and `lead` is its next sibling.  -1 where there is none.
    """
    saved = (F.col("n_convs") - 1) * F.col("bytes")
    as_parent = nodes.select(*KEY, F.lit(0).alias("kind"), "conv", "id", saved.alias("saved"))
    as_child = nodes.filter("depth > 0").select(
        (F.col("depth") - 1).alias("depth"),
        _xor("k1", "x1").alias("k1"),
        _xor("k2", "x2").alias("k2"),
        F.lit(1).alias("kind"),
        "conv",
        "id",
        F.lit(0).cast("long").alias("saved"),
    )
    order = [*KEY, "kind", "conv"]
    rows = as_parent.unionByName(as_child).repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["p", "kind", "id", "conv", "saved"]
        held = None
        place, head, head_conv = 0, UNKNOWN, 0

        def out(columns, lead):
            nonlocal place, head, head_conv
            kind, number, conv = columns[1], columns[2], columns[3]
            at = np.arange(len(kind))
            last = np.maximum.accumulate(np.where(kind == 0, at, -1))
            parent = np.where(last >= 0, number[last], head)
            parent_conv = np.where(last >= 0, conv[last], head_conv)
            arrays = [*columns, at + place, lead, parent, parent_conv]
            if len(at):
                place, head, head_conv = place + len(at), int(parent[-1]), int(parent_conv[-1])
            return pa.RecordBatch.from_arrays(
                list(map(pa.array, arrays)), names=[*names, "i", "lead", "parent", "parent_conv"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [np.asarray(batch.column(name)) for name in names]
            if held is not None:
                columns = [np.r_[h, c].astype(c.dtype) for h, c in zip(held, columns, strict=True)]
            held = [c[-1:] for c in columns]
            lead = np.where(columns[1][1:] == 1, columns[2][1:], -1)
            yield out([c[:-1] for c in columns], lead)
        if held is not None:
            yield out(held, np.array([UNKNOWN]))

    linked = rows.select(F.spark_partition_id().alias("p"), "kind", "id", "conv", "saved").mapInArrow(
        run,
        "p int, kind int, id long, conv long, saved long, i long, lead long, parent long, "
        "parent_conv long",
    )
    linked = stored(linked, "trie-links")
    # First row and last parent of each partition.
    edges = linked.groupBy("p").agg(
        F.min_by(F.struct("kind", "id"), "i").alias("first"),
        F.max(F.when(F.col("kind") == 0, F.struct("i", "id", "conv"))).alias("last"),
    )
    edges = sorted(edges.collect(), key=lambda e: e.p)
    fixed, head = [], (UNKNOWN, 0)
    for e, following in zip(edges, [*edges[1:], None], strict=True):
        goes_on = following is not None and following.first.kind == 1
        fixed.append((e.p, following.first.id if goes_on else -1, *head))
        if e.last is not None:
            head = (e.last.id, e.last.conv)
    linked = _by_partition(linked, fixed, "next_lead long, head long, head_conv long")
    open_end, no_head = F.col("lead") == UNKNOWN, F.col("parent") == UNKNOWN
    return linked.select(
        "kind",
        "id",
        "conv",
        "saved",
        F.when(open_end, F.col("next_lead")).otherwise(F.col("lead")).alias("lead"),
        F.when(no_head, F.col("head")).otherwise(F.col("parent")).alias("parent"),
        F.when(no_head, F.col("head_conv")).otherwise(F.col("parent_conv")).alias("parent_conv"),
    )


def _arcs(links: DataFrame) -> DataFrame:
    """Rows (id, next, nodes, leaves, saved): arc 2 v enters node v, arc 2 v + 1 leaves it."""
    is_child, has_lead = F.col("kind") == 1, F.col("lead") >= 0
    own = 2 * F.col("id")
    up = F.when(is_child, 2 * F.col("parent") + 1).otherwise(own + 1)
    arcs = links.select(
        (own + F.col("kind")).alias("id"),
        F.when(has_lead, 2 * F.col("lead")).otherwise(up).alias("next"),
        (1 - F.col("kind")).cast("long").alias("nodes"),
        F.when(is_child | has_lead, 0).otherwise(1).cast("long").alias("leaves"),
        "saved",
    )
    last = links.sparkSession.createDataFrame([(1, -1, 0, 0, 0)], arcs.schema)
    return arcs.unionByName(last)


def contracted(ids: np.ndarray, following: np.ndarray, weights: np.ndarray):
    """Stretches of a list among some of its elements.

    For each element the index of the first one of its stretch and the sums of the weights before
    it there; and which elements are the last of a stretch.
    """
    n = len(ids)
    order = np.argsort(ids)
    at = np.searchsorted(ids[order], following)
    at[at == n] = 0
    target = order[at]
    inside = ids[target] == following
    before = np.full(n, -1)
    before[target[inside]] = np.flatnonzero(inside)
    head = np.where(before < 0, np.arange(n), before)
    sums = np.where((before < 0)[:, None], 0, weights[before])
    while True:
        # `head` leads some way back, `sums` has the weights from there to just before.
        further = head[head]
        if np.array_equal(further, head):
            return head, sums, ~inside
        sums += sums[head]
        head = further


def _tour_blocks(arcs: DataFrame, nodes: int, blocks: int) -> DataFrame:
    """Stretches of arcs within blocks of nodes.

    Kind 0, a node: `head` and `sums` of the arc that enters it, `head2` and `sums2` of the one that
    leaves it.  Kind 1, a stretch: its first arc `id`, the arc `head` that follows, its `sums`.
    """
    schema = (
        "kind int, id long, block long, head long, sums array<long>, head2 long, sums2 array<long>"
    )

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("id")
        ids = np.asarray(table["id"])
        following = np.asarray(table["next"])
        weights = np.stack([np.asarray(table[w]) for w in WEIGHTS], axis=1)
        head, sums, is_last = contracted(ids, following, weights)
        last = np.flatnonzero(is_last)
        block = table["block"][0].as_py()
        enter, leave = slice(0, None, 2), slice(1, None, 2)  # both arcs of a node are here

        def lists(values):
            return pa.array(values.tolist(), pa.list_(pa.int64()))

        count, m = len(last), len(ids) // 2
        return pa.Table.from_arrays(
            [
                pa.array(np.r_[np.zeros(m, np.int32), np.ones(count, np.int32)]),
                pa.array(np.r_[ids[enter] // 2, ids[head[last]]]),
                pa.array(np.full(m + count, block)),
                pa.array(np.r_[ids[head[enter]], following[last]]),
                lists(np.r_[sums[enter], sums[last] + weights[last]]),
                pa.array(np.r_[ids[head[leave]], np.zeros(count, np.int64)]),
                lists(np.r_[sums[leave], np.zeros((count, len(WEIGHTS)), np.int64)]),
            ],
            names=["kind", "id", "block", "head", "sums", "head2", "sums2"],
        )

    block = F.floor(F.floor(F.col("id") / 2) * F.lit(blocks) / F.lit(nodes)).cast("long")
    return arcs.withColumn("block", block).groupBy("block").applyInArrow(run, schema)


ELEMENT = "id long, next long, block long, sums array<long>"


def _plus(one: Column | str, other: Column | str) -> Column:
    return F.zip_with(one, other, lambda a, b: a + b)


def _merged(elements: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """Elements after pairs of neighbours that a coin chooses are merged, and where they have gone.

    An element that throws heads takes in the next one if that throws tails.
    """
    coin = F.pmod(F.xxhash64(F.lit(turn), "id"), F.lit(2)) == 1
    heads = elements.filter(coin).select(F.struct("*").alias("a"), F.col("next").alias("meet"))
    tails = elements.filter(~coin).select(F.struct("*").alias("b"), F.col("id").alias("meet"))
    both = stored(heads.join(tails, "meet", "full_outer").drop("meet"), "trie-pairs")
    is_pair = F.col("a").isNotNull() & F.col("b").isNotNull()
    kept = F.coalesce("a", "b")
    after = both.select(
        kept["id"].alias("id"),
        F.when(is_pair, F.col("b.next")).otherwise(kept["next"]).alias("next"),
        kept["block"].alias("block"),
        F.when(is_pair, _plus("a.sums", "b.sums")).otherwise(kept["sums"]).alias("sums"),
    )
    gone = both.filter(is_pair).select(
        F.col("b.id").alias("id"), F.col("a.id").alias("head"), F.col("a.sums").alias("sums")
    )
    return after, gone


def _contract_blocks(elements: DataFrame) -> DataFrame:
    """Rows (id, head, sums, last, next, total): where each element stands in its stretch."""
    schema = (
        "id long, block long, head long, sums array<long>, last boolean, next long, "
        "total array<long>"
    )

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, following = np.asarray(table["id"]), np.asarray(table["next"])
        weights = np.array(table["sums"].to_pylist(), np.int64).reshape(len(ids), -1)
        head, sums, is_last = contracted(ids, following, weights)
        return pa.Table.from_arrays(
            [
                table["id"],
                table["block"],
                pa.array(ids[head]),
                pa.array(sums.tolist(), pa.list_(pa.int64())),
                pa.array(is_last),
                table["next"],
                pa.array((sums + weights).tolist(), pa.list_(pa.int64())),
            ],
            names=["id", "block", "head", "sums", "last", "next", "total"],
        )

    return elements.groupBy("block").applyInArrow(run, schema)


def ranked(elements: DataFrame, blocks: int, fan: int = FAN, limit: int = BLOCK_ELEMENTS):
    """Rows (id, sums): the sums of all elements before each one of a list.

    `elements` has (id, next, block, sums); blocks run from 0, and neighbours should share one.
    """
    steps: list[tuple[str, DataFrame]] = []
    turn = 0
    while blocks > 1:
        blocks = -(-blocks // fan)
        elements = elements.withColumn("block", F.floor(F.col("block") / fan).cast("long"))
        while True:
            elements = stored(elements, "trie-elements")
            sizes = elements.groupBy("block").count().agg(F.max("count")).first()[0]
            if sizes <= limit:
                break
            turn += 1
            elements, gone = _merged(elements, turn)
            steps.append(("pairs", gone))
        placed = stored(_contract_blocks(elements), "trie-stretches")
        steps.append(("blocks", placed.select("id", "head", "sums")))
        elements = placed.filter("last").select(
            F.col("head").alias("id"), "next", "block", F.col("total").alias("sums")
        )
    # One stretch is left: the list itself, with nothing before it.
    ranks = elements.select("id", F.array_repeat(F.lit(0).cast("long"), F.size("sums")).alias("sums"))
    for kind, where in reversed(steps):
        of_head = ranks.select(F.col("id").alias("head"), F.col("sums").alias("base"))
        found = where.join(of_head, "head").select("id", _plus("sums", "base").alias("sums"))
        ranks = stored(ranks.unionByName(found) if kind == "pairs" else found, "trie-ranks")
    return ranks


def _subtrees(arcs: DataFrame, nodes: int, block_nodes: int, fan: int, limit: int) -> DataFrame:
    """Rows (id, of): nodes, leaves and savings in the subtree of each node."""
    partitions = int(arcs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = min(nodes, max(partitions, -(-nodes // block_nodes)))
    placed = stored(_tour_blocks(arcs, nodes, blocks), "trie-tour")
    stretches = placed.filter("kind = 1").select("id", F.col("head").alias("next"), "block", "sums")
    within = placed.filter("kind = 0").select("id", "head", "sums", "head2", "sums2")

    def difference(after: Column | str, before: Column | str) -> Column:
        return F.zip_with(after, before, lambda a, b: a - b).alias("of")

    # Where both arcs are in one stretch, what lies before that cancels out.
    same = within.filter("head = head2").select("id", difference("sums2", "sums"))
    ranks = ranked(stretches, blocks, fan, limit)
    enter = ranks.select(F.col("id").alias("head"), F.col("sums").alias("base"))
    leave = ranks.select(F.col("id").alias("head2"), F.col("sums").alias("base2"))
    apart = within.filter("head <> head2").join(enter, "head").join(leave, "head2")
    apart = apart.select("id", difference(_plus("sums2", "base2"), _plus("sums", "base")))
    return same.unionByName(apart)


def prefix_trie(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    donor: Column | None = None,
    taken: Column | None = None,
    block_nodes: int = BLOCK_NODES,
    fan: int = FAN,
    limit: int = BLOCK_ELEMENTS,
) -> DataFrame:
    """One row for each node: each distinct sequence of first turns (role, text) of conversations.

    conv_id (the smallest of the conversations that begin so), depth, parent_conv_id (null for the
    root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256, n_nodes.  Leaves, nodes and
    savings are those of the subtree, the node itself included; a node saves, for each of its
    conversations but one, the UTF-8 bytes of its last text.  `ends_sha256` is the digest of the ids
    of the conversations that end there.

    Ids are whole numbers; rows without one are left out.  Turns are in the order of `turn`, null
    first; turns of equal number, in an order that depends on their content only; rows alike in
    everything are turns of their own.  A null role or text is empty.  `donor` and `taken`, columns
    of `conv`, let conversations begin with turns of others (see `prefixes`).  An empty table has no
    node, not even a root.  Other columns are not read.  Equal prefixes are told by 128-bit hashes.
    """
    turns = conversations.select(
        F.col(conv_id).cast("long").alias("conv"),
        F.col(turn).alias("turn"),
        F.col(role).alias("role"),
        F.col(text).alias("text"),
    )
    nodes, count = _numbered_nodes(prefixes(turns, donor, taken))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves"]
    if not count:
        empty = ", ".join(f"{name} long" for name in [*names, "saved_tokens"])
        return conversations.sparkSession.createDataFrame(
            [], f"{empty}, ends_sha256 string, n_nodes long"
        )
    links = _links(nodes)
    children = links.filter("kind = 1")
    parents = children.select("id", "parent_conv")
    n_children = children.groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("own"))
    sums = _subtrees(_arcs(links), count, block_nodes, fan, limit)
    return (
        nodes.join(sums, "id")
        .join(parents, "id", "left")
        .join(n_children, "id", "left")
        .select(
            F.col("conv").alias("conv_id"),
            "depth",
            F.col("parent_conv").alias("parent_conv_id"),
            "n_convs",
            F.coalesce("own", F.lit(0)).cast("long").alias("n_children"),
            F.col("of")[1].alias("n_leaves"),
            F.col("of")[2].alias("saved_tokens"),
            F.coalesce("sha", F.lit(EMPTY_SHA)).alias("ends_sha256"),
            F.col("of")[0].alias("n_nodes"),
        )
    )
