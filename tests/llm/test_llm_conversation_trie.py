import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers import bag, saved
from pyspark.sql import functions as F

from txnlake.llm import conversation_trie
from txnlake.llm.conversation_trie import contracted, prefix_trie, ranked
from txnlake.llm.queries import op13_conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
           "saved_tokens", "ends_sha256"]


def donor_of(c):
    return c - abs(c) % 5 * (1 if c >= 0 else -1)  # the remainder has the sign of the id


def taken_of(c):
    return zlib.crc32(str(c).encode()) % 9


def brute(rows, rebuilt=True):
    """Nodes from dictionaries; turns of equal number must be equal here."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            key = (turn is not None, turn or 0)
            own.setdefault(conv, []).append((key, role or "", text or ""))
    own = {c: [t[1:] for t in sorted(turns)] for c, turns in own.items()}
    convs = own
    if rebuilt:
        convs = {c: own.get(donor_of(c), [])[: taken_of(c)] + t[taken_of(c) :] for c, t in own.items()}
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[x] for x in below) if below else 1
        text = len(node[-1][1].encode()) if node else 0
        saved[node] = (len(members[node]) - 1) * text + sum(saved[x] for x in below)
    return [
        (min(m), len(node), min(members[node[:-1]]) if node else None, len(m),
         len(children.get(node, [])), leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest())
        for node, m in members.items()
    ]


def spliced(docs, **parameters):
    conv = F.col("conv")
    taken = F.crc32(conv.cast("string").cast("binary")) % 9
    return prefix_trie(docs, donor=conv - conv % 5, taken=taken, **parameters)


def check(found, rows, rebuilt=True):
    assert bag(found.select(*COLUMNS).collect()) == bag(brute(rows, rebuilt))


def random_rows(seed, convs=120, first=0):
    rng = random.Random(seed)
    rows = []
    for c in range(first, first + convs):
        for turn in range(rng.choice([1, 2, 3, 5, 9, 12])):
            text = rng.choice(["hello", "héllo", "", None, "a b", f"own {c}"])
            rows.append((c, turn, rng.choice(["user", "assistant"]), text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("parts", ["1", "7"])
def test_random_conversations(spark, tmp_path, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    rows = random_rows(1) + random_rows(2, 40, -1000) + random_rows(3, 30, 10**12)
    docs = saved(spark, tmp_path, rows, SCHEMA)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        check(spliced(docs), rows)
        check(prefix_trie(docs), rows, rebuilt=False)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_small_blocks_and_merged_pairs(spark, tmp_path):
    rows = random_rows(4, 60)
    docs = saved(spark, tmp_path, rows, SCHEMA)
    check(spliced(docs, block_nodes=3, fan=4, limit=25), rows)


def test_a_conversation_over_many_partitions(spark, tmp_path):
    long = [(5, t, "user", f"turn {t % 90}") for t in range(700)]
    copy = [(8, t, "user", f"turn {t % 90}") for t in range(400)] + [(8, 400, "user", "other")]
    rows = long + copy + [(6, t, "user", f"x{t}") for t in range(12)] + random_rows(5, 20, 100)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = saved(spark, tmp_path, rows, SCHEMA)
        check(spliced(docs), rows)
        check(prefix_trie(docs), rows, rebuilt=False)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_many_copies(spark, tmp_path):
    rows = [(5 * c, t, "user", f"same {t}") for c in range(3000) for t in range(2)]
    check(spliced(saved(spark, tmp_path, rows, SCHEMA)), rows)


def test_cases(spark, tmp_path):
    rows = [
        (None, 1, "user", "no id"), (1, None, "user", "null first"), (1, -5, None, None),
        (1, 3, "user", "ä" * 10), (2, 1, "user", "twice"), (2, 1, "user", "twice"),
        (3, 0, "user", "long " * 20_000), (4, 0, "", ""), (5, 0, None, None), (5, 1, "user", "x"),
        (7, 0, "us", "era"), (8, 0, "user", "a"),
    ]
    wide = [(*r, "k", 1, "c") for r in rows]
    docs = saved(spark, tmp_path, wide, SCHEMA + ", conv string, depth int, _rid string")
    check(spliced(docs), rows)
    check(prefix_trie(docs), rows, rebuilt=False)


def test_turns_of_equal_number_have_one_order(spark, tmp_path):
    rows = [(c, 0, "user", t) for c in (1, 2, 3) for t in ("b", "a", "c")]
    found = prefix_trie(saved(spark, tmp_path, rows, SCHEMA)).collect()
    assert len(found) == 4 and all(r.n_convs == 3 for r in found)


@pytest.mark.parametrize("rows", [[], [(None, 0, "user", "x")]])
def test_without_conversations_there_is_no_node(spark, tmp_path, rows):
    found = spliced(saved(spark, tmp_path, rows, SCHEMA))
    assert found.count() == 0 and found.columns[:8] == COLUMNS


def test_stretches_of_a_list():
    rng = np.random.default_rng(1)
    order = rng.permutation(1000)
    following = np.full(1000, -1)
    following[order[:-1]] = order[1:]
    weight = rng.integers(0, 9, (1000, 2))
    ids = rng.permutation(1000)[:700]
    head, sums, last = contracted(ids, following[ids], weight[ids])
    there = set(ids.tolist())
    begin, total = None, None
    got = {int(i): (int(ids[h]), tuple(s), bool(e)) for i, h, s, e in zip(ids, head, sums, last, strict=True)}
    for i, nxt in zip(order.tolist(), [*order[1:].tolist(), None], strict=True):
        if i not in there:
            begin = None
            continue
        if begin is None:
            begin, total = i, np.zeros(2, int)
        assert got[i] == (begin, tuple(total), nxt not in there)
        total = total + weight[i]


@pytest.mark.parametrize("limit", [20, 10_000])
def test_ranks_of_a_list_in_random_order(spark, limit):
    rng = np.random.default_rng(2)
    order = rng.permutation(300).tolist()
    rows = [
        (a, b, a % 20, [1, a]) for a, b in zip(order, [*order[1:], -1], strict=True)
    ]
    elements = spark.createDataFrame(rows, conversation_trie.ELEMENT)
    found = {r.id: tuple(r.sums) for r in ranked(elements, 20, 4, limit).collect()}
    assert found == {a: (i, sum(order[:i])) for i, a in enumerate(order)}


def test_the_query(spark, sf_dir):
    rows = list(map(tuple, spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()))
    check(op13_conversation_trie(spark, sf_dir), rows)
