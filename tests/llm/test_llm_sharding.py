import zlib
from collections import Counter, defaultdict

import pytest
from helpers import saved
from pyspark.sql import functions as F

from txnlake.llm import sharding
from txnlake.llm.sharding import interleave

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, slot string"


def table(spark, folder, n, shares):
    rows = []
    for i in range(n):
        source = next(s for s, upto in shares if i % 100 < upto)
        rows.append((i, "é" * (i % 7), "en", source, 1, "h", "s"))
    return saved(spark, folder, rows, SCHEMA)


def check_laws(rows, shards=24):
    sizes = Counter(r.shard for r in rows)
    counts = [sizes.get(s, 0) for s in range(shards)]
    assert sum(counts) == len(rows) and max(counts) - min(counts) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    assert {r.law for r in rows} <= {"rows"} and {r.grown_shard for r in rows} <= {None}


def test_laws_and_mixture(spark, tmp_path):
    shares = [("hot", 34), (None, 40), ("", 47), ("tail", 48), ("rest", 100)]
    rows = interleave(table(spark, tmp_path, 2500, shares)).collect()
    check_laws(rows)
    per = defaultdict(Counter)
    for r in rows:
        per[r.source][r.shard] += 1
    for source, counts in per.items():
        share = sum(counts.values()) / 24
        assert all(abs(counts[s] - share) <= 2 for s in range(24)), source


def test_sizes_and_checksums(spark, tmp_path):
    rows = [(1, None, None, None, 0, "h", "s"), (2, "", "en", "a", 0, "h", "s"),
            (3, "é b", "en", "a", 0, "h", "s"), (4, "x" * 100_000, "en", "a", 0, "h", "s")]
    found = {r.doc_id: r for r in interleave(saved(spark, tmp_path, rows, SCHEMA)).collect()}
    for doc_id, text, *_ in rows:
        data = (text or "").encode()
        assert found[doc_id].size == len(data) + 8
        assert found[doc_id].text_crc32 == zlib.crc32(data)
    check_laws(list(found.values()))


@pytest.mark.parametrize("n", [0, 1, 23, 24, 25])
def test_few_rows(spark, tmp_path, n):
    rows = interleave(table(spark, tmp_path, n, [("a", 100)])).collect()
    assert len(rows) == n
    check_laws(rows)


def test_repeated_rows_and_missing_ids(spark, tmp_path):
    rows = [(5, "same", "en", "a", 4, "h", "s")] * 30 + [(None, "same", "en", None, 4, "h", "s")] * 30
    found = interleave(saved(spark, tmp_path, rows, SCHEMA)).collect()
    assert len(found) == 60
    check_laws(found)


def test_shuffled_within_a_source_by_the_seed(spark, tmp_path):
    docs = table(spark, tmp_path, 1000, [("a", 50), ("b", 100)])

    def order(seed):
        rows = interleave(docs, seed=seed).collect()
        return [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]

    first = order(1)
    assert first == order(1) != order(2)
    assert first != sorted(first)
    even = [i for i in first if i % 100 < 50]
    moved = sum(abs(i - j) > 50 for i, j in zip(even, sorted(even), strict=True))
    assert moved > 300


def test_sources_of_few_rows_spread_over_all_shards(spark, tmp_path):
    rows = [(i, "x", "en", f"d{i}" if i % 2 else "head", 1, "h", "s") for i in range(4800)]
    rows += [(5000 + i, "x", "en", f"pair{i // 2}", 1, "h", "s") for i in range(4800)]
    found = interleave(saved(spark, tmp_path, rows, SCHEMA)).collect()
    check_laws(found)
    for kind, share in (("d", 100), ("p", 200), ("h", 100)):
        counts = Counter(r.shard for r in found if r.source[0] == kind)
        assert all(share / 2 < counts[s] < share * 3 / 2 for s in range(24)), (kind, counts)


def test_rows_of_a_hot_id_are_spread_and_others_keep_their_place(spark, tmp_path, monkeypatch):
    rows = [(7 if i % 2 else i, str(i), "en", "a", 1, "h", "s") for i in range(2400)]
    docs = saved(spark, tmp_path, rows, SCHEMA)

    def shards():
        return Counter(r.shard for r in interleave(docs).collect() if r.doc_id == 7)

    assert len(shards()) <= 13
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 1000)
    assert sorted(shards()) == list(range(24)) and max(shards().values()) < 80

    few = saved(spark, tmp_path, [(i, "x", "en", "a", 1, "h", "s") for i in range(500)], SCHEMA, 2)
    again = saved(spark, tmp_path, few.orderBy(few.doc_id.desc()).collect(), SCHEMA, 5)
    one, other = ({(r.doc_id, r.shard, r.slot) for r in interleave(d).collect()} for d in (few, again))
    assert one == other


def test_law_on_all_documents(spark, sf_dir):
    check_laws(interleave(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect())


def test_against_a_plain_ranking(spark, tmp_path):
    """One sort within each source, one over all fractions, and equal cuts."""
    shares = [("hot", 34), (None, 40), ("", 47), ("tail", 48), ("rest", 100)]
    docs = table(spark, tmp_path, 1100, shares)
    seed, shards = sharding.SEED, 24
    hashed = docs.select(
        "doc_id", "source", "text", F.xxhash64(F.lit(seed), "doc_id").alias("hash"),
        F.xxhash64(F.lit(seed), F.col("source").isNull(), F.coalesce("source", F.lit(""))).alias("of"),
    ).collect()
    groups = defaultdict(list)
    for r in hashed:
        groups[r.source is None, r.source or "", r.of].append(r)
    line = []
    for (is_null, source, of), rows in groups.items():
        moved = ((of & (1 << 64) - 1) >> 11) / 2.0**53
        for rank, r in enumerate(sorted(rows, key=lambda r: r.hash)):
            line.append(((rank + moved) / len(rows), is_null, source, r.hash, r.doc_id))
    line.sort()
    total = len(line)
    wanted = {}
    for at, row in enumerate(line):
        shard = at * shards // total
        wanted[row[-1]] = (shard, at - (shard * total + shards - 1) // shards)
    assert {r.doc_id: (r.shard, r.slot) for r in interleave(docs).collect()} == wanted
