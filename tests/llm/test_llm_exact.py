import hashlib
import re

from helpers import documents
from pyspark.sql import functions as F

from txnlake.llm.exact_dedup import exact_dedup, kept_rows


def brute(rows):
    """rows: (doc_id, text) -> doc_id, keep_id, group_size, text_sha256, and kept rows by group."""
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub("[ \t-\r]", "", text or ""), []).append((doc_id, text or ""))
    out = []
    for norm, members in groups.items():
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(m[0], best[0], len(members), sha) for m in members]
    return sorted(out, key=str), len(groups)


CASES = [
    (1, "a b"), (2, "ab"), (3, " a\tb\n"), (9, "a b "), (4, None), (5, ""), (6, " \x0b\x0c\r"),
    (7, "é é"), (8, "éé"), (None, "x y"), (10, "xy"), (None, None), (12, "a b"),
    (13, "long " * 4000), (13, "long " * 4000), (14, "A b"), (15, "x y"), (15, "x y"),
]


def check(found, rows):
    wanted, groups = brute(rows)
    got = [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found]
    assert sorted(got, key=str) == wanted
    assert sum(r.kept for r in found) == groups
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_cases(spark, tmp_path):
    docs = documents(spark, tmp_path, CASES, ", kept string, digest string", ("k", "d"))
    check(exact_dedup(docs, salts=3).collect(), CASES)


def test_texts_are_compared_where_digests_are_equal(spark, tmp_path):
    docs = documents(spark, tmp_path, CASES)
    weak = exact_dedup(docs, salts=2, digest=lambda t: (F.length(t) % 3).cast("string"))
    check(weak.collect(), CASES)


def test_kept_rows_keep_all_columns(spark, tmp_path):
    docs = documents(spark, tmp_path, CASES, ", _rid string, best int", ("r", 1))
    kept = kept_rows(docs)
    assert kept.columns == docs.columns
    assert kept.count() == brute(CASES)[1]
    assert {r["_rid"] for r in kept.collect()} == {"r"}


def test_empty_table(spark, tmp_path):
    docs = documents(spark, tmp_path, [])
    assert exact_dedup(docs).count() == 0 and kept_rows(docs).count() == 0
