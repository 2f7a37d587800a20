"""Operators that scan a table twice give the same rows however the second scan is cut."""

import pytest
from helpers import bag, documents, saved

from txnlake.llm import decontaminate, exact_dedup, lines, simhash, substrings
from txnlake.llm.common import RID, numbered, stored

PARALLELISM = "spark.sql.leafNodeDefaultParallelism"
PASSAGE = "one two three four five six seven eight nine ten eleven twelve. Next thirteen words. "
TEXTS = [
    f"{PASSAGE if i % 3 == 0 else ''}Copy {i % 40} of some text\nwith words of line {i % 50}: "
    f"a b c d e f g h {i % 7}\nand number {i}" if i % 4 else f"same {i % 5} {PASSAGE}"
    for i in range(400)
]


def operators(spark, folder):
    items = saved(spark, folder, [(1, PASSAGE), (2, "some text"), (3, "no such")], "item_id long, text string")
    return {
        "decontaminate": lambda docs: decontaminate.clean_rows(docs, items),
        "substrings": lambda docs: substrings.dedup_substrings(docs).drop(RID),
        "lines": lambda docs: lines.keep_lines(docs),
        "exact": lambda docs: exact_dedup.kept_rows(docs),
        "near": lambda docs: simhash.kept_rows(docs),
    }


@pytest.mark.parametrize("name", ["decontaminate", "substrings", "lines", "exact", "near"])
def test_other_splits_while_running(spark, tmp_path, monkeypatch, name):
    docs = documents(spark, tmp_path, TEXTS, files=7)
    run = operators(spark, tmp_path)[name]
    spark.conf.set(PARALLELISM, "4")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        wanted = bag(run(docs).collect())
        turns = iter(range(1, 1000))

        def elsewhere(df, label):
            """Cores come and go between the steps of an operator."""
            out = stored(df, label)
            spark.conf.set(PARALLELISM, str(3 + 11 * (next(turns) % 4)))
            return out

        for module in (decontaminate, exact_dedup, lines, simhash, substrings):
            monkeypatch.setattr(module, "stored", elsewhere)
        found = run(docs)
        spark.conf.set(PARALLELISM, "29")
        assert bag(found.collect()) == wanted
    finally:
        spark.conf.unset(PARALLELISM)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_numbers_are_distinct_and_stay(spark, tmp_path):
    docs = documents(spark, tmp_path, TEXTS, files=5)

    def numbers(cores):
        spark.conf.set(PARALLELISM, cores)
        return {r.doc_id: tuple(r[RID]) for r in numbered(docs, "doc_id").collect()}

    try:
        first, second = numbers("2"), numbers("31")
    finally:
        spark.conf.unset(PARALLELISM)
    assert first == second and len(set(first.values())) == len(TEXTS)


def test_rows_that_no_file_holds_raise(spark):
    with pytest.raises(Exception, match="_metadata"):
        numbered(spark.range(3), "id")
