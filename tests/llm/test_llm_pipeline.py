"""The pipeline against its stages by brute force, and the guard of the entry module."""

import re
import subprocess
import sys

import corpus_pipeline
import pytest
from helpers import documents, saved
from test_llm_bpe import ORACLE
from test_llm_decontaminate import brute as brute_hits
from test_llm_simhash import brute_fingerprint, brute_roots

from txnlake.llm import language
from txnlake.llm.common import table


def test_stages_follow_each_other(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    told = language.predict(docs, language.fit(docs)).collect()
    left = {r.doc_id for r in told if not r.rejected}
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert len(left) >= 0.95 * len(texts)

    groups = {}
    for doc_id in sorted(left):
        groups.setdefault(re.sub("[ \t-\r]", "", texts[doc_id]), []).append(doc_id)
    left = sorted(min(g, key=lambda i: (-len(texts[i]), i)) for g in groups.values())

    roots = brute_roots([brute_fingerprint(texts[i]) for i in left], 4)
    left = [doc_id for n, doc_id in enumerate(left) if roots[n] == n]

    items = [tuple(r) for r in table(spark, sf_dir, "benchmark").collect()]
    left = [i for i in left if brute_hits([(i, texts[i])], items, 10)[0][1] == 0]

    found = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert found == {i: len(ORACLE.encode_ordinary(texts[i])) for i in left}


@pytest.mark.parametrize("empty", [True, False])
def test_every_stage_takes_odd_rows(spark, tmp_path, empty):
    words = "the dog and the cat are not in the house today because of rain".split()
    texts = [] if empty else [
        None, "", " \n", "1234", "x", " ".join(words), " ".join(words), (None, "the cat " * 20),
        (7, "who is in the house"), (7, "who is in the house now"), "the " * 30_000,
    ]
    docs = documents(spark, tmp_path, texts, ", _rid string, kept string, fp int", ("r", "k", 1))
    saved_items = saved(spark, tmp_path, [(1, " ".join(words))], "item_id long, text string")
    folder = f"{tmp_path}/sf"
    saved_items.write.parquet(f"{folder}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns, name
        assert empty or 0 < kept.count() <= len(texts)
        assert not empty or kept.count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert last.count() == len(texts)


def test_the_entry_works_without_the_add_on():
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.startswith(("txnlake.llm", "corpus_pipeline")):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert not any(n.startswith("op") for n in e.queries()) and "pipeline" not in e.queries()
assert set(e.oracle_sql()) <= set(e.queries())
"""
    root = corpus_pipeline.__file__.rsplit("/", 1)[0]
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
