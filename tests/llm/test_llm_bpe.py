import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from helpers import documents

from txnlake.llm import bpe
from txnlake.llm.queries import TOKENIZER, encoded

RANKS = bpe.read_ranks(public_tokenizers.path(TOKENIZER))
ORACLE = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={}
)


@pytest.fixture(scope="module")
def merges():
    return bpe.Merges(RANKS)


def some_texts():
    rng = random.Random(11)
    parts = [
        "the", " the", "aaaa", "aaaaaaa", "é", "日本語", "🙂", " ", "  ", "\n", "\t", "'s", "'LL", "123",
        "<|endoftext|>", "!!!", "—", "supercalifragilistic", "\x00", "ÅÄÖ", " ", "zzzz", "abab",
    ]
    return ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(300)]


def test_equal_to_the_library(merges):
    texts = ["", " ", "a", "a" * 5000, "ab" * 3001, *some_texts()]
    encoder = bpe.Encoder(merges, public_tokenizers.PATTERN)
    for _ in range(2):  # the second time words are remembered
        ids, starts = encoder.encode(texts)
        for i, text in enumerate(texts):
            assert ids[starts[i] : starts[i + 1]].tolist() == ORACLE.encode_ordinary(text)
        assert bpe.decode_ids(merges, ids).tobytes().decode() == "".join(texts)


def test_forgetting_words_changes_nothing(merges, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    encoder = bpe.Encoder(merges, public_tokenizers.PATTERN)
    for text in some_texts()[:60]:
        assert encoder.encode([text])[0].tolist() == ORACLE.encode_ordinary(text)


def test_words_of_random_bytes_without_the_shortcut(merges):
    rng = np.random.default_rng(2)
    words = [bytes(rng.choice(list(b"aeinrst "), size=n).tolist()) for n in rng.integers(1, 30, 400)]
    ids, starts = bpe.replay(merges, words)
    for i, word in enumerate(words):
        wanted = ORACLE._core_bpe.encode_single_piece(word)
        assert ids[starts[i] : starts[i + 1]].tolist() == wanted


def check(spark, docs):
    found = {}
    for r in bpe.digests(encoded(spark, docs)).collect():
        found.setdefault(r.doc_id, []).append(r)
    for doc in docs.select("doc_id", "text").collect():
        text = doc.text or ""
        ids = ORACLE.encode_ordinary(text)
        joined = " ".join(map(str, ids)).encode()
        wanted = (doc.doc_id, len(ids), hashlib.sha256(joined).hexdigest(),
                  hashlib.sha256(text.encode()).hexdigest())
        assert wanted in [tuple(r) for r in found[doc.doc_id]]
    return sum(map(len, found.values()))


def test_cases(spark, tmp_path):
    texts = [(1, None), (2, ""), (None, "no id"), (3, "x"), (3, "x"), (4, "long text " * 30_000)]
    docs = documents(spark, tmp_path, texts, ", ids string, decoded string", ("i", "d"))
    assert check(spark, docs) == len(texts)


def test_empty_table(spark, tmp_path):
    assert bpe.digests(encoded(spark, documents(spark, tmp_path, []))).count() == 0


def test_all_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert check(spark, docs) == docs.count()


def test_decoding_stored_ids_gives_the_same_bytes(spark, tmp_path):
    texts = [(1, None), (2, "two  é\n"), (3, "x"), (3, "y " * 5000)]
    docs = documents(spark, tmp_path, texts)
    ranks = bpe.read_ranks(public_tokenizers.path(TOKENIZER))
    ids = bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    apart = bpe.decode(ids, ranks).select("doc_id", "ids", "decoded").collect()
    assert sorted(apart) == sorted(encoded(spark, docs).drop("_rid").collect())
    assert sorted(bytes(r.decoded).decode() for r in apart) == sorted(t or "" for _, t in texts)
