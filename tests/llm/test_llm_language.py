import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from helpers import documents, saved

from txnlake.llm import language
from txnlake.llm.words import buffers


def test_subwords_depend_on_the_text_alone():
    texts = ["the cat", "", "a", "ÉTÉ été", "12 !!", "x" * 50]
    data, offsets = buffers(pa.array([t.lower() for t in texts]))
    bucket, owner = language.subwords(data, offsets)
    for i, text in enumerate(texts):
        one, size = buffers(pa.array([text.lower()]))
        alone, _ = language.subwords(one, size)
        assert sorted(alone) == sorted(bucket[owner == i])
        assert (len(alone) > 0) == bool(re.search(r"[^\W\d_]", text))
    assert bucket.max(initial=0) < language.BUCKETS


def test_remainder_is_crc32_of_the_id(spark):
    ids = spark.createDataFrame([(i,) for i in [*range(50), -1, 10**15]], "doc_id long")
    for r in ids.select("doc_id", language.remainder(ids.doc_id).alias("m")).collect():
        assert r.m == zlib.crc32(str(r.doc_id).encode()) % 4


def test_held_out_accuracy_and_scores(spark, sf_dir):
    docs = spark.read.parquet(sf_dir.replace("0.001", "0.01") + "/documents.parquet")
    told = language.predict(docs, language.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id")
    rows = told.collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(held) > 150
    assert np.mean([r.lang == r.lang_pred for r in held]) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)
    # Clean documents stay.
    assert np.mean([r.rejected for r in held]) <= 0.01


def test_learns_from_allowed_rows_only(spark, tmp_path):
    texts = [f"word{i} some more words here" for i in range(40)]
    docs = documents(spark, tmp_path, texts)
    ids = [r.doc_id for r in docs.filter(~language.learnable(docs.doc_id)).collect()]
    assert ids and all(zlib.crc32(str(i).encode()) % 4 == 2 for i in ids)
    only_held = docs.filter(docs.doc_id.isin(ids))
    assert language.fit(only_held) is None


def learned(monkeypatch, docs, each, largest):
    """The rows that the model would be trained on."""
    taken = []
    monkeypatch.setattr(language, "PER_LANGUAGE", each)
    monkeypatch.setattr(language, "LARGEST_SAMPLE", largest)
    monkeypatch.setattr(language, "train", lambda rows, names: taken.append((rows, names)))
    language.fit(docs)
    (rows, names), = taken
    return rows, names


SAMPLED = "doc_id long, text string, lang string, source string, n_chars long"


def test_every_language_stays_in_the_sample(spark, tmp_path, monkeypatch):
    # A table in order of language, with more rows drawn than the sample may have.
    rows = [(i, f"some text {i}", f"l{i // 400:02}", "s", 1) for i in range(8000)]
    rows.append((9002, "the only text", "rare", "s", 1))
    assert zlib.crc32(b"9002") % 4 != 2
    docs = saved(spark, tmp_path, rows, SAMPLED, files=1)
    for each, largest, wanted in ((60, 10**6, 60), (60, 420, 20), (60, 21, 1), (60, 5, 1)):
        taken, names = learned(monkeypatch, docs, each, largest)
        assert names == sorted({r[2] for r in rows})
        count = Counter(r.lang for r in taken)
        assert count.pop("rare") == 1
        assert set(count.values()) == {wanted}
        assert {r.lang for r in taken if r.fold != 0} == set(names)


def test_repeated_ids_and_rows_do_not_fill_the_sample(spark, tmp_path, monkeypatch):
    free = [i for i in range(1, 2000) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(i, f"some text {i}", "a", "s", 1) for i in free[:900]]
    rows += [(free[0], f"text {i} of a hot id", "b", "s", 1) for i in range(900)]
    rows += [(free[0], "one row many times", "c", "s", 1)] * 5000
    rows += [(i, f"some text {i}", "c", "s", 1) for i in free[:30]]
    docs = saved(spark, tmp_path, rows, SAMPLED)
    taken, _ = learned(monkeypatch, docs, 40, 1000)
    assert Counter(r.lang for r in taken) == {"a": 40, "b": 40, "c": 31}


def test_cases(spark, tmp_path):
    texts = [
        *["der hund und die katze sind nicht im haus"] * 20,
        *["the dog and the cat are not in the house"] * 20,
    ]
    rows = [(i, t, "de" if i < 20 else "en", None, 1, "x") for i, t in enumerate(texts)]
    rows += [
        (100, None, "de", None, 0, "x"), (101, "", None, None, 0, "x"), (102, "123 ... !", "en", "", 0, "x"),
        (None, "the cat and the dog", None, None, 0, "x"), (103, "the " * 60_000, None, None, 0, "x"),
        (104, "x", None, None, 0, "x"), (0, texts[0], "de", None, 1, "x"),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string"
    docs = saved(spark, tmp_path, rows, schema)
    found = language.predict(docs, language.fit(docs)).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    for doc_id in (100, 101, 102):
        assert (by_id[doc_id].lang_pred, by_id[doc_id].score) == ("und", 0.0)
        assert by_id[doc_id].rejected
    assert by_id[None].lang_pred == by_id[103].lang_pred == "en"
    assert by_id[104].lang_pred in ("de", "en")
    assert {by_id[i].lang_pred for i in range(20)} == {"de"}
    kept = language.known_rows(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in found if not r.rejected}
    assert {r.doc_id for r in kept.collect()} == ids


def test_without_labels_or_rows(spark, tmp_path):
    rows = [(1, "some text", None, None, None)]
    docs = saved(spark, tmp_path, rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert [r.lang_pred for r in language.predict(docs, language.fit(docs)).collect()] == ["und"]
    assert language.known_rows(docs).count() == 0
    empty = documents(spark, tmp_path, [])
    assert language.predict(empty, language.fit(empty)).count() == 0


def plain_subwords(text, buckets=language.BUCKETS):
    """Buckets of one text, byte by byte."""
    letters = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in text.lower().encode())
    padded, mask, found = b" " + letters + b"  ", (1 << 32) - 1, []

    def bucket(h):
        h ^= h >> 15
        return (h * 0x2C1B3C6D & mask) >> (32 - buckets.bit_length() + 1)

    for i in range(1, len(letters) + 1):
        if padded[i] == 0x20:
            continue
        a, b, c, d = *padded[i - 1 : i + 2], (padded + b" ")[i + 2]
        three = (a * 0x01000193 & mask) ^ (b * 0x9E3779B1 & mask) ^ (c * 0x85EBCA6B & mask)
        found.append(bucket(three))
        if c != 0x20:
            found.append(bucket((three + 0x27D4EB2F & mask) ^ (d * 0xC2B2AE35 & mask)))
    return found


def test_scores_against_a_plain_computation(spark, tmp_path):
    rng = np.random.default_rng(5)
    names = ["aa", "bb", "cc"]
    scores = rng.normal(0, 3, (language.BUCKETS, 3)).astype(np.float32)
    model = language.Model(names, scores, rng.normal(0, 1, 3).astype(np.float32))
    texts = ["the cat sat", "a", "ÉTÉ été 12", "x" * 500, "12 !!", "", None, "über alles, und so"]
    docs = documents(spark, tmp_path, texts)
    for r in language.predict(docs, model).collect():
        text = texts[r.doc_id]
        if not re.search(r"[^\W\d_]", text or ""):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
            continue
        mean = np.mean([scores[b].astype(float) for b in plain_subwords(text)], axis=0)
        chance = np.exp(mean + model.bias)
        chance /= chance.sum()
        assert r.lang_pred == names[int(chance.argmax())]
        assert abs(r.score - chance.max()) < 1e-9
        assert r.rejected == (chance.max() < language.MIN_SCORE)


def test_long_texts_in_pieces_are_judged_as_whole(monkeypatch):
    rng = np.random.default_rng(3)
    scores = rng.normal(size=(language.BUCKETS, 3)).astype(np.float32)
    model = language.Model(["a", "b", "c"], scores, np.zeros(3, np.float32))
    texts = pa.array(["Größe und Maß, " * 700, "short one", "", None, "été 1999 " * 900])
    readable = pa.array([True, True, False, False, True])

    def judged():
        parts = list(language._judged(model, texts, readable))
        return np.concatenate([p[2] for p in parts]), np.concatenate([p[3] for p in parts])

    best, chance = judged()
    monkeypatch.setattr(language, "CHUNK_BYTES", 1000)
    again, chances = judged()
    assert (best == again).all() and np.allclose(chance, chances)
