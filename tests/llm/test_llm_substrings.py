import random
import re

from helpers import documents

from txnlake.llm.substrings import LONE_WORDS, RUN_WORDS, dedup_substrings, runs, sentences


def brute_runs(plain, least, lone):
    sizes = [len(s.split()) for s in plain]
    found = set()
    for i in range(len(plain)):
        for j in range(i, len(plain)):
            if sum(sizes[i : j + 1]) >= least and (j > i or sizes[i] >= lone):
                found.add((i, j))
                break
        for j in range(i, -1, -1):
            if sum(sizes[j : i + 1]) >= least and (j < i or sizes[i] >= lone):
                found.add((j, i))
                break
    return sorted(found)


def brute(rows, least=RUN_WORDS, lone=LONE_WORDS):
    """rows: (doc_id, text) in order of place -> (doc_id, n_sentences, removed sentence numbers)."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    seen, out = {}, [None] * len(rows)
    for i in order:
        plain = [" ".join(s.split()) for s in re.split(r"(?<=[.!?])\s+|\n", rows[i][1] or "")]
        plain = [s for s in plain if s]
        gone = set()
        for a, b in brute_runs(plain, least, lone):
            if seen.setdefault(tuple(plain[a : b + 1]), (i, a)) != (i, a):
                gone |= set(range(a, b + 1))
        out[i] = (rows[i][0], len(plain), [s for j, s in enumerate(plain) if j not in gone])
    return out


def check(spark, folder, rows):
    docs = documents(spark, folder, rows, ", n string, span string", ("n", "s"))
    found = sorted(dedup_substrings(docs).collect(), key=str)
    wanted = brute(rows)
    got = [(r.doc_id, r.n_sentences, sentences(r.text or "")[0]) for r in found]
    assert sorted(got, key=str) == sorted(wanted, key=str)
    assert all(r.n_removed == r.n_sentences - len(g[2]) for r, g in zip(found, got, strict=True))
    return {r.doc_id: r for r in found}


def sentence(rng, n):
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n)) + rng.choice(".!?")


def test_runs():
    rng = random.Random(8)
    for _ in range(200):
        plain = [" ".join("x" * rng.choice([1, 2, 9, 20, 55])) for _ in range(rng.randrange(9))]
        assert runs(plain, 25, 50) == brute_runs(plain, 25, 50)


def test_shared_passages_go_from_all_but_the_first(spark, tmp_path):
    rng = random.Random(2)
    passage = " ".join(sentence(rng, n) for n in (12, 7, 3, 15, 20))
    lone = sentence(rng, 60)
    short = sentence(rng, 5) + " " + sentence(rng, 6)
    rows = []
    for i in range(12):
        own = [sentence(rng, rng.randrange(3, 30)) for _ in range(rng.randrange(2, 9))]
        extra = [passage, lone, short, ""][i % 4]
        rows.append((i, " ".join(own[:2]) + "\n" + extra + "\n" + " ".join(own[2:])))
    rows.append((99, " ".join(sentence(rng, 12) for _ in range(20))))
    found = check(spark, tmp_path, rows)
    assert [i for i in range(12) if passage in found[i].text] == [0]
    assert [i for i in range(12) if lone in found[i].text] == [1]
    assert [i for i in range(12) if short in found[i].text] == [2, 6, 10]
    for i in (3, 7, 11, 99):
        assert found[i].text == dict(rows)[i]


def test_cases(spark, tmp_path):
    rng = random.Random(6)
    a, b = (" ".join(sentence(rng, 12) for _ in range(5)) for _ in range(2))
    rows = [
        (3, a), (1, b), (2, a), (None, b), (4, None), (5, ""), (6, " \n "), (7, f"{b}\n{b}"),
        (8, "Short. " * 3), (9, "Short. " * 400), (2, a), (10, "no end " * 9000), (11, a.replace(" ", "  ")),
        (12, f"Intro here.   {a}  And an end."),
    ]
    found = check(spark, tmp_path, rows)
    assert found[4].text is None and found[5].text == "" and found[6].text == " \n "
    assert found[12].text == "Intro here.   And an end."


def test_passages_spliced_into_sentences(spark, tmp_path):
    rng = random.Random(4)

    def words(n):
        return sentence(rng, n)[:-1]

    rows = []
    # Words of the whole sentences between a glued head and a glued tail; over 50 words in all.
    for k, sizes in enumerate([(7, 8), (30,), (25,), (4, 4, 4), (11, 13)]):
        middle = " ".join(sentence(rng, n) for n in sizes)
        head, tail = words(24), words(24)
        for doc_id in (k, 10 + k):
            start, end = f"{sentence(rng, 9)} {words(5)}", f"{words(5)}. {sentence(rng, 9)}"
            rows.append((doc_id, f"{start} {head}. {middle} {tail} {end}"))
    found = check(spark, tmp_path, rows)
    assert {i for i in found if found[i].n_removed} == {10, 11, 12, 13, 14}
    assert [found[10 + k].n_removed for k in range(5)] == [2, 1, 1, 3, 2]


def test_every_stretch_of_enough_words_is_covered():
    rng = random.Random(5)
    for _ in range(300):
        plain = [" ".join("x" * rng.choice([1, 3, 6, 11, 24, 25])) for _ in range(rng.randrange(1, 8))]
        covered = set()
        for a, b in runs(plain, RUN_WORDS, LONE_WORDS):
            covered |= set(range(a, b + 1))
        n = sum(len(s.split()) for s in plain)
        if n >= (LONE_WORDS if len(plain) == 1 else RUN_WORDS):
            assert covered == set(range(len(plain)))


def test_scripts_without_blanks(spark, tmp_path):
    def letters(first, n):
        return "".join(chr(first + (i * 37) % 45) for i in range(n))

    han, kana, thai = letters(0x4E00, 30), letters(0x3041, 9), letters(0x0E01, 44)
    shared = [f"{han}。", f"{kana}。{kana[::-1]}！", f"{thai}\n{thai[::-1]}\n", "हम घर जा रहे हैं अब। " * 2 + "x।"]
    rows = []
    for k, passage in enumerate(shared):
        for doc_id in (k, 10 + k):
            rows.append((doc_id, f"{letters(0x5000 + 99 * doc_id, 8)}。{passage}"))
    docs = documents(spark, tmp_path, rows, ", n string, span string", ("n", "s"))
    found = {r.doc_id: r for r in dedup_substrings(docs).collect()}
    assert {i for i in found if found[i].n_removed and i >= 10} == {10, 11, 12, 13}
    assert [found[10 + k].n_sentences - found[10 + k].n_removed for k in range(4)] == [1, 1, 1, 1]
    assert [found[k].n_removed for k in range(3)] == [0, 0, 0]


def test_empty_table(spark, tmp_path):
    assert dedup_substrings(documents(spark, tmp_path, [])).count() == 0


def test_all_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = {r.doc_id: r for r in dedup_substrings(docs).collect()}
    for doc_id, n, left in brute(rows):
        assert (found[doc_id].n_sentences, sentences(found[doc_id].text)[0]) == (n, left)
