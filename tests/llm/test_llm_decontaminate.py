import re

from helpers import documents, saved

from txnlake.llm import decontaminate as module
from txnlake.llm.decontaminate import clean_rows, decontaminate, words_hit

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window):
    windows = {}
    for item_id, text in items:
        w = words(text)
        for i in range(max(len(w) - window, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + window]), set()).add(item_id)
    out = []
    for _, text in docs:
        w, hit, found = words(text), set(), set()
        for win, ids in windows.items():
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i : i + len(win)]) == win:
                    hit |= set(range(i, i + len(win)))
                    found |= ids
        out.append((len(w), len(hit), tuple(sorted(str(i) for i in found if i is not None))))
    return sorted(out)


LONG = " ".join(f"w{i}" for i in range(30))
ITEMS = [
    (1, LONG), (2, "w5 w6 w7"), (10, "Solo"), (3, None), (4, ""), (5, "..."), (None, "Nameless one"),
    (6, "a a a a a a a a a a a"), (6, "second text of six"), (1, LONG), (7, "w20 w21 w22 w23"),
    (8, "w0 w1 w2 w3 w4 w5 w6 w7 w8 never"),
]
TEXTS = [
    LONG, LONG.upper(), LONG.replace(" ", "\n, "), " ".join(LONG.split()[:10]), "w5 w6", "solo",
    " ".join(LONG.split()[:9]), None, "", "  ", "a " * 25, "nameless ONE!", "x w20 w21 w22 w23 y",
    "second text of six solo second text of six", "solo " * 3000, LONG, "filler " * 5000 + LONG,
    "w0 w1 w2 w3 w4 w5 w6 w7 w8", "w5w6 w7",
]


def run(spark, folder, texts, items, **parameters):
    docs = documents(spark, folder, [(7, t) for t in texts], ", h long, window string", (1, "w"))
    table = saved(spark, folder, items, "item_id long, text string")
    found = decontaminate(docs, table, **parameters)
    rows = found.select("n_words", words_hit(found["hits"]), "item_ids").collect()
    return sorted((r[0], r[1], tuple(r[2])) for r in rows), docs, table


def test_cases_against_brute_force(spark, tmp_path):
    found, docs, items = run(spark, tmp_path, TEXTS, ITEMS)
    wanted = brute([(0, t) for t in TEXTS], ITEMS, 10)
    assert found == wanted
    clean = clean_rows(docs, items)
    assert clean.columns == docs.columns
    assert clean.count() == sum(w[1] == 0 for w in wanted)


def test_other_parameters(spark, tmp_path):
    for window, shingle in ((4, 2), (3, 5), (10, 10)):
        found, _, _ = run(spark, tmp_path, TEXTS, ITEMS, window=window, shingle=shingle)
        assert found == brute([(0, t) for t in TEXTS], ITEMS, window)


def test_no_items_or_no_documents(spark, tmp_path):
    found, docs, items = run(spark, tmp_path, TEXTS, [])
    assert found == brute([(0, t) for t in TEXTS], [], 10)
    assert run(spark, tmp_path, [], ITEMS)[0] == []


def test_an_item_of_one_word_sends_that_word_only(spark, tmp_path, monkeypatch):
    sent, probes = [], module._probes

    def kept(*parameters):
        sent.append(probes(*parameters))
        return sent[-1]

    monkeypatch.setattr(module, "_probes", kept)
    texts = ["the cat sat on the mat and the dog " * 40, LONG]
    items = [(1, "the"), (2, " ".join(LONG.split()[:12]))]
    found, _, _ = run(spark, tmp_path, texts, items)
    assert found == brute([(0, t) for t in texts], items, 10)
    around = sent[0].selectExpr("explode(probes.around) a").collect()
    assert sum(row.a == "the" for row in around) == 120
    # The three windows of the other item, each with ten words.
    assert max(len(row.a.split()) for row in around) <= 19
