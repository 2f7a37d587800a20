import random
import re

import numpy as np
import pytest
from helpers import documents

from txnlake.llm import license_scan
from txnlake.llm.license_scan import PHRASES, TEMPLATES, Automaton, Scanner, scan
from txnlake.llm.queries import op12_license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return WORD.findall(low)


def phrase_places(own):
    out = []
    for label, phrase in PHRASES:
        wanted = phrase.split()
        out += [(label, i) for i in range(len(own)) if own[i : i + len(wanted)] == wanted]
    return sorted(out)


def longest_ending(own, end, sequences):
    """The matching statistic, the plain way."""
    for size in range(end, 0, -1):
        run = own[end - size : end]
        if any(run == s[i : i + size] for s in sequences for i in range(len(s) - size + 1)):
            return size
    return 0


def plain_chains(own, template):
    """All spans and the best share of one template, over all pairs of matches."""
    wanted = words(template)
    everything = [words(t) for _, t in [*TEMPLATES, *PHRASES]]
    longest = [longest_ending(own, e, everything) for e in range(len(own) + 1)] + [0]
    runs = [(e - longest[e], e) for e in range(1, len(own) + 1)
            if longest[e] >= license_scan.MIN_MATCH and longest[e + 1] <= longest[e]]
    matches = sorted(
        (a, b, i + b - a) for a, b in runs for i in range(len(wanted)) if wanted[i : i + b - a] == own[a:b]
    )
    best = []
    for i, (a, b, at) in enumerate(matches):
        size = b - a
        choices = [(size, -1)]
        for j, (x, y, before) in enumerate(matches[:i]):
            gap, skipped = a - y, at - size - before
            if x < a and y < b and before < at and before - (y - x) < at - size:
                if gap <= license_scan.MAX_GAP and skipped <= license_scan.MAX_GAP:
                    choices.append((best[j][0] + size + min(0, gap, skipped), j))
        total = max(c[0] for c in choices)
        best.append((total, next(j for t, j in choices if t == total)))
    share = max((t / len(wanted) for t, _ in best), default=0.0)
    last = set(range(len(best))) - {j for _, j in best}
    ends = {(matches[i][1], best[i][0]) for i in last
            if best[i][0] >= license_scan.MIN_SHARE * len(wanted)}
    return share, ends


def check(found, texts):
    by_text = {}
    for doc_id, text in texts:
        by_text.setdefault(doc_id, []).append(text)
    assert len(found) == len(texts)
    for r in found:
        own = words(by_text[r.doc_id][0])
        assert len({tuple(words(t)) for t in by_text[r.doc_id]}) == 1
        assert r.n_words == len(own)
        assert sorted((p.label, p.start) for p in r.phrases) == phrase_places(own)
        best = 1.0 if r.phrases else 0.0
        for number, (label, template) in enumerate(TEMPLATES):
            share, ends = plain_chains(own, template)
            best = max(best, share)
            assert {(s.stop, s.covered) for s in r.spans if s.template == number} == ends
            assert all(s.label == label for s in r.spans if s.template == number)
        assert r.score == pytest.approx(best)


def spliced(rng):
    """Parts of templates, some words changed, among other words."""
    out = []
    for _ in range(rng.randrange(1, 5)):
        own = words(rng.choice([*TEMPLATES, *PHRASES])[1])
        a = rng.randrange(len(own))
        own = own[a : a + rng.randrange(1, 40)] if rng.random() < 0.6 else list(own)
        for _ in range(rng.randrange(3)):
            own[rng.randrange(len(own))] = rng.choice(["der", "the", "software", "license"])
        out += own + ["und", "so", "weiter"][: rng.randrange(4)]
    return " ".join(w.upper() if rng.random() < 0.2 else w for w in out)


def test_against_plain_search(spark, tmp_path):
    rng = random.Random(1)
    texts = [(i, spliced(rng)) for i in range(250)]
    check(scan(documents(spark, tmp_path, texts)).collect(), texts)


def test_cases(spark, tmp_path):
    notice = TEMPLATES[3][1]
    texts = [
        (1, None), (2, ""), (3, " .,"), (4, "CC-BY cc by, Cc By"), (5, "ccby cc by"),
        (6, notice), (6, notice), (None, "all rights reserved"), (7, "general public licence"),
        (8, f"über {notice.upper()} — {notice}"), (9, "CC" + " x" * 50 + " by"),
        (10, "Licensed under CC BY-NC 4.0."), (11, "released under the new mit license"),
    ]
    docs = documents(spark, tmp_path, texts, ", _rid string, spans int, phrases string", ("r", 1, "p"))
    found = scan(docs).collect()
    check(found, texts)
    by_id = {r.doc_id: r for r in found}
    assert [s.label for s in by_id[8].spans] == ["mit", "mit"]
    assert [p.start for p in by_id[4].phrases] == [0, 2, 4] and not by_id[5].phrases
    assert {s.label for s in by_id[10].spans} == {"cc-by-nc"}


def test_empty_table(spark, tmp_path):
    assert scan(documents(spark, tmp_path, [])).count() == 0


def test_a_long_text_is_cut_between_words(spark, tmp_path, monkeypatch):
    rng = random.Random(2)
    text = " filler words ".join(spliced(rng) for _ in range(60)) + "x" * 300 + " cc by"
    scanner = Scanner(TEMPLATES, PHRASES)
    data = np.frombuffer(text.encode(), np.uint8)
    whole, _ = scanner.tokens(data, np.array([0, len(data)]))
    for limit in (1, 7, 100, 1 << 20):
        cuts = license_scan.cuts_between_words(data, limit)
        parts = [scanner.tokens(data[a:b], np.array([0, b - a]))[0] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        assert np.array_equal(np.concatenate(parts), whole)


def test_one_text_of_twenty_megabytes(spark, tmp_path):
    notice = TEMPLATES[0][1]
    text = ("some words without a notice " * 50 + notice + ". ") * 13_000 + "all rights reserved"
    found = scan(documents(spark, tmp_path, [(1, text), (2, "x")], files=1)).filter("doc_id = 1").first()
    assert found.n_words == len(text.split()) + 13_000  # 2.0 is two words
    assert len(found.spans) == 13_000 and found.phrases[0].start == found.n_words - 3


def test_the_automaton_has_all_runs_and_their_places():
    rng = random.Random(3)
    sequences = [[rng.randrange(3) for _ in range(rng.randrange(2, 12))] for _ in range(12)]
    automaton = Automaton(sequences)
    text = [rng.randrange(3) for _ in range(300)]
    for end, (state, length) in enumerate(automaton.stream(text), 1):
        assert length == longest_ending(text, end, sequences)
        run = text[end - length : end]
        places = {(n, i + length) for n, s in enumerate(sequences)
                  for i in range(len(s) - length + 1) if s[i : i + length] == run}
        assert length == 0 or automaton.places[state] == places


def test_one_word_is_no_phrase():
    with pytest.raises(ValueError):
        Scanner([], [("x", "word")])


def test_the_query(spark, sf_dir):
    docs = {r.doc_id: words(r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = op12_license_scan(spark, sf_dir).collect()
    assert len(found) == len(docs)
    for r in found:
        places = phrase_places(docs[r.doc_id])
        starts = [at for _, at in places]
        assert (r.n_words, r.n_base) == (len(docs[r.doc_id]), len(places))
        assert (r.first_word, r.last_word) == (min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({label for label, _ in places}))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}
        assert 0 <= r.score <= 1
