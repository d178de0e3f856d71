"""Substring deduplication against a plain search for windows."""

import hashlib
import random
import re

import numpy as np

from delaywright.llm.substrings import deduplicate, digests, factors, factors_of


def brute(pairs, window):
    words = [(key, re.findall(r"[^\x20\x09-\x0D]+", text or "")) for key, text in pairs]
    first = {}
    for key, own in words:
        if key is not None:
            for i in range(len(own) - window + 1):
                seq = tuple(own[i : i + window])
                first[seq] = min(first.get(seq, key), key)
    found = []
    for key, own in words:
        gone = set()
        if key is not None:
            for i in range(len(own) - window + 1):
                if first[tuple(own[i : i + window])] < key:
                    gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(own) if i not in gone)
        found.append((key, len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(found, key=repr)


def texts(draw, n):
    words = [f"v{i}" for i in range(60)]
    passages = [[draw.choice(words) for _ in range(draw.randint(10, 50))] for _ in range(12)]
    for _ in range(n):
        own = []
        for _ in range(draw.randint(0, 5)):
            own += [draw.choice(words) for _ in range(draw.randint(0, 15))]
            part = draw.choice(passages)
            a = draw.randint(0, 8)
            own += part[a : a + draw.randint(8, 60)]
        yield " ".join(own)


def test_equals_a_plain_search(make_docs):
    draw = random.Random(8)
    found = list(texts(draw, 150)) + ["x y " * 40, "x y " * 50, "x y " * 40, "Case matters " * 9, "case matters " * 9, None, "", " ", "é ü\tß " * 8] * 2
    draw.shuffle(found)
    pairs = [*enumerate(found), (None, found[0]), (7, found[7])]
    got = sorted((tuple(r) for r in digests(make_docs(pairs)).collect()), key=repr)
    assert got == brute(pairs, 13)


def test_other_window(make_docs):
    pairs = list(enumerate(texts(random.Random(9), 80)))
    got = sorted((tuple(r) for r in digests(make_docs(pairs), window=9, anchor=5).collect()), key=repr)
    assert got == brute(pairs, 9)


def test_texts_and_factors(make_docs):
    base = " ".join(f"a{i}" for i in range(30))
    docs = make_docs([(1, f"lead  {base} tail"), (2, f"other\n{base} end"), (3, None), (4, "short  text")])
    kept = {r.doc_id: r for r in deduplicate(docs).collect()}
    assert kept[1].text == f"lead  {base} tail" and kept[2].text == "other end" and kept[2].n_chars == 9
    assert kept[3].text is None and kept[4].text == "short  text"
    assert [(r.n_words, r.n_removed) for r in digests(docs).collect() if r.doc_id == 2] == [(32, 30)]
    assert [tuple(r) for r in factors(docs).collect()] == [(2, 1, 30, 1, 1)]
    assert digests(make_docs([])).count() == 0 and factors(make_docs([])).count() == 0


def test_greedy_factors():
    places = np.array([[3, 1, 10], [4, 1, 11], [5, 2, 0], [9, 2, 4]])
    assert factors_of(places, 13) == [(3, 14, 1, 10), (5, 13, 2, 0), (9, 13, 2, 4)]
    assert factors_of(places[:0], 13) == []


def test_columns_of_any_name_stay(make_docs):
    base = " ".join(f"a{i}" for i in range(30))
    names = ["n_words", "n_removed", "_places", "places", "_copies", "copies", "_source", "source_", "_id", "id"]
    docs = make_docs([(1, base), (2, f"other {base}"), (3, f"other {base}")]).selectExpr("*", *[f"doc_id AS {n}" for n in names])
    assert deduplicate(deduplicate(docs)).columns == docs.columns
    rows = {r.doc_id: r for r in deduplicate(docs).collect()}
    assert (rows[2].text, rows[2]._places, rows[2].n_removed) == ("other", 2, 2) and rows[1].text == base


def test_text_of_many_words(make_docs):
    draw = random.Random(2)
    long = " ".join(f"w{draw.randrange(50_000)}" for _ in range(120_000))
    cut = " ".join(long.split()[50_000:90_000])
    found = {r.doc_id: r for r in digests(make_docs([(1, long), (2, f"own {cut} end"), (3, long)])).collect()}
    assert (found[1].n_removed, found[2].n_removed, found[3].n_removed) == (0, 40_000, 120_000)
