"""Near-duplicates against all pairs on full sets."""

import random
import re

import pytest

from delaywright.llm import minhash
from delaywright.llm.minhash import Settings, keep_one, near_duplicates

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute(pairs, size):
    sets = {key: shingles(text, size) for key, text in pairs if key is not None}
    parent = {key: key for key in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {key: (len(sets[key]), root(key)) for key in keys}


def chain(draw, words, steps, change):
    """Texts that drift: neighbours are near-duplicates, far ones are not."""
    text = [draw.choice(words) for _ in range(120)]
    for _ in range(steps):
        yield " ".join(text)
        for _ in range(change):
            text[draw.randrange(len(text))] = draw.choice(words)


@pytest.mark.parametrize("size", [2, 5])
def test_equals_all_pairs(make_docs, size):
    draw = random.Random(size)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(draw.choice(words) for _ in range(draw.randint(1, 80))) for _ in range(60)]
    for _ in range(4):
        texts += chain(draw, words, 12, 4 if size == 2 else 2)
    texts += ["Same  TEXT here", "same text\nhere", "one", "ONE", "É one", "é one", "a b", "b a", "", None, " \t"] + ["copy of a text " * 9] * 30
    draw.shuffle(texts)
    pairs = list(enumerate(texts))
    found = near_duplicates(make_docs(pairs), Settings(shingle=size)).collect()
    want = brute(pairs, size)
    assert len(found) == len(pairs)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_edge_cases(make_docs):
    docs = make_docs([(4, "a b c d e f"), (4, "a b c d e f"), (None, "a b c d e f"), (9, "a b c d e f"), (2, None), (3, "")])
    found = sorted((str(r.doc_id), r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs).collect())
    assert found == [
        ("2", 0, 2, True), ("3", 0, 3, True), ("4", 2, 4, True), ("4", 2, 4, True), ("9", 2, 4, False), ("None", 2, None, True),
    ]
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "4", "4", "None"]
    assert near_duplicates(make_docs([])).count() == 0


def test_repeated_ids_with_other_texts(make_docs):
    """Groups of edited texts, ids given to several rows: every text keeps its own links."""
    draw = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    texts = [t for _ in range(12) for t in chain(draw, words, 14, 2)]
    pairs = [(draw.randrange(60), t) for t in texts]
    found = near_duplicates(make_docs(pairs)).collect()
    plain = brute(list(enumerate(texts)), 5)
    least = {}
    for (key, _), (_, root) in zip(pairs, plain.values(), strict=True):
        least[root] = min(key, least.get(root, key))
    want = sorted((key, n, least[root]) for (key, _), (n, root) in zip(pairs, plain.values(), strict=True))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == want


def test_keeps_the_unlike_text_of_a_repeated_id(make_docs):
    docs = make_docs([(4, "a b c d e f g"), (9, "a b c d e f g"), (9, "quite another text with words of its own")])
    docs = docs.selectExpr("*", "1 AS hash", "2 AS id", "3 AS _hash")
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text[0]) for r in kept.collect()) == [(4, "a"), (9, "q")]


@pytest.mark.parametrize("block", [60, 2048])
def test_group_just_below_the_threshold(make_docs, monkeypatch, block):
    """Many texts that share most shingles without being linked, and a few that are: one group's
    pairs are verified inside tasks, in one block and in pairs of blocks."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    draw = random.Random(4)
    base = [f"b{i}" for i in range(60)]
    texts = []
    for n in range(300):
        text = list(base)
        text[draw.randrange(5, 25)], text[draw.randrange(35, 55)] = f"x{n}", f"y{n}"
        texts.append(" ".join(text))
        if n % 10 == 0:
            texts.append(" ".join([*text, f"z{n}"]))
    pairs = list(enumerate(texts))
    found = near_duplicates(make_docs(pairs), Settings(shingle=5)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(pairs, 5)
    assert len({r.component_id for r in found}) > 100


def test_long_text(make_docs):
    draw = random.Random(1)
    text = " ".join(f"w{draw.randrange(100_000)}" for _ in range(200_000))
    found = near_duplicates(make_docs([(1, text), (2, text + " end"), (3, "short"), (4, text[: len(text) // 2])])).collect()
    assert {r.doc_id: r.component_id for r in found} == {1: 1, 2: 1, 3: 3, 4: 4}


def test_bounds():
    assert Settings().most_different() < 64 * Settings().words // 2
    assert (1 - 0.8 ** Settings().rows) ** Settings().bands < 1e-7
