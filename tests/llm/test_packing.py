"""Packing: ids against the library, whole coverage, gapless sequences, little padding."""

import random
import zlib
from array import array
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from delaywright.llm.packing import ByteCoder, combinations, make_plan, nonnegative_counts, pack

from tests.conftest import plan_text

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def library():
    """The library as the contract loads it: added tokens inside texts are tokens."""
    return Tokenizer.from_file(VOCABULARY)


def ids_of(tokenizer, text):
    return array("I", tokenizer.encode(text or "", add_special_tokens=False).ids + [0]).tobytes()


def check(docs, result, window):
    """Each id once, right checksums, sequences gapless; returns the padding."""
    tokenizer = library()
    want = defaultdict(list)
    for key, text in docs:
        want[key].append(ids_of(tokenizer, text))
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in result:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    assert set(pieces) == set(want)
    for key, texts in want.items():
        if len(texts) > 1:
            assert len(set(texts)) == 1  # repeated rows in these tests repeat the text as well
        raw, at = texts[0], 0
        assert sum(p[1] for p in pieces[key]) * 4 == sum(map(len, texts))
        for start, length, crc, tokens in sorted(set(pieces[key])):
            assert tokens * 4 == len(raw) and crc == zlib.crc32(raw[4 * start : 4 * (start + length)])
            assert len(texts) > 1 or start == at
            at = start + length
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window
        padding += window - at
    return padding


def test_ids_equal_the_library():
    coder, tokenizer, draw = ByteCoder(VOCABULARY), library(), random.Random(5)
    parts = [" ", "  ", "'s", "a", "the", "\n", "\t", "é", "日", "12", "\x85", "\xa0", "᠎", "　", "...", "ſ"]
    for _ in range(3000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 12)))
        assert coder.ids(text).tobytes() + b"\0\0\0\0" == ids_of(tokenizer, text)


def test_edge_cases(make_docs):
    docs = [(0, None), (1, ""), (2, "a b"), (2, "a b"), (3, "the " * 5000), (4, "x" * 3000), (None, "y"), (5, "long text " * 100_000)]
    docs += [(10 + i, "word " * (i % 9)) for i in range(60)]
    padding = check(docs, pack(make_docs(docs), VOCABULARY, window=16).collect(), 16)
    assert padding < 16
    assert pack(make_docs([]), VOCABULARY).count() == 0


def test_given_documents(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = [(r.doc_id, r.text) for r in frame.collect()]
    assert check(docs, pack(frame.repartition(5), VOCABULARY).collect(), 1024) < 1024


def test_no_window_holds_all_tasks(spark, sf_dir):
    """Sums over input tasks are windows over blocks of them; only one row a block is collected."""
    plan = plan_text(pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), VOCABULARY))
    assert "Window" in plan and "Exchange SinglePartition" not in plan


def test_combinations_and_counts():
    combos = combinations(12, 3)
    assert (combos.sum(axis=1) == 12).all() and len(np.unique(combos, axis=0)) == len(combos)
    assert len(combos) == 1 + 6 + 12
    # A histogram made of whole fillings is reproduced.
    true = np.zeros(len(combos))
    true[[2, 7, 11]] = [400, 700, 300]
    histogram = np.bincount(combos.ravel(), weights=np.repeat(true, 3), minlength=13)
    histogram[0] = 0
    found = nonnegative_counts(combos, histogram, steps=3000)
    again = np.bincount(combos.ravel(), weights=np.repeat(found, 3), minlength=13)
    again[0] = 0
    assert np.abs(again - histogram).max() < 1


def test_plan_fills_most_windows():
    draw = np.random.default_rng(1)
    histogram = np.bincount(draw.integers(1, 64, 5000), minlength=64)
    plan = make_plan(histogram, window=64)
    assert plan.rest_sequence > 0.9 * plan.n_sequences


def test_added_tokens_inside_texts_equal_the_library():
    coder, tokenizer, draw = ByteCoder(VOCABULARY), library(), random.Random(6)
    parts = ["<|endoftext|>"] * 3 + ["<|endoftext|", "|>", "<", " ", "  ", "\n", "a", "the", "'s", "日", "12", "\xa0", "endoftext"]
    texts = ["", "<|endoftext|>", "<|endoftext|>" * 3, " <|endoftext|> x", "a <|endoftext|>", "<|<|endoftext|>endoftext|>"]
    for text in texts + ["".join(draw.choice(parts) for _ in range(draw.randint(0, 12))) for _ in range(3000)]:
        assert coder.ids(text).tobytes() + b"\0\0\0\0" == ids_of(tokenizer, text)
    assert coder.ids("a<|endoftext|>b")[1] == 50256


def test_packs_added_tokens(make_docs):
    docs = [(i, "word <|endoftext|> " * (i % 7) + "end" * (i % 2)) for i in range(40)]
    docs += [(50, "<|endoftext|>" * 200), (51, None), (None, "a<|endoftext|>b")]
    assert check(docs, pack(make_docs(docs), VOCABULARY, window=16).collect(), 16) < 16
