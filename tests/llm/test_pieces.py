"""Encoding by distinct chunks against the library on whole texts."""

import hashlib
import random

import public_tokenizers
import sentencepiece

from delaywright.llm.chunktable import ChunkTable
from delaywright.llm.pieces import PieceCoder, encode_digests, encode_documents

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", "a", " a ", "a  b", "▁", "a▁b ▁ c", "\n", "x\n y\t z", "日本 語", "😀 <s> </s> <0x0A>",
    "\u0000 a", "ﬁ é é", "word " * 3000, "w" * 4000,
]


def test_random_texts_equal_the_library():
    coder, draw = PieceCoder(MODEL, table_limit=50), random.Random(7)
    parts = [" ", "  ", "▁", "a", "the", "\n", "\t", "é", "日", "😀", "<s>", "\r", "​", "　"]
    for _ in range(3000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 12)))
        ids = coder.processor.encode(text)
        n, joined, plain = coder.code(text)
        assert (n, joined.decode(), plain) == (len(ids), ",".join(map(str, ids)), coder.processor.decode(ids))
        assert coder.encode(text) == ids


def test_documents(spark, make_docs):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = make_docs([*enumerate(ODD), (3, " "), (None, "no id")])
    digests = sorted(map(tuple, encode_digests(docs, MODEL).collect()), key=str)
    full = sorted(map(tuple, encode_documents(docs, MODEL).collect()), key=str)
    want_digests, want_full = [], []
    for key, text in [*enumerate(ODD), (3, " "), (None, "no id")]:
        ids = library.encode(text or "")
        joined, plain = ",".join(map(str, ids)), library.decode(ids)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (joined, plain)]
        want_digests.append((key, len(ids), *sha))
        want_full.append((key, len(ids), ids, joined, plain))
    assert digests == sorted(want_digests, key=str)
    assert full == sorted(want_full, key=str)


def test_empty_table(make_docs):
    assert encode_digests(make_docs([]), MODEL).count() == 0


def test_table_forgets_but_stays_right():
    asked = []
    table = ChunkTable(lambda c: (asked.extend(c), [x * 2 for x in c])[1], limit=4)
    draw = random.Random(3)
    for _ in range(200):
        chunks = [draw.choice("abcdefghij") for _ in range(draw.randint(0, 6))]
        assert table.values_of(chunks) == [x * 2 for x in chunks]
        assert len(table) <= 8
    assert len(asked) > 10
