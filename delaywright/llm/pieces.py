"""SentencePiece encoding and decoding through a table of distinct chunks.

No piece of the model may hold a whitespace marker after another character; then no merge crosses
the start of a marked word, and each distinct marked word can be segmented once, alone. A text is
cut into its marked words, the words the table lacks are segmented in one call, and the ids are
joined back by position. The table lives in the task and is bounded, so no position of the corpus
is ever shuffled (a corpus-wide table would have to send every word position through two joins).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from delaywright.llm.chunktable import ChunkTable
from delaywright.llm.frames import rows, texts

MARK = "▁"
TABLE_LIMIT = 500_000
#: Characters of neighbouring texts that are looked up together.
SLICE = 500_000
_CHUNK = re.compile(f"[ {MARK}]+[^ {MARK}]*")


class PieceCoder:
    """Encodes and decodes whole texts exactly as the library does, chunk by chunk."""

    def __init__(self, model_file: str, table_limit: int = TABLE_LIMIT):
        self.processor = sentencepiece.SentencePieceProcessor(model_file=model_file)
        p = self.processor
        names = [p.id_to_piece(i) for i in range(p.get_piece_size())]
        special = [p.is_control(i) or p.is_unknown(i) for i in range(len(names))]
        if any(re.search(f"[^{MARK}]{MARK}", n) for n in names):
            raise ValueError("pieces of this model cross whitespace markers")
        if p.encode("a", out_type=str) != [f"{MARK}a"] or p.encode(" a ", out_type=str)[-1] != MARK:
            raise ValueError("the model must mark the first word and keep white space")
        if p.encode("Ａ", out_type=str)[-1] in ("A", f"{MARK}A") or not any(map(p.is_byte, range(len(names)))):
            raise ValueError("the model must fall back to bytes and not normalise")
        self._decimal = [b"%d" % i for i in range(len(names))]
        # Without one of these a chunk's pieces are its own substrings.
        self._odd = frozenset(i for i in range(len(names)) if special[i] or p.is_byte(i))
        self._mark_id = p.piece_to_id(MARK)
        self._surface = [
            b"" if special[i] else bytes([int(n[3:-1], 16)]) if p.is_byte(i) else n.replace(MARK, " ").encode()
            for i, n in enumerate(names)
        ]
        self._table = ChunkTable(self._segment, table_limit)

    def _segment(self, chunks: list[str]) -> list[bytes | tuple[bytes, str]]:
        """For chunks without their leading marker: their decimal ids, joined by commas.

        A chunk that does not decode to itself gets (decimal ids, decoded text).
        """
        found: list[bytes | tuple[bytes, str]] = []
        for chunk, ids in zip(chunks, self.processor.encode(chunks, num_threads=1), strict=True):
            ids = ids if chunk else [self._mark_id]
            joined = b",".join(map(self._decimal.__getitem__, ids))
            if self._odd.isdisjoint(ids):
                found.append(joined)
                continue
            plain = b"".join(map(self._surface.__getitem__, ids)).decode("utf-8", "replace")
            found.append(joined if plain[1:] == chunk else (joined, plain))
        return found

    def chunks(self, text: str) -> list[str]:
        """The marked words of ``text``, each without its first marker."""
        if "  " not in text and MARK not in text and text[:1] != " " and text[-1:] != " ":
            return text.split(" ")
        return [c[1:].replace(MARK, " ") for c in _CHUNK.findall(" " + text)]

    def code(self, text: str) -> tuple[int, bytes, str]:
        """(number of ids, decimal ids joined by commas, decoded text)."""
        return self.code_all([text])[0]

    def code_all(self, texts: list[str]) -> list[tuple[int, bytes, str]]:
        """:meth:`code` of several texts; what the table lacks of all of them is segmented in one call."""
        parts = [self.chunks(text) if text else [] for text in texts]
        values = self._table.values_of([chunk for part in parts for chunk in part])
        coded, at = [], 0
        for text, chunks in zip(texts, parts, strict=True):
            found = values[at : at + len(chunks)]
            at += len(chunks)
            if not found:
                coded.append((0, b"", ""))
                continue
            plain = text.replace(MARK, " ")
            if tuple in set(map(type, found)):
                plain = "".join(f[1] if type(f) is tuple else " " + c for c, f in zip(chunks, found, strict=True))[1:]
                found = [f[0] if type(f) is tuple else f for f in found]
            joined = b",".join(found)
            coded.append((joined.count(b",") + 1, joined, plain))
        return coded

    def encode(self, text: str) -> list[int]:
        n, ids, _ = self.code(text)
        return [int(i) for i in ids.split(b",")] if n else []


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of neighbouring rows, up to ``SLICE`` characters or one text."""
    keys, part, size = [], [], 0
    for key, text in rows(iter([batch]), "doc_id", "text"):
        if part and size + len(text) > SLICE:
            yield keys, part
            keys, part, size = [], [], 0
        keys.append(key)
        part.append(text)
        size += len(text)
    if part:
        yield keys, part


_CODERS: dict[tuple[str, int], PieceCoder] = {}


def _coder(model_file: str, table_limit: int) -> PieceCoder:
    """One coder for each Python worker, kept for its next tasks."""
    key = (model_file, table_limit)
    if key not in _CODERS:
        _CODERS[key] = PieceCoder(*key)
    return _CODERS[key]


def encode_documents(
    docs: DataFrame, model_file: str, table_limit: int = TABLE_LIMIT, ids: bool = True
) -> DataFrame:
    """``doc_id, n_tokens, ids, ids_text, decoded`` of every row of ``docs``.

    ``ids`` (array of int) is left null with ``ids=False``; ``ids_text`` holds the decimal ids
    joined by commas. Null and empty texts have no ids and decode to the empty text; repeated rows
    stay repeated; a null ``doc_id`` stays null; an empty table gives no rows; columns of ``docs``
    besides ``doc_id`` and ``text`` are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(model_file, table_limit)
        for batch in batches:
            for keys, part in _slices(batch):
                found = []
                for key, (n, joined, plain) in zip(keys, coder.code_all(part), strict=True):
                    listed = [int(i) for i in joined.split(b",")] if ids and n else [] if ids else None
                    found.append((key, n, listed, joined.decode(), plain))
                yield _batch(found)

    return texts(docs).mapInArrow(
        run, "doc_id long, n_tokens long, ids array<int>, ids_text string, decoded string"
    )


def _batch(found: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.string(), pa.string())
    names = ["doc_id", "n_tokens", "ids", "ids_text", "decoded"]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)], names
    )


def encode_digests(docs: DataFrame, model_file: str, table_limit: int = TABLE_LIMIT) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row of ``docs``.

    The digests are taken where the ids are made, so that ids and texts need not leave the task.
    Edge cases as in :func:`encode_documents`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(model_file, table_limit)
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for keys, part in _slices(batch):
                for key, (n, joined, plain) in zip(keys, coder.code_all(part), strict=True):
                    out[0].append(key)
                    out[1].append(n)
                    out[2].append(hashlib.sha256(joined).hexdigest())
                    out[3].append(hashlib.sha256(plain.encode("utf-8", "surrogatepass")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2]), pa.array(out[3])],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return texts(docs).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
