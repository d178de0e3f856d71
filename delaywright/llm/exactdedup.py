"""Exact duplicates by a minimal perfect hash over the distinct digests of what is already held.

The digests of the held texts are dealt to shards by hash; each shard's distinct digests get a
minimal perfect hash of their own: level by level, digests that fall alone on a bit own it, the
others go on to the next level, and the rank of a digest's bit is its slot. A slot holds the full
digest, the locator of the row that stays, and the number of copies.

Arriving texts are summed up by digest before they are dealt to the shards. A digest whose slot
holds the same 32 bytes is a repeat and meets the slot's locator; any other arrival lands on some
slot by chance, fails the byte check, and stays a group of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaywright.llm.frames import unused
from delaywright.llm.wordhash import mix
from delaywright.operators.skew import ROWS_PER_TASK, attach
from delaywright.runtime import spool

#: Rows whose distinct digests share one perfect hash: about 1 MB of slots, whatever the corpus.
ROWS_PER_SHARD = 16_384
#: Bits of a level for each digest that is still to be placed.
ROOM = 2.0
BYTES = 32


@dataclass(frozen=True)
class PerfectHash:
    """Bits of all levels, one after the other; ``sizes`` are the levels' lengths in bits."""

    sizes: list[int]
    bits: np.ndarray

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """The slot of each digest (rows of four words): the right one for a member, some slot or
        -1 for any other."""
        ranks = np.cumsum(self.bits) - 1
        found = np.full(len(digests), -1, dtype=np.int64)
        left, base = np.arange(len(digests)), 0
        for level, size in enumerate(self.sizes):
            place = base + _places(digests[left], level, size)
            here = self.bits[place]
            found[left[here]] = ranks[place[here]]
            left, base = left[~here], base + size
        return found


def _places(digests: np.ndarray, level: int, size: int) -> np.ndarray:
    h = np.full(len(digests), (level + 1) * 0x9E3779B97F4A7C15 % (1 << 64), dtype=np.uint64)
    for word in range(digests.shape[1]):
        h = mix(h ^ digests[:, word])
    return (h % np.uint64(size)).astype(np.int64)


def perfect_hash(digests: np.ndarray) -> PerfectHash:
    """The minimal perfect hash of distinct digests, given as rows of four words."""
    left, sizes, levels = digests, [], []
    while len(left):
        if len(sizes) > 500:
            raise ValueError("the digests are not distinct")
        size = int(ROOM * len(left)) + 8
        place = _places(left, len(sizes), size)
        alone = np.bincount(place, minlength=size) == 1
        sizes.append(size)
        levels.append(alone)
        left = left[~alone[place]]
    return PerfectHash(sizes, np.concatenate(levels) if levels else np.empty(0, dtype=bool))


def _words(digests: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Binary digests as rows of four 64-bit words."""
    joined = b"".join(digests.to_pylist())
    return np.frombuffer(joined, dtype="<u8").reshape(-1, BYTES // 8)


# ---------------------------------------------------------------- digests and their groups


def digest_of(text: str = "text") -> Column:
    """SHA-256 of the text's UTF-8 as 32 bytes; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256))


def digests(docs: DataFrame, held: Column) -> DataFrame:
    """``doc_id, digest, held, place`` of every row of ``docs``, written once: ``place`` numbers
    the rows, so that rows which agree in everything can be told apart."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), digest_of().alias("digest"), F.coalesce(held, F.lit(False)).alias("held")
    )
    return spool(rows.withColumn("place", F.monotonically_increasing_id()), "digests")


def _groups(rows: DataFrame, shards: int) -> DataFrame:
    """One row for each distinct digest; summed up in every task before the shuffle."""
    # Of rows with the largest id the first one stays; a null id is smaller than any other.
    stays = F.max(F.struct("doc_id", (-F.col("place")).alias("minus"))).alias("stays")
    return rows.groupBy("digest").agg(stays, F.count(F.lit(1)).alias("copies")).select(
        F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int").alias("shard"),
        "digest",
        F.col("stays.doc_id").alias("doc_id"),
        (-F.col("stays.minus")).alias("place"),
        "copies",
    )


# ---------------------------------------------------------------- the index


@dataclass(frozen=True)
class Index:
    """``frame`` has a row for each shard: the levels and bits of its perfect hash and, slot by
    slot, digests, locators (``doc_ids``, ``places``) and ``copies``."""

    frame: DataFrame
    shards: int


_INDEX = "shard int, levels array<int>, bits binary, digests binary, doc_ids array<long>, places array<long>, copies array<long>"


def build_index(rows: DataFrame, shards: int) -> Index:
    """The index of ``rows`` (``doc_id, digest, place``)."""

    def build(key: tuple, group: pa.Table) -> pa.Table:
        own = _words(group.column("digest"))
        found = perfect_hash(own)
        order = pa.array(np.argsort(found.slots(own)))
        group = group.take(order)
        columns = [
            [key[0].as_py()],
            [found.sizes],
            [np.packbits(found.bits).tobytes()],
            [b"".join(group.column("digest").to_pylist())],
            *[[group.column(c).to_pylist()] for c in ("doc_id", "place", "copies")],
        ]
        kinds = [pa.int32(), pa.list_(pa.int32()), pa.binary(), pa.binary(), *[pa.list_(pa.int64())] * 3]
        names = [c.split()[0] for c in _INDEX.split(", ")]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return Index(spool(_groups(rows, shards).groupBy("shard").applyInArrow(build, _INDEX), "hashindex"), shards)


_FOUND = "digest binary, keep_id long, keep_place long, group_size long, known boolean"


def merge(index: Index, arrivals: DataFrame) -> DataFrame:
    """``digest, keep_id, keep_place, group_size, known`` of every digest that is held or arrives
    (``arrivals`` as for :func:`build_index`). ``known`` marks what the index holds; locators
    and sizes of known digests count their arrivals too, the others are groups of arrivals."""

    def look_up(old: pa.Table, new: pa.Table) -> pa.Table:
        own = {c: new.column(c).to_pylist() for c in ("digest", "doc_id", "place", "copies")}
        ids, places, copies, held = [], [], [], []
        if old.num_rows:
            row = old.to_pylist()[0]
            held = [row["digests"][i : i + BYTES] for i in range(0, len(row["digests"]), BYTES)]
            ids, places, copies = row["doc_ids"], row["places"], row["copies"]
            size = sum(row["levels"])
            bits = np.unpackbits(np.frombuffer(row["bits"], dtype=np.uint8), count=size).astype(bool)
            slots = PerfectHash(row["levels"], bits).slots(_words(new.column("digest"))).tolist()
        else:
            slots = [-1] * new.num_rows
        strangers = []
        for i, slot in enumerate(slots):
            if slot < 0 or held[slot] != own["digest"][i]:
                strangers.append(i)
                continue
            copies[slot] += own["copies"][i]
            if _stays(own["doc_id"][i], own["place"][i], ids[slot], places[slot]):
                ids[slot], places[slot] = own["doc_id"][i], own["place"][i]
        columns = [
            held + [own["digest"][i] for i in strangers],
            ids + [own["doc_id"][i] for i in strangers],
            places + [own["place"][i] for i in strangers],
            copies + [own["copies"][i] for i in strangers],
            [True] * len(held) + [False] * len(strangers),
        ]
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
        names = [c.split()[0] for c in _FOUND.split(", ")]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    new = _groups(arrivals, index.shards)
    return index.frame.groupBy("shard").cogroup(new.groupBy("shard")).applyInArrow(look_up, _FOUND)


def _stays(doc_id: int | None, place: int, other_id: int | None, other_place: int) -> bool:
    """Whether the first of two rows with one text stays: the larger id, then the earlier place."""
    mine, theirs = (doc_id is not None, doc_id or 0), (other_id is not None, other_id or 0)
    return mine > theirs or (mine == theirs and place < other_place)


# ---------------------------------------------------------------- documents


def first_half(docs: DataFrame) -> Column:
    """Whether a row's id lies below the middle of all ids: what came earlier, where ids ascend."""
    ends = docs.select(F.min("doc_id").cast("long").alias("least"), F.max("doc_id").cast("long").alias("most")).first()
    return F.col("doc_id") <= ((ends["least"] or 0) + (ends["most"] or 0)) // 2


def exact_duplicates(
    docs: DataFrame, held: Column | None = None, rows_per_shard: int = ROWS_PER_SHARD, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row of ``docs``.

    Rows are equal when their whole texts are; null counts as empty, so null and empty texts are
    one group. Of equal rows the one with the largest id stays (``keep_id``), and just one row of
    a group is ``kept`` even if rows repeat that id. A null id is smaller than any other: a group
    of null ids alone has a null ``keep_id``. ``held`` tells which rows the index is built of, by
    default those with the lower half of the ids; the result does not depend on it. An empty
    table gives no rows; columns besides ``doc_id`` and ``text`` are not read.
    """
    rows, winners = _resolve(docs, held, rows_per_shard)
    joined = attach(rows.select("doc_id", "digest", "place"), winners, ["digest"], "group_size", ["place"], rows_per_task)
    return joined.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("place") == F.col("keep_place")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def _resolve(docs: DataFrame, held: Column | None, rows_per_shard: int) -> tuple[DataFrame, DataFrame]:
    rows = digests(docs, first_half(docs) if held is None else held)
    shards = max(1, -(-rows.count() // rows_per_shard))
    index = build_index(rows.filter("held"), shards)
    winners = merge(index, rows.filter("not held")).drop("known")
    return rows, spool(winners, "winners")


def keep_one(docs: DataFrame, held: Column | None = None, rows_per_shard: int = ROWS_PER_SHARD) -> DataFrame:
    """One row of ``docs`` for each distinct text, with all its columns: that of the largest id."""
    _, winners = _resolve(docs, held, rows_per_shard)
    digest, owner = unused("digest", docs), unused("owner", docs)
    named = docs.withColumn(digest, digest_of())
    stays = winners.select(F.col("digest").alias(digest), F.col("keep_id").alias(owner))
    same = (named[digest] == stays[digest]) & named["doc_id"].cast("long").eqNullSafe(stays[owner])
    # Rows may repeat an id and its text.
    one = named.join(stays, same, "left_semi").dropDuplicates([digest])
    return one.drop(digest)


def oracle_sql() -> str:
    """DuckDB SQL for :func:`exact_duplicates` over ``documents`` with distinct ids."""
    return """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.text) AS text_sha256
FROM t JOIN g ON g.text = t.text
"""
