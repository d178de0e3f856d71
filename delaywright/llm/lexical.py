"""Ranked lexical search by a hybrid of term-at-a-time and document-at-a-time evaluation.

The documents are cut into shards, and a shard holds an inverted list for each query term: its
documents in ascending order with the term's impact there. For an item, the short lists are merged
term at a time into summed accumulators. These accumulators are then one more iterator, in document
order and with a known largest value, beside the long lists. Document at a time, the iterators move
over ranges of documents: those whose largest values cannot reach the item's 50th score together
only answer for documents that the others propose, and are skipped over otherwise.

Statistics come from all documents. A shard's best documents of each item go to the final ranking;
scores are exact 64-bit integers, so the ranking does not depend on how documents are dealt.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaywright.llm.frames import rows, texts
from delaywright.runtime import release, spool

TOP = 50
#: Postings of a shard, and documents of a range that iterators are moved over at a time.
POSTINGS_PER_SHARD = 4_000_000
RANGE = 4096
#: Lists are short while all of them together have at most this share of a shard's documents.
SHORT = 0.125
#: Characters of the items that are answered together; their terms are sent to every task.
CHARS_PER_BLOCK = 4_000_000
#: Groups of tasks whose best documents are ranked before the final ranking.
SALTS = 256

#: Bytes that end a term (fixed values: ASCII but for digits and letters); A-Z are lower-cased.
_KEPT = {*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
_FOLD = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if b in _KEPT else 0x20 for b in range(256))


def terms(text: str) -> list[bytes]:
    """The terms of a text in order, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


# ---------------------------------------------------------------- one shard


class Shard:
    """Inverted lists of documents given in ascending order of ``ids``.

    ``terms``, ``places`` and ``impacts`` have an entry for each posting: its term, the document's
    number within the shard and the impact there.
    """

    def __init__(self, ids: np.ndarray, terms: np.ndarray, places: np.ndarray, impacts: np.ndarray):
        order = np.argsort(terms, kind="stable")
        terms, self._places, self._impacts = terms[order], places[order], impacts[order]
        found, starts = np.unique(terms, return_index=True)
        most = np.maximum.reduceat(self._impacts, starts) if len(starts) else []
        ends = np.append(starts, len(terms))[1:].tolist()
        self._lists = dict(zip(found.tolist(), zip(starts.tolist(), ends, (int(m) for m in most), strict=True), strict=True))
        self.ids = ids

    def iterators(self, wanted: list[int], weights: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(bound, documents, contributions) by ascending bound: the accumulators of the short
        lists as one iterator, each long list as another."""
        held = sorted((self._lists[t][1] - self._lists[t][0], t) for t in wanted if t in self._lists and weights[t] > 0)
        room = int(SHORT * len(self.ids))
        found, short = [], []
        for length, t in held:
            a, b, most = self._lists[t]
            w = int(weights[t])
            if length <= room:
                room -= length
                short.append((self._places[a:b], w * self._impacts[a:b]))
            else:
                room = -1
                found.append((w * most, self._places[a:b], w * self._impacts[a:b]))
        if short:
            documents, sums = _accumulate(short)
            found.append((int(sums.max()), documents, sums))
        return sorted(found, key=lambda x: x[0])


def _accumulate(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Term at a time: the documents of any list in ascending order, and their summed values."""
    documents = np.concatenate([d for d, _ in lists])
    values = np.concatenate([v for _, v in lists])
    order = np.argsort(documents, kind="stable")
    documents, values = documents[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], documents[1:] != documents[:-1]]))
    return documents[first], np.add.reduceat(values, first)


class Best:
    """The ``k`` highest scores of an item so far, equal ones by ascending document id."""

    def __init__(self, k: int):
        self._k = k
        self.ids = np.empty(0, dtype=np.int64)
        self.scores = np.empty(0, dtype=np.int64)

    @property
    def least(self) -> int:
        """No smaller score can come in."""
        return int(self.scores[-1]) if len(self.scores) == self._k else 1

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores])
        order = np.lexsort((ids, -scores))[: self._k]
        self.ids, self.scores = ids[order], scores[order]


def search_shard(shard: Shard, wanted: list[int], weights: np.ndarray, best: Best) -> None:
    """Document at a time over the item's iterators in ``shard``; what belongs there goes to ``best``."""
    found = shard.iterators(wanted, weights)
    reach = np.cumsum([bound for bound, _, _ in found]).tolist()
    at, n = 0, len(shard.ids)
    while at < n:
        # Iterators before ``must`` cannot lift a document to the least score by themselves.
        must = next((i for i, r in enumerate(reach) if r >= best.least), len(found))
        if must == len(found):
            return
        spans = [np.searchsorted(documents, [at, n]) for _, documents, _ in found[must:]]
        following = [int(documents[s]) for (_, documents, _), (s, e) in zip(found[must:], spans, strict=True) if s < e]
        if not following:
            return
        at = min(following)
        end = min(n, at + RANGE)
        sums = np.zeros(end - at, dtype=np.int64)
        for (_, documents, values), (s, _) in zip(found[must:], spans, strict=True):
            e = s + np.searchsorted(documents[s:], end)
            sums[documents[s:e] - at] += values[s:e]
        here = np.flatnonzero(sums)
        sums = sums[here]
        for i in range(must - 1, -1, -1):
            keep = sums + reach[i] >= best.least
            here, sums = here[keep], sums[keep]
            if not len(here):
                break
            _, documents, values = found[i]
            seek = np.searchsorted(documents, here + at)
            seek[seek == len(documents)] = 0
            met = documents[seek] == here + at
            sums[met] += values[seek[met]]
        keep = sums >= best.least
        if keep.any():
            best.add(shard.ids[at + here[keep]], sums[keep])
        at = end


# ---------------------------------------------------------------- the job

_POSTINGS = "doc_id long, n long, terms array<int>, counts array<long>"


def _postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """One row for each text with a term: its number of terms, and how often it holds which of
    ``vocabulary``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for key, text in rows(iter([batch]), "doc_id", "text"):
                own = terms(text)
                if own:
                    counts = Counter(map(vocabulary.get, own))
                    counts.pop(None, None)
                    for column, value in zip(out, (key, len(own), list(counts), list(counts.values())), strict=True):
                        column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]
            names = [c.split()[0] for c in _POSTINGS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names)

    return texts(docs).mapInArrow(run, _POSTINGS)


def _shards(batches: Iterator[pa.RecordBatch], n_docs: int, n_terms: int) -> Iterator[Shard]:
    """Shards of at most about ``POSTINGS_PER_SHARD`` postings each, of the rows with an id."""

    def close(parts: list[pa.RecordBatch]) -> Shard:
        table = pa.Table.from_batches(parts).sort_by("doc_id").combine_chunks()
        size = table.column("n").to_numpy()
        lists = table.column("terms").combine_chunks()
        length = np.diff(lists.offsets.to_numpy())
        places = np.repeat(np.arange(len(size)), length)
        counts = table.column("counts").combine_chunks().flatten().to_numpy()
        m = 50 + (50 * size * n_docs) // n_terms
        impacts = (1_000_000_000 * counts) // (1000 * counts + 20 * m[places])
        return Shard(table.column("doc_id").to_numpy(), lists.flatten().to_numpy(), places, impacts)

    parts, held = [], 0
    for batch in batches:
        batch = batch.filter(batch.column("doc_id").is_valid())
        if batch.num_rows:
            parts.append(batch)
            held += len(batch.column("terms").flatten()) + batch.num_rows
        if held >= POSTINGS_PER_SHARD:
            yield close(parts)
            parts, held = [], 0
    if parts:
        yield close(parts)


def _answer(docs: DataFrame, asked: list[tuple[int, set[bytes]]], top: int) -> DataFrame:
    """``item_id, doc_id, score, salt``: the best documents of each of the items in every task."""
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, own in asked for t in own}))}
    wanted = [(key, sorted(vocabulary[t] for t in own)) for key, own in asked]
    postings = spool(_postings(docs, vocabulary), "postings")
    totals = postings.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    holding = np.zeros(len(vocabulary), dtype=np.int64)
    for r in postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect():
        holding[r["term"]] = r["df"]
    n_docs, n_terms = totals["docs"], totals["terms"]
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in holding], dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in wanted]
        for shard in _shards(batches, n_docs, n_terms):
            for (_, own), so_far in zip(wanted, best, strict=True):
                search_shard(shard, own, weights, so_far)
        items = np.repeat(np.array([key for key, _ in wanted], dtype=np.int64), np.array([len(b.ids) for b in best], dtype=np.int64))
        none = np.empty(0, dtype=np.int64)
        arrays = [items, np.concatenate([none, *(b.ids for b in best)]), np.concatenate([none, *(b.scores for b in best)])]
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in arrays], ["item_id", "doc_id", "score"])

    found = postings.mapInArrow(run, "item_id long, doc_id long, score long")
    salt = F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("salt")
    kept = spool(found.select("item_id", "doc_id", "score", salt), "ranked")
    release(postings)
    return kept


def search(docs: DataFrame, items: DataFrame, top: int = TOP, chars_per_block: int = CHARS_PER_BLOCK) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents with the highest scores above 0 for
    each row of ``items`` (``item_id, text``), equal scores by ascending ``doc_id``.

    Rows that repeat an item's id are one item with the terms of all their texts; items without an
    id or without terms have no rows. Every row of ``docs`` counts as a document of its own; a row
    without an id counts in the statistics and is not returned; null, empty and term-less texts
    are no documents. Whole texts are read. Empty tables give no rows; other columns are not read.
    """
    named = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    named = named.filter("item_id is not null")
    chars = named.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(chars / chars_per_block))
    answers = None
    for block in range(blocks):
        asked: dict[int, set[bytes]] = {}
        for r in named.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect():
            asked.setdefault(r["item_id"], set()).update(terms(r["text"]))
        # A block may be empty; one at least gives the frame its columns.
        if asked or (answers is None and block == blocks - 1):
            found = _answer(docs, sorted(asked.items()), top)
            answers = found if answers is None else answers.unionByName(found)
    order = [F.col("score").desc(), "doc_id"]
    for keys in (["item_id", "salt"], ["item_id"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        answers = answers.withColumn("rank", place).filter(F.col("rank") <= top)
    return answers.select("item_id", "rank", "doc_id", "score")


def oracle_sql(top: int = TOP) -> str:
    """DuckDB SQL for :func:`search` of ``benchmark`` in ``documents``: every pair that shares a term."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def words(column: str) -> str:
        folded = f"translate(coalesce({column}, ''), '{upper}', '{upper.lower()}')"
        return f"regexp_extract_all({folded}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

    return f"""
WITH doc AS (SELECT doc_id, {words("text")} AS words FROM documents),
long AS (SELECT doc_id, len(words) AS n, unnest(words) AS term FROM doc),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM long GROUP BY ALL),
total AS (SELECT count(*) FILTER (len(words) > 0) AS docs, sum(len(words))::BIGINT AS terms FROM doc),
weight AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term, docs),
item AS (SELECT DISTINCT item_id, unnest({words("text")}) AS term FROM benchmark),
score AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))))::BIGINT AS score
  FROM item JOIN tf USING (term) JOIN weight USING (term), total GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM score WHERE score > 0 QUALIFY rank <= {top}
"""
