"""Substring deduplication by relative Lempel-Ziv parsing against earlier documents.

Every document is a reference block for all documents with a larger id. A document is factored
from left to right: a factor is a run of windows (of ``window`` words) whose earliest places follow
one another in one reference document. Factors start and end where that document changes, though
another one may hold the whole longer run, and every window over such a boundary is looked up too, so the words covered by factors
are exactly those covered by windows that occur in an earlier document.

The index of all reference blocks is a table window -> earliest place, spread by window hash, and
it is only built where it can matter. A window is known by its anchor, the smallest hash among the
short word runs inside it; equal windows have equal anchors. Anchors (about one in four runs) that
occur in one document only cannot belong to a shared window, so windows are formed and indexed
only at anchors that at least two documents share. Neighbouring windows with one anchor form a
run; equal runs, as copies of a passage have them, are looked up once, and only distinct runs are
taken apart into windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaywright.llm import wordhash
from delaywright.llm.frames import drop_finished_shuffles, rows, slices, texts, unused
from delaywright.runtime import release, spool

WINDOW = 13
#: Words of an anchor run: a window of 13 words holds 7 runs of 7 words.
ANCHOR = 7
#: Up to so many copies (32 bytes each) are broadcast.
BROADCAST_COPIES = 1_000_000


def _anchors(hashes: np.ndarray, bounds: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(run hashes, starts of the windows inside one text, place of each window's anchor run)."""
    runs = wordhash.window_hashes(hashes, anchor, seed=1)
    n = len(hashes) - window + 1
    if n <= 0:
        none = np.empty(0, dtype=np.int64)
        return runs, none, none
    span = window - anchor + 1
    best, place = runs[:n].copy(), np.zeros(n, dtype=np.int64)
    for k in range(1, span):
        lower = runs[k : k + n] < best
        best[lower] = runs[k : k + n][lower]
        place[lower] = k
    starts = np.flatnonzero(wordhash.starts_within(bounds, window, n))
    return runs, starts, (place + np.arange(n))[starts]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _seeds(docs: DataFrame, window: int, anchor: int, bits: int) -> DataFrame:
    """``seed, doc_id``: the distinct anchors of each document, cut to ``bits`` bits. Anchors only
    choose what is looked at, so two that agree by chance cost work and change no result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, data in slices(batches):
            raw, starts, ends, bounds = wordhash.words(data)
            runs, at, place = _anchors(wordhash.word_hashes(raw, starts, ends), bounds, window, anchor)
            place = np.unique(place)
            owner = np.searchsorted(bounds, place, side="right") - 1
            pairs = np.stack([owner.astype(np.uint64), runs[place] >> np.uint64(64 - bits)], axis=1)
            order = np.lexsort((pairs[:, 1], pairs[:, 0]))
            pairs = pairs[order]
            first = np.ones(len(pairs), dtype=bool)
            first[1:] = (pairs[1:] != pairs[:-1]).any(axis=1)
            pairs = pairs[first]
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 1].astype(np.int64)), pa.array(np.array(ids, dtype=np.int64)[pairs[:, 0].astype(np.int64)])],
                ["seed", "doc_id"],
            )

    return docs.mapInArrow(run, "seed long, doc_id long")


_RUNS = "anchor long, run long, doc_id long, pos int, windows array<long>"


def _runs(marked: DataFrame, window: int, anchor: int, bits: int) -> DataFrame:
    """The windows at shared anchors, those of one anchor place as one row: the anchor's hash, a
    hash of all words of the run, where it starts, and a hash of each window. Anchor and window
    hashes come from independent word hashes, so together they are 128 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                yield _runs_of(batch.slice(at, 64), window, anchor, bits)

    return marked.mapInArrow(run, _RUNS)


def _runs_of(part: pa.RecordBatch, window: int, anchor: int, bits: int) -> pa.RecordBatch:
    ids = np.array(part.column("doc_id").to_pylist(), dtype=np.int64)
    seeds = part.column("seeds")
    data = [t.encode("utf-8", "surrogatepass") for t in part.column("text").to_pylist()]
    raw, starts, ends, bounds = wordhash.words(data)
    runs, first, place = _anchors(wordhash.word_hashes(raw, starts, ends), bounds, window, anchor)
    cut = (runs >> np.uint64(64 - bits)).astype(np.int64)
    edges = np.searchsorted(first, bounds)
    shared = np.zeros(len(first), dtype=bool)
    for j in range(len(ids)):
        a, b = edges[j], edges[j + 1]
        shared[a:b] = np.isin(cut[place[a:b]], seeds[j].values.to_numpy())
    first, place = first[shared], place[shared]
    each = wordhash.window_hashes(wordhash.word_hashes(raw, starts, ends, seed=2), window, seed=3)[first]
    # All windows of one anchor place are neighbours; first and last together hold all their words.
    head = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(first) else first
    tail = np.concatenate([head[1:], [len(first)]]) - 1 if len(first) else first
    count = (tail - head + 1).astype(np.uint64)
    whole = wordhash.mix(wordhash.mix(each[head] + count) ^ (each[tail] * np.uint64(0x9E3779B97F4A7C15)))
    owner = np.searchsorted(bounds, first[head], side="right") - 1
    offsets = np.concatenate([head, [len(first)]]).astype(np.int32) if len(first) else np.zeros(1, dtype=np.int32)
    return pa.RecordBatch.from_arrays(
        [
            _signed(runs[place[head]]),
            _signed(whole),
            pa.array(ids[owner]),
            pa.array((first[head] - bounds[owner]).astype(np.int32)),
            pa.ListArray.from_arrays(pa.array(offsets), _signed(each)),
        ],
        [c.split()[0] for c in _RUNS.split(", ")],
    )


def _printed(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` and a 128-bit print of the text, of rows with an id."""
    return texts(docs).filter("doc_id is not null").select(
        "doc_id", "text", F.xxhash64("text").alias("x1"), F.xxhash64(F.lit(1), "text").alias("x2")
    )


def _copies(printed: DataFrame) -> DataFrame:
    """``doc_id, x1, x2, source``: rows whose text a document with a smaller id has as well."""
    first = printed.groupBy("x1", "x2").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("_last"))
    again = first.filter("source < _last").drop("_last")
    return printed.select("doc_id", "x1", "x2").distinct().join(again, ["x1", "x2"]).filter("source < doc_id")


def find_factors(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id, places, copies``: what of each document, if anything, stands in a document with a
    smaller id. ``places`` are (pos, n, source, source_pos): ``n`` neighbouring windows and where
    an earlier document has them; ``copies`` are prints of whole texts an earlier document has.
    """
    spark = docs.sparkSession
    printed = _printed(docs)
    copies = spool(_copies(printed).select("doc_id", "x1", "x2", "source"), "copies")
    n_copies = copies.count()
    # A copy adds nothing to the index and is itself one factor. Few copies are sent to every
    # task; more are joined by shuffle.
    known = F.broadcast(copies) if n_copies <= BROADCAST_COPIES else copies
    keyed = printed.join(known, ["doc_id", "x1", "x2"], "left_anti") if n_copies else printed
    # The chance that two of n anchors agree in their first log2(n) + 9 bits is under 1 in 500.
    size = printed.agg(F.sum(F.octet_length("text"))).first()[0] or 1
    bits = min(62, int(size).bit_length() + 9)
    seeds = _seeds(keyed.select("doc_id", "text"), window, anchor, bits)
    shared = seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("seed")
    marks = spool(
        seeds.join(shared.hint("shuffle_hash"), "seed").groupBy("doc_id").agg(F.collect_set("seed").alias("seeds")),
        "anchors",
    )
    drop_finished_shuffles(spark)
    marked = keyed.select("doc_id", "text").join(marks, "doc_id").select("doc_id", "text", "seeds")
    runs = spool(_runs(marked, window, anchor, bits), "runs")
    release(marks)
    drop_finished_shuffles(spark)
    # Each distinct run with its earliest place; copies of a passage end here.
    key = ["anchor", "run"]
    distinct = spool(
        runs.groupBy(*key).agg(
            F.min(F.struct("doc_id", "pos")).alias("source"), F.max("doc_id").alias("last"), F.first("windows").alias("windows")
        ),
        "distinct",
    )
    drop_finished_shuffles(spark)
    # A window of a run may stand in other runs of its anchor, and there in an earlier document.
    several = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("anchor")
    single = spool(
        distinct.join(several, "anchor").select(*key, "source", F.posexplode("windows").alias("i", "window")), "single"
    )
    drop_finished_shuffles(spark)
    earliest = single.groupBy("anchor", "window").agg(
        F.min(F.struct(F.col("source.doc_id").alias("doc_id"), (F.col("source.pos") + F.col("i")).alias("pos"))).alias("at"),
        F.max("source.doc_id").alias("_last"),
    ).filter("at.doc_id < _last").select("anchor", "window", "at")
    parts = spool(
        single.join(earliest, ["anchor", "window"])
        .filter("at.doc_id < source.doc_id")
        .groupBy(*key)
        .agg(F.collect_list(F.struct("i", F.col("at.doc_id").alias("source"), F.col("at.pos").alias("source_pos"))).alias("parts")),
        "parts",
    )
    release(single)
    drop_finished_shuffles(spark)
    # Written first: a join of two plain scans is one whose large keys Spark splits.
    index = spool(
        distinct.select(*key, "source", "last", F.size("windows").alias("n"))
        .join(parts, key, "left")
        .filter("source.doc_id < last or parts is not null"),
        "index",
    )
    # Later documents lose the whole run; the earliest loses what yet earlier ones have of it.
    whole = F.array(F.struct("pos", "n", F.col("source.doc_id").alias("source"), F.col("source.pos").alias("source_pos")))
    some = F.transform(
        "parts",
        lambda p: F.struct((F.col("pos") + p["i"]).alias("pos"), F.lit(1).alias("n"), p["source"].alias("source"), p["source_pos"].alias("source_pos")),
    )
    found = (
        runs.select(*key, "doc_id", "pos")
        .join(index, key)
        .select("doc_id", F.when(F.col("source.doc_id") < F.col("doc_id"), whole).otherwise(some).alias("places"))
        .filter("places is not null")
    )
    named = found.groupBy("doc_id").agg(F.flatten(F.collect_list("places")).alias("places"))
    prints = copies.groupBy("doc_id").agg(F.collect_set(F.struct("x1", "x2", "source")).alias("copies"))
    kept = spool(named.join(prints, "doc_id", "full"), "places")
    release(runs, distinct, parts, index, copies)
    drop_finished_shuffles(spark)
    return kept


def factors_of(places: np.ndarray, window: int) -> list[tuple[int, int, int, int]]:
    """The factors (start, length, source, source start) in words, from the matched windows
    ``places`` (columns pos, source, source_pos; by pos). A factor ends where the next window
    does not follow on in the same source; the next factor starts with that window, so the windows over
    the boundary are covered by one of the two."""
    if not len(places):
        return []
    step = np.diff(places, axis=0)
    cuts = np.flatnonzero((step[:, 0] != 1) | (step[:, 1] != 0) | (step[:, 2] != 1)) + 1
    edges = np.concatenate([[0], cuts, [len(places)]])
    return [
        (int(places[a, 0]), int(b - a) + window - 1, int(places[a, 1]), int(places[a, 2]))
        for a, b in zip(edges[:-1], edges[1:], strict=True)
    ]


def _places(value: pa.Scalar) -> np.ndarray:
    """The matched windows of one row, one line each, by position."""
    if not value.is_valid or not len(value.values):
        return np.empty((0, 3), dtype=np.int64)
    pos, n, source, source_pos = (value.values.field(k).to_numpy().astype(np.int64) for k in range(4))
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    table = np.stack([np.repeat(pos, n) + step, np.repeat(source, n), np.repeat(source_pos, n) + step], axis=1)
    table = table[np.lexsort((table[:, 2], table[:, 1], table[:, 0]))]
    # rows that repeat an id give the same window twice
    return table[np.concatenate([[True], table[1:, 0] != table[:-1, 0]])]


@dataclass(frozen=True)
class _Marked:
    """Documents with two more columns, under names that the documents do not have: the matched
    windows, and the source where the whole text is a copy."""

    frame: DataFrame
    places: str
    source: str


def _with_places(docs: DataFrame, found: DataFrame) -> _Marked:
    key, places, copies, source = (unused(c, docs) for c in ("id", "places", "copies", "source"))
    keyed = found.select(F.col("doc_id").alias(key), F.col("places").alias(places), F.col("copies").alias(copies))
    own = F.coalesce(docs["text"].cast("string"), F.lit(""))
    same = F.filter(copies, lambda c: (c["x1"] == F.xxhash64(own)) & (c["x2"] == F.xxhash64(F.lit(1), own)))
    joined = docs.join(keyed, docs["doc_id"].cast("long") == keyed[key], "left")
    return _Marked(joined.select(*[docs[c] for c in docs.columns], places, F.get(same, F.lit(0))["source"].alias(source)), places, source)


def _factored(batch: pa.RecordBatch, window: int, marked: tuple[str, str]) -> Iterator[tuple[list[bytes], list[tuple[int, int, int, int]]]]:
    """The words and the factors of each row; ``marked`` names the columns of the matches."""
    places, sources = batch.column(marked[0]), batch.column(marked[1]).to_pylist()
    for i, (text,) in enumerate(rows(iter([batch]), "text")):
        own = text.encode("utf-8", "surrogatepass").split() if text else []
        if sources[i] is None:
            yield own, factors_of(_places(places[i]), window)
        else:
            yield own, [(0, len(own), sources[i], 0)] if len(own) >= window else []


def _kept(own: list[bytes], found: list[tuple[int, int, int, int]]) -> list[bytes]:
    edges = np.zeros(len(own) + 1, dtype=np.int32)
    for start, length, _, _ in found:
        edges[start] += 1
        edges[start + length] -= 1
    return [w for w, c in zip(own, np.cumsum(edges[:-1]).tolist(), strict=True) if not c]


def factors(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id, start, length, source, source_start``: the long factors of every document, in
    words. Edge cases as in :func:`deduplicate`."""
    marked = _with_places(texts(docs), find_factors(docs, window, anchor))
    at = (marked.places, marked.source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, (_, found) in zip(batch.column("doc_id").to_pylist(), _factored(batch, window, at), strict=True):
                out += [(key, *f) for f in found]
            columns = list(zip(*out, strict=True)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "length", "source", "source_start"]
            )

    return marked.frame.mapInArrow(run, "doc_id long, start long, length long, source long, source_start long")


def deduplicate(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``docs`` without the words of windows that occur in a document with a smaller id.

    A text that loses words becomes its kept words joined by one blank, and ``n_chars`` follows; all
    other texts stay as they are, nulls included, and so do all other columns, whatever their names.
    Rows with a null ``doc_id`` are no reference and lose nothing; repeated rows of one id are one
    document's and do not count against each other; whole texts are read; an empty table gives no
    rows.
    """
    schema = docs.schema
    names = schema.names
    marked = _with_places(docs, find_factors(docs, window, anchor))
    at = (marked.places, marked.source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = batch.column("text").to_pylist()
            chars = batch.column("n_chars").to_pylist() if "n_chars" in names else [None] * batch.num_rows
            for i, (own, found) in enumerate(_factored(batch, window, at)):
                if found:
                    out[i] = b" ".join(_kept(own, found)).decode("utf-8", "surrogatepass")
                    chars[i] = len(out[i])
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns["text"] = pa.array(out, columns["text"].type)
            if "n_chars" in names:
                columns["n_chars"] = pa.array(chars, columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)

    return marked.frame.mapInArrow(run, schema)


def digests(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row; null texts have no words."""
    marked = _with_places(texts(docs), find_factors(docs, window, anchor))
    at = (marked.places, marked.source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, hashes = [], [], []
            for own, found in _factored(batch, window, at):
                kept = _kept(own, found) if found else own
                counts.append(len(own))
                removed.append(len(own) - len(kept))
                hashes.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(hashes, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    return marked.frame.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def oracle_sql(window: int = WINDOW) -> str:
    """DuckDB SQL for :func:`digests` over the view ``documents`` (window sequences as strings)."""
    return f"""
WITH text AS (SELECT row_number() OVER () AS row, doc_id,
                     list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
              FROM documents),
word AS (SELECT row, doc_id, generate_subscripts(words, 1) AS pos, unnest(words) AS word FROM text),
windows AS (SELECT row, doc_id, g.pos AS pos, array_to_string(words[g.pos : g.pos + {window - 1}], ' ') AS seq
            FROM text, LATERAL (SELECT unnest(range(1, len(words) - {window - 2})) AS pos) g),
first AS (SELECT seq, min(doc_id) AS doc_id FROM windows GROUP BY seq),
starts AS (SELECT w.row, w.pos FROM windows w JOIN first f ON w.seq = f.seq AND f.doc_id < w.doc_id),
gone AS (SELECT DISTINCT row, pos + k AS pos FROM starts, (SELECT unnest(range(0, {window})) AS k)),
kept AS (SELECT w.row, count(*) AS n, string_agg(w.word, ' ' ORDER BY w.pos) AS text
         FROM word w ANTI JOIN gone g ON w.row = g.row AND w.pos = g.pos GROUP BY w.row)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM text LEFT JOIN kept USING (row)
"""
