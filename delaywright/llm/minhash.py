"""MinHash near-duplicates with odd sketches.

Each distinct shingle set gets MinHash samples. Bands of samples put similar sets into common
buckets; all samples together are folded into a parity bitmap (an odd sketch), and the population
count of the XOR of two bitmaps tells how many samples differ, precisely for high similarities.
Candidates from a bucket whose bitmaps differ too much are never confirmed on their full sets.

Groups of copies stay linear. Equal sets are one class. In a bucket, every class is compared with
the bucket's first one, and components of the confirmed links are formed. Only where classes of
one bucket then lie in different components are all pairs looked at, each in the first bucket it
shares: sizes and sketches in one task say which classes have a pair to verify at all, these come
back with their full sets, and the task that counts the intersections returns the edges of a
spanning forest. No pair ever leaves a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaywright.llm import wordhash
from delaywright.llm.components import components
from delaywright.llm.frames import drop_finished_shuffles, slices, texts, unused
from delaywright.runtime import cut_lineage, spool

SHINGLE = 5
PERCENT = 80


@dataclass(frozen=True)
class Settings:
    """``bands * rows`` MinHash samples. At the similarity of ``percent`` a pair shares no bucket
    with chance (1 - s ** rows) ** bands, 5e-8 by default. The sketch rejects a pair that differs
    by more than a pair at the threshold does, plus ``deviations`` standard deviations."""

    shingle: int = SHINGLE
    percent: int = PERCENT
    bands: int = 32
    rows: int = 4
    words: int = 8
    deviations: float = 5.0

    @property
    def samples(self) -> int:
        return self.bands * self.rows

    def most_different(self) -> int:
        """The largest XOR population count of two sketches that a pair at the threshold shows,
        but for ``deviations`` standard deviations of the samples and of the bitmap together."""
        s, bits = self.percent / 100, 64 * self.words
        odd = 2 * self.samples * (1 - s)  # expected samples in one of the two sets and not the other
        mean = bits * (1 - math.exp(-2 * odd / bits)) / 2
        by_samples = 2 * math.sqrt(self.samples * s * (1 - s)) * math.exp(-2 * odd / bits)
        by_bitmap = math.sqrt(bits / 4 * (1 - math.exp(-4 * odd / bits)))
        return math.ceil(mean + self.deviations * math.hypot(by_samples, by_bitmap))


def _sets(hashes: np.ndarray, bounds: np.ndarray, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a shorter text is one shingle."""
    runs = wordhash.window_hashes(hashes, size)
    found = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= size:
            found.append(np.unique(runs[a : b - size + 1]))
        elif b > a:
            found.append(wordhash.window_hashes(hashes[a:b], b - a, seed=7))
        else:
            found.append(np.empty(0, dtype=np.uint64))
    return found


def _shingle_sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list[dict], list[np.ndarray]]]:
    """(keys, sets) of neighbouring rows of ``key, text``."""
    for keys, data in slices(batches, "key"):
        raw, starts, ends, bounds = wordhash.words(data, lower=True)
        yield keys, _sets(wordhash.word_hashes(raw, starts, ends), bounds, size)


def _prints(own: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    halves = wordhash.mix(own), wordhash.mix(own ^ np.uint64(0x5851F42D4C957F2D))
    return tuple(int(h.sum(dtype=np.uint64).astype(np.int64)) for h in halves)


def _samples(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """MinHash samples: the least multiple-and-fold value of the set under each odd factor."""
    least = np.full(len(factors), ~np.uint64(0), dtype=np.uint64)
    for at in range(0, len(shingles), 512):
        part = shingles[at : at + 512, None] * factors[None, :]
        least = np.minimum(least, (part ^ (part >> np.uint64(32))).min(axis=0))
    return least


def _factors(n: int) -> np.ndarray:
    return wordhash.mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


_SIGNATURE = "doc_id long, hash long, n_shingles long, p1 long, p2 long, sketch array<long>, bands array<long>"


def _keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, hash, text``: rows that repeat an id are told apart by the hash of their texts."""
    return texts(docs).withColumn("hash", F.xxhash64("text"))


def signatures(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row for each row of ``docs``: hash of the text, set size, 128-bit print of the set, odd
    sketch, bands. Texts without words have an empty set, no sketch and no bands."""
    n, per, words = settings.samples, settings.rows, settings.words
    size = settings.shingle

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _factors(n)
        salts = wordhash.mix(factors + np.uint64(1))
        bits = np.uint64(64 * words)
        for keys, sets in _shingle_sets(batches, size):
            out: list[list] = [[k["doc_id"] for k in keys], [k["hash"] for k in keys], [], [], [], [], []]
            for own in sets:
                if not len(own):
                    for column, value in zip(out[2:], (0, 0, 0, None, None), strict=True):
                        column.append(value)
                    continue
                least = _samples(own, factors)
                place = wordhash.mix(least ^ salts) % bits
                parity = np.bincount(place.astype(np.int64), minlength=64 * words) & 1
                sketch = np.packbits(parity.astype(np.uint8)).view(np.int64)
                bands = wordhash.window_hashes(least, per, seed=9)[::per] + salts[: n // per]
                for column, value in zip(out[2:], (len(own), *_prints(own), sketch, wordhash.mix(bands).view(np.int64)), strict=True):
                    column.append(value)
            kinds = [*[pa.int64()] * 5, pa.list_(pa.int64()), pa.list_(pa.int64())]
            names = [c.split()[0] for c in _SIGNATURE.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names)

    return _keyed(docs).select(F.struct("doc_id", "hash").alias("key"), "text").mapInArrow(run, _SIGNATURE)


def _full_sets(docs: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """``id, shingles`` (sorted distinct hashes) of ``classes``, read from the text that each is
    named after. A class may be given more than once, where that row is repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for keys, sets in _shingle_sets(batches, size):
            ids, own = [], []
            for key, found in zip(keys, sets, strict=True):
                if key["id"] not in seen and _prints(found) == (key["p1"], key["p2"]):
                    seen.add(key["id"])
                    ids.append(key["id"])
                    own.append(found.view(np.int64))
            for at in range(0, len(ids), 64):
                part = slice(at, at + 64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[part], pa.int64()), pa.array(own[part], pa.list_(pa.int64()))], ["id", "shingles"]
                )

    named = _keyed(docs).join(classes.select("doc_id", "hash", "id", "p1", "p2"), ["doc_id", "hash"])
    return named.select(F.struct("id", "p1", "p2").alias("key"), "text").mapInArrow(run, "id long, shingles array<long>")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows (a, b) of ``pairs`` with 100 * intersection >= percent * union on the full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b"
    )
    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _differing(x: str, y: str, words: int) -> Column:
    """Population count of the XOR of two sketches."""
    return reduce(lambda a, b: a + b, [F.bit_count(F.col(x)[i].bitwiseXOR(F.col(y)[i])) for i in range(words)])


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs``.

    Documents are linked when 100 * intersection >= percent * union of their shingle sets;
    ``component_id`` is the smallest id reachable by links, ``kept`` marks its row. Words are
    compared with A-Z lower-cased. Null, empty and blank texts have an empty set and no links;
    rows of equal texts are linked; rows that repeat an id with different texts are documents of
    their own, linked only by their texts; a row with a null id has links to nothing, a null
    component and is kept; whole texts are read; an empty table gives no rows.
    """
    return _grouped(docs, settings).drop("hash")


def _grouped(docs: DataFrame, settings: Settings) -> DataFrame:
    """The rows of :func:`near_duplicates` with the ``hash`` of each text."""
    spark = docs.sparkSession
    signed = spool(signatures(docs, settings), "signatures")
    known = signed.filter("doc_id is not null and n_shingles > 0")
    prints = ["n_shingles", "p1", "p2"]
    # Equal sets are one class, read from its smallest document; min keeps that one's arrays.
    least = known.groupBy(*prints).agg(F.min(F.struct("doc_id", "hash", "sketch", "bands")).alias("c"))
    classes = spool(least.select(F.monotonically_increasing_id().alias("id"), *prints, "c.*"), "classes")
    bands = classes.select("id", F.posexplode("bands").alias("band", "bucket"))
    # (bucket hashes already differ by band)
    buckets = bands.groupBy("bucket").agg(F.min("id").alias("least"), F.max("id").alias("_most")).filter("least < _most")
    members = spool(bands.join(buckets.select("bucket", "least"), "bucket").select("bucket", "id", "least"), "buckets")
    drop_finished_shuffles(spark)

    wanted = classes.join(members.select("id").distinct(), "id", "left_semi")
    sets = spool(_full_sets(docs, wanted, settings.shingle), "sets")
    drop_finished_shuffles(spark)

    sketches = classes.select("id", "sketch", "n_shingles", "bands")
    limit, words, percent = settings.most_different(), settings.words, settings.percent

    def alike(pairs: DataFrame) -> DataFrame:
        """Pairs whose sizes and sketches allow a link."""
        x = sketches.select(F.col("id").alias("a"), F.col("sketch").alias("sa"), F.col("n_shingles").alias("na"))
        y = sketches.select(F.col("id").alias("b"), F.col("sketch").alias("sb"), F.col("n_shingles").alias("nb"))
        both = pairs.join(x, "a").join(y, "b")
        fits = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
        return both.filter(fits & (_differing("sa", "sb", words) <= limit)).select("a", "b")

    stars = alike(members.filter("least < id").select(F.col("least").alias("a"), F.col("id").alias("b")).distinct())
    links = spool(_confirm(stars, sets, percent), "links")
    drop_finished_shuffles(spark)
    rest = _mixed(members, components(links), sketches)
    if not rest.isEmpty():
        links = cut_lineage(links.unionByName(_across(rest, sets, settings)))
        drop_finished_shuffles(spark)
    grouped = components(links).select(F.col("node").alias("id"), F.col("component").alias("label"))
    labelled = spool(
        classes.select("id", *prints, "doc_id").join(grouped, "id", "left").select(*prints, "doc_id", F.coalesce("label", "id").alias("label")),
        "labelled",
    )
    first = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    keyed = labelled.join(first, "label").select(*prints, "component_id")
    drop_finished_shuffles(spark)
    linked = known.select("doc_id", "hash", *prints).join(keyed, prints)
    alone = signed.filter("doc_id is null or n_shingles = 0").select(
        "doc_id", "hash", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return linked.select("doc_id", "hash", "n_shingles", "component_id").unionByName(alone).select(
        "doc_id", "hash", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    )


#: Classes of one bucket, and shingles of theirs, that are compared in one task at most.
BLOCK = 2048
BLOCK_SHINGLES = 4_000_000


def _mixed(members: DataFrame, grouped: DataFrame, sketches: DataFrame) -> DataFrame:
    """The members of buckets that hold several components, with sketches, sizes and bands, dealt
    to pairs of blocks (``bucket, bi, bj``); ``own`` is the block of the class itself."""
    labelled = members.select("bucket", "id").join(grouped.withColumnRenamed("node", "id"), "id", "left").select(
        "bucket", "id", F.coalesce("component", "id").alias("label")
    )
    sized = labelled.join(sketches.select("id", "n_shingles"), "id")
    sizes = sized.groupBy("bucket").agg(
        F.min("label").alias("_x"), F.max("label").alias("_y"), F.count(F.lit(1)).alias("_m"), F.sum("n_shingles").alias("_s")
    )
    blocks = F.greatest(F.ceil(F.col("_m") / BLOCK), F.ceil(F.col("_s") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    rest = cut_lineage(labelled.join(sizes.filter("_x < _y").select("bucket", blocks), "bucket"))
    own, other = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"), F.explode(F.expr("sequence(0, blocks - 1)"))
    return (
        rest.join(sketches, "id")
        .withColumn("own", own)
        .withColumn("_other", other)
        .select("bucket", F.least("own", "_other").alias("bi"), F.greatest("own", "_other").alias("bj"), *_MEMBER)
    )


_MEMBER = ["own", "id", "label", "n_shingles", "sketch", "bands"]
_DEALT = (
    "bucket long, bi int, bj int, own int, id long, label long, n_shingles long, sketch array<long>, bands array<long>"
)


class _Block:
    """A bucket's members in one task: which pairs are to be verified here."""

    def __init__(self, group: pa.Table, settings: Settings):
        self._limit, self._percent = settings.most_different(), settings.percent
        self.ids, self.labels, self.sizes, self._own = (group.column(c).to_numpy() for c in ("id", "label", "n_shingles", "own"))
        n = len(self.ids)
        self._bitmaps = group.column("sketch").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(n, -1)
        self._bands = group.column("bands").combine_chunks().flatten().to_numpy().reshape(n, -1)
        self._here = np.flatnonzero(self._bands[0] == group.column("bucket")[0].as_py())[0]
        self._across = group.column("bi")[0].as_py() != group.column("bj")[0].as_py()

    def partners(self, i: int, among: np.ndarray) -> np.ndarray:
        """Those of ``among`` whose sizes and sketches allow a link with the ``i``-th class, that
        have another label, and whose first common bucket is this one. In a pair of blocks, pairs
        inside one block belong to that block alone."""
        j = among[self.labels[among] != self.labels[i]]
        if self._across:
            j = j[self._own[j] != self._own[i]]
        low, high = np.minimum(self.sizes[j], self.sizes[i]), np.maximum(self.sizes[j], self.sizes[i])
        j = j[low * 100 >= high * self._percent]
        j = j[np.bitwise_count(self._bitmaps[j] ^ self._bitmaps[i]).sum(axis=1) <= self._limit]
        return j[(self._bands[j] == self._bands[i]).argmax(axis=1) == self._here]


def _across(rest: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """``a, b``: confirmed links that connect classes of different components (``rest`` as given by
    :func:`_mixed`); of each block the edges of a spanning forest only."""

    def candidates(group: pa.Table) -> pa.Table:
        """The members that have a pair to verify here."""
        block = _Block(group, settings)
        n = len(block.ids)
        wanted = np.zeros(n, dtype=bool)
        for i in range(n - 1):
            j = block.partners(i, np.arange(i + 1, n))
            if len(j):
                wanted[i] = wanted[j] = True
        return group.filter(pa.array(wanted))

    def verify(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        block = _Block(group, settings)
        edges = list(_forest(block, group.column("shingles").combine_chunks(), settings.percent))
        a, b = (np.array(x, dtype=np.int64) for x in zip(*edges, strict=True)) if edges else (np.empty(0, dtype=np.int64),) * 2
        return pa.table({"a": block.ids[a], "b": block.ids[b]})

    key = ["bucket", "bi", "bj"]
    found = spool(rest.groupBy(*key).applyInArrow(candidates, _DEALT), "candidates")
    return found.join(sets, "id").groupBy(*key).applyInArrow(verify, "a long, b long")


def _forest(block: _Block, shingles: pa.Array, percent: int) -> Iterator[tuple[int, int]]:
    """Confirmed links (as places in the block) that connect members not connected before; members
    of one label are connected from the start."""
    n = len(block.ids)
    ends = shingles.offsets.to_numpy()
    # Shingles get numbers inside the block, so that a set can be marked in one array.
    numbers = np.unique(shingles.flatten().to_numpy(), return_inverse=True)[1]
    ends = ends - ends[0]
    marks = np.zeros(int(numbers.max()) + 1, dtype=np.int32)
    root = np.unique(block.labels, return_inverse=True)[1]
    for i in range(n - 1):
        later = np.arange(i + 1, n)
        j = block.partners(i, later[root[later] != root[i]])
        if not len(j):
            continue
        own = numbers[ends[i] : ends[i + 1]]
        marks[own] = 1
        if len(j) * 4 > n - i:
            common = np.add.reduceat(marks[numbers[ends[i + 1] :]], ends[i + 1 : n] - ends[i + 1])[j - i - 1]
        else:
            common = np.array([marks[numbers[ends[k] : ends[k + 1]]].sum() for k in j])
        marks[own] = 0
        for k in j[100 * common >= percent * (block.sizes[i] + block.sizes[j] - common)].tolist():
            if root[k] != root[i]:
                root[root == root[k]] = root[i]
                yield i, k


def keep_one(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that :func:`near_duplicates` keeps, with all their columns."""
    gone_id, gone_hash = unused("id", docs), unused("hash", docs)
    found = _grouped(docs, settings).filter("not kept").select(F.col("doc_id").alias(gone_id), F.col("hash").alias(gone_hash)).distinct()
    own = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(found, (docs["doc_id"].cast("long") == found[gone_id]) & (own == found[gone_hash]), "left_anti")


def oracle_sql(shingle: int, percent: int = PERCENT) -> str:
    """DuckDB SQL for :func:`near_duplicates` over ``documents`` with distinct ids, on shingles as
    strings: exact, by an inverted index and a recursive closure."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH RECURSIVE text AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'),
                                                   '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(words[pos : pos + {shingle - 1}], ' ') AS s
  FROM text, LATERAL (SELECT unnest(range(1, greatest(2, len(words) - {shingle - 2}))) AS pos)
  WHERE len(words) > 0),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
           FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM common c JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
         WHERE 100 * c.n >= {percent} * (x.n + y.n - c.n)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(a, b) AS (SELECT a, b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT t.doc_id, coalesce(s.n, 0) AS n_shingles, least(t.doc_id, coalesce(l.b, t.doc_id)) AS component_id,
       t.doc_id = least(t.doc_id, coalesce(l.b, t.doc_id)) AS kept
FROM text t LEFT JOIN size s ON s.doc_id = t.doc_id LEFT JOIN least l ON l.a = t.doc_id
"""
