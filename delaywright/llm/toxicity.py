"""Toxicity: a character n-gram linear classifier on naive Bayes log-count ratios.

Features are the distinct character n-grams of a text (lower case, white space as one blank). Each
feature is scaled by its log-count ratio between the classes, and a logistic regression is fitted
on the scaled features. The fit uses a bounded sample of labelled rows; scoring reads every whole
text. n-grams are known by 64-bit hashes that numpy computes for a whole slice of texts at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaywright.llm.frames import rows, texts

ORDERS = (3, 4, 5, 6)
#: Bounds of the fit: labelled rows of each class, and features.
ROWS_PER_CLASS = 8_000
FEATURES = 4_000
MIN_ROWS = 5
L2 = 0.3
_BITS = 20
_SLOTS = 22
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_SPACE = re.compile(r"\s+")
_CHARS = 400_000


def _codes(text: str) -> np.ndarray:
    folded = f" {_SPACE.sub(' ', text.lower()).strip()} "
    return np.frombuffer(folded.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def ngram_hashes(codes: np.ndarray, orders: tuple[int, ...] = ORDERS) -> Iterator[np.ndarray]:
    """For each order the hashes of all n-grams, by their first character; blanks only at either
    end of an n-gram or between words count like any character."""
    wide = codes.astype(np.uint64) + np.uint64(1)
    state = np.zeros(len(wide), dtype=np.uint64)
    for n in range(1, max(orders) + 1):
        m = len(wide) - n + 1
        if m <= 0:
            return
        state = state[:m] * _FACTOR + wide[n - 1 :]
        if n in orders:
            mixed = (state + np.uint64(n)) * _MIX
            mixed ^= mixed >> np.uint64(32)
            mixed *= _FACTOR
            yield mixed


def _distinct(text: str) -> np.ndarray:
    parts = list(ngram_hashes(_codes(text)))
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, dtype=np.uint64)


@dataclass(frozen=True)
class Model:
    """``weights[i]`` of the n-gram with hash ``hashes[i]`` (at most one for each table slot)."""

    hashes: np.ndarray
    weights: np.ndarray
    intercept: float

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Slot -> hash and slot -> place in ``weights``; 0 marks an empty slot."""
        keys = np.zeros(1 << _SLOTS, dtype=np.uint64)
        places = np.zeros(1 << _SLOTS, dtype=np.int32)
        slot = self.hashes >> np.uint64(64 - _SLOTS)
        keys[slot] = self.hashes
        places[slot] = np.arange(len(self.hashes), dtype=np.int32)
        return keys, places


class Scorer:
    """Scores many texts at a time with a model's table."""

    def __init__(self, model: Model):
        self.model = model
        self.keys, self.places = model.table()

    def scores(self, batch: list[str]) -> np.ndarray:
        """Probability of label 1 for each text; every distinct n-gram of a text counts once."""
        codes = [_codes(t) for t in batch]
        lengths = np.array([len(c) for c in codes])
        flat = np.concatenate(codes) if codes else np.empty(0, dtype=np.uint32)
        owner = np.repeat(np.arange(len(batch)), lengths)
        ends = np.cumsum(lengths)[owner] if len(batch) else owner
        total = np.full(len(batch), self.model.intercept)
        pairs = []
        for n, hashes in zip(sorted(ORDERS), ngram_hashes(flat), strict=False):
            hit = np.flatnonzero(self.keys[hashes >> np.uint64(64 - _SLOTS)] == hashes)
            hit = hit[(hit + n <= ends[hit]) & (hashes[hit] != 0)]
            place = self.places[hashes[hit] >> np.uint64(64 - _SLOTS)]
            pairs.append(owner[hit] * np.int64(len(self.model.weights)) + place)
        if pairs and len(self.model.weights):
            owners, places = np.divmod(np.unique(np.concatenate(pairs)), len(self.model.weights))
            total += np.bincount(owners, weights=self.model.weights[places], minlength=len(batch))
        return 1 / (1 + np.exp(-np.clip(total, -50, 50)))


# ---------------------------------------------------------------- the fit


def labelled_sample(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> tuple[DataFrame, dict[int, int]]:
    """``text, toxic`` of about ``rows_per_class`` labelled rows of each class, picked by a hash of
    the id, and the number of labelled rows of each class. Conflicting or null labels take no part."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter("doc_id is not null and toxic in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_most"))
        .filter("toxic = _most")
        .drop("_most")
    )
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0.0)
    for label, n in sizes.items():
        share = F.when(F.col("toxic") == label, F.lit(min(1.0, rows_per_class / n))).otherwise(share)
    picked = known.filter(F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 20)) < share * (1 << 20))
    return texts(docs).join(picked, "doc_id").select("text", "toxic"), sizes


def _bucket_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, 1 << _BITS), dtype=np.int32)
    for text, label in rows(batches, "text", "toxic"):
        counts[label, np.unique(_distinct(text) >> np.uint64(64 - _BITS))] += 1
    used = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[0, used]), pa.array(counts[1, used])], ["bucket", "n0", "n1"])


def _log_ratio(n0: Column, n1: Column, sizes: dict[int, int], cap: int) -> Column:
    """Smoothed log of (share of class 1 with the feature) / (share of class 0 with it)."""
    rows0, rows1 = (float(min(cap, sizes.get(k, 0))) for k in (0, 1))
    return F.log((n1 + 1) / F.lit(rows1 + 2)) - F.log((n0 + 1) / F.lit(rows0 + 2))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    rows_per_class: int = ROWS_PER_CLASS,
    features: int = FEATURES,
    l2: float = L2,
) -> Model:
    """The classifier, learnt from rows of ``labels`` (``doc_id, toxic``) with their texts.

    The driver holds at most ``features`` hashes and the sample rows' active features. With one
    class only, the model is the intercept, which has the class's share of the rows.
    """
    sample, sizes = labelled_sample(docs, labels, rows_per_class)
    rows1, rows0 = sizes.get(1, 0), sizes.get(0, 0)
    prior = float(np.log((rows1 + 0.5) / (rows0 + 0.5)))
    if not rows0 or not rows1:
        return Model(np.empty(0, dtype=np.uint64), np.empty(0), prior)
    sample = sample.repartition(16).persist()
    try:
        buckets = sample.mapInArrow(_bucket_counts, "bucket long, n0 int, n1 int")
        totals = buckets.groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        ratio = _log_ratio(F.col("n0"), F.col("n1"), sizes, rows_per_class)
        # How much a feature moves the classes apart: its ratio, weighted by how often it is seen.
        weight = F.abs(ratio) * F.sqrt(F.col("n0") + F.col("n1"))
        strong = totals.filter(f"n0 + n1 >= {MIN_ROWS}").orderBy(weight.desc(), "bucket").limit(2 * features)
        wanted = np.zeros(1 << _BITS, dtype=bool)
        wanted[[r["bucket"] for r in strong.select("bucket").collect()]] = True
        packed = np.packbits(wanted)

        def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keep = np.unpackbits(packed).astype(bool)
            for batch in batches:
                found, label = [], []
                for text, toxic in rows(iter([batch]), "text", "toxic"):
                    hashes = _distinct(text)
                    hashes = hashes[keep[hashes >> np.uint64(64 - _BITS)]]
                    found.append(hashes.view(np.int64))
                    label.append(np.full(len(hashes), toxic, dtype=np.int32))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), pa.array(np.concatenate(label))], ["hash", "toxic"])

        counted = sample.mapInArrow(exact, "hash long, toxic int").groupBy("hash").agg(
            F.sum(1 - F.col("toxic")).alias("n0"), F.sum("toxic").alias("n1")
        )
        slot = F.shiftrightunsigned("hash", 64 - _SLOTS)
        best = (
            counted.filter(f"n0 + n1 >= {MIN_ROWS}")
            .withColumn("_w", weight)
            .withColumn("_r", ratio)
            .groupBy(slot.alias("slot"))
            .agg(F.max(F.struct("_w", "hash", "_r")).alias("b"))
            .orderBy(F.col("b._w").desc(), "b.hash")
            .limit(features)
            .select("b.hash", "b._r")
            .collect()
        )
        hashes = np.array([r["hash"] for r in best], dtype=np.int64).view(np.uint64)
        ratios = np.array([r["_r"] for r in best], dtype=np.float64)
        order = np.argsort(hashes)
        hashes, ratios = hashes[order], ratios[order]

        def active(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found, label = [], []
                for text, toxic in rows(iter([batch]), "text", "toxic"):
                    at = np.searchsorted(hashes, own := _distinct(text))
                    at = at[(at < len(hashes)) & (hashes[np.minimum(at, max(0, len(hashes) - 1))] == own)] if len(hashes) else at[:0]
                    found.append(at.astype("<i4").tobytes())
                    label.append(toxic)
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(label, pa.int32())], ["at", "toxic"])

        design = sample.mapInArrow(active, "at binary, toxic int").collect()
    finally:
        sample.unpersist()
    design = sorted((bytes(r["at"]), r["toxic"]) for r in design)
    columns = [np.frombuffer(a, dtype="<i4") for a, _ in design]
    target = np.array([t for _, t in design], dtype=float)
    weights, intercept = _logistic(columns, target, ratios, l2)
    # The sample may hold the classes in other shares than the labels do.
    drawn = float(np.log((target.sum() + 0.5) / (len(target) - target.sum() + 0.5)))
    return Model(hashes, weights * ratios, intercept + prior - drawn)


def _logistic(columns: list[np.ndarray], target: np.ndarray, ratios: np.ndarray, l2: float, steps: int = 200) -> tuple[np.ndarray, float]:
    """Logistic regression on ratio-scaled presence features: accelerated gradient with restarts.
    The penalty is l2 / rows; the scaled row norm bounds the step."""
    n, at = len(columns), np.concatenate(columns) if columns else np.empty(0, dtype=np.int32)
    row = np.repeat(np.arange(n), [len(c) for c in columns])
    scale = ratios[at]
    norms = np.bincount(row, weights=scale**2, minlength=n) + 1.0
    # Rows of long texts have many features; each row is brought to the norm of a middling one.
    x, b = np.zeros(len(ratios)), 0.0
    ahead, ahead_b, momentum, last = x, b, 1.0, np.inf
    step = 4.0 / float(np.mean(norms) * 4 + l2 / n)
    for _ in range(steps):
        z = np.bincount(row, weights=scale * ahead[at], minlength=n) + ahead_b
        p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        loss = -np.mean(target * np.log(p + 1e-12) + (1 - target) * np.log(1 - p + 1e-12)) + l2 / (2 * n) * ahead @ ahead
        if loss > last:
            momentum, step = 1.0, step * 0.7
            ahead, ahead_b = x, b
            last = np.inf
            continue
        last = loss
        gap = (p - target) / n
        new = ahead - step * (np.bincount(at, weights=scale * gap[row], minlength=len(ratios)) + l2 / n * ahead)
        new_b = ahead_b - step * gap.sum()
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead, ahead_b = new + (momentum - 1) / following * (new - x), new_b + (momentum - 1) / following * (new_b - b)
        x, b, momentum = new, new_b, following
    return x, b


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row; score is the probability of label 1.

    Null and empty texts get the score of a text without features; texts are read whole; repeated
    rows repeat their result; null ids stay null; an empty table gives no rows; columns besides
    ``doc_id`` and ``text`` are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            keys, found = [], []
            for ids, part in _slices(batch):
                keys += ids
                found.append(scorer.scores(part))
            scores = np.concatenate(found) if found else np.empty(0)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return texts(docs).mapInArrow(run, "doc_id long, score double")


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    ids: list = []
    part: list[str] = []
    size = 0
    for key, text in rows(iter([batch]), "doc_id", "text"):
        if ids and size + len(text) > _CHARS:
            yield ids, part
            ids, part, size = [], [], 0
        ids.append(key)
        part.append(text)
        size += len(text)
    if ids:
        yield ids, part


def remove_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, with all their columns."""
    names = docs.schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            plain = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows, pa.int64()), batch.column(names.index("text")).fill_null("")], ["doc_id", "text"])
            found = [scorer.scores(part) for _, part in _slices(plain)]
            keep = np.concatenate(found) < threshold if found else np.empty(0, dtype=bool)
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def is_held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: crc32 of the id as text is divisible by 5."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0
