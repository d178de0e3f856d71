"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

Tokens are UTF-16 units of the lower-cased text with white space as one blank, between start marks
and an end mark; a gram of up to four units is one 64-bit number, so prefixes and suffixes are
shifts and masks. All trusted text is counted but for a tenth, which the thresholds need. Counts, contexts and continuations are tables keyed
by gram, joined order by order, so the model is built in shards whatever its size.

A document's perplexity sums the log-probabilities of all its positions. A model of at most
``BROADCAST_GRAMS`` grams is sent to the tasks; a larger one is joined with the documents' grams.
Documents are kept whose perplexity lies between two quantiles of the trusted documents of their
language, the upper one of those that the model did not count.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaywright.llm.frames import drop_finished_shuffles, rows
from delaywright.runtime import spool

ORDER = 4
LOW, HIGH = 0.001, 0.99
#: One in so many trusted documents is not counted; the upper threshold comes from these.
LEFT_OUT = 10
#: Up to so many grams (20 bytes each) are broadcast.
BROADCAST_GRAMS = 8_000_000
#: Up to so many ids of trusted documents (8 bytes each) are broadcast.
BROADCAST_IDS = 5_000_000
_START, _END = 2, 3
_SPACE = re.compile(r"\s+")
_UNITS = 1_000_000


def units(text: str) -> np.ndarray:
    """The tokens of a text with its marks: three starts, the units, the end."""
    folded = _SPACE.sub(" ", text.lower()).strip()
    own = np.frombuffer(folded.encode("utf-16-le", "surrogatepass"), dtype="<u2")
    return np.concatenate([np.full(ORDER - 1, _START, np.uint16), own, np.array([_END], np.uint16)])


def grams(flat: np.ndarray) -> np.ndarray:
    """The gram of ``ORDER`` units that ends at each unit from the fourth on."""
    wide = flat.astype(np.uint64)
    found = np.zeros(max(0, len(wide) - ORDER + 1), dtype=np.uint64)
    for k in range(ORDER):
        found = (found << np.uint64(16)) | wide[k : k + len(found)]
    return found


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.col("lang").cast("string").alias("lang"),
    )


def _positions(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(grams, text of each) of all positions of several texts."""
    parts = [units(t) for t in texts]
    flat = np.concatenate(parts)
    ends = np.cumsum([len(p) for p in parts])
    found = grams(flat)
    owner = np.searchsorted(ends, np.arange(len(found)) + ORDER - 1, side="right")
    begin = ends - [len(p) for p in parts]
    inside = np.arange(len(found)) >= begin[owner]
    return found[inside], owner[inside]


def _slices(batch: pa.RecordBatch, *columns: str) -> Iterator[list[tuple]]:
    part, size = [], 0
    for row in rows(iter([batch]), *columns):
        if part and size + len(row[0]) > _UNITS:
            yield part
            part, size = [], 0
        part.append(row)
        size += len(row[0])
    if part:
        yield part


def count_grams(trusted: DataFrame) -> DataFrame:
    """``gram, n``: how often each gram of four units occurs in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, "text"):
                found, n = np.unique(_positions([t for (t,) in part])[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["gram", "n"])

    counted = trusted.select("text").mapInArrow(run, "gram long, n long")
    return counted.groupBy("gram").agg(F.sum("n").alias("n"))


def _prefix(gram: str = "gram") -> Column:
    return F.shiftrightunsigned(F.col(gram), 16)


def _suffix(k: int, gram: str = "gram") -> Column:
    return F.col(gram).bitwiseAND(F.lit((1 << 16 * (k - 1)) - 1))


@dataclass(frozen=True)
class Model:
    """``table``: (k, gram, logp, backoff) of every gram of k units seen in the trusted text;
    ``logp`` given the units before its last, ``backoff`` the log weight of shorter contexts after
    the gram (0 where it is no context). ``unseen`` is the log-probability of a new unit."""

    table: DataFrame
    unseen: float
    n_grams: int


def _discounts(counted: DataFrame) -> list[float]:
    """The discounts of grams seen once, twice, and more often, from the counts of counts."""
    found = {r["c"]: r["n"] for r in counted.groupBy(F.least("n", F.lit(5)).alias("c")).agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n2, n3, n4 = (found.get(i, 0) for i in range(1, 5))
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    # Small texts can have odd counts of counts; a discount stays between a trace and its count.
    return [min(max(d, 0.1), i + 0.9) for i, d in enumerate(raw)]


def train(trusted: DataFrame) -> Model:
    """The model of all ``trusted`` texts (column ``text``, no nulls). Without any text every unit
    is as likely as every other of 65,536."""
    counts = {ORDER: spool(count_grams(trusted), "grams")}
    drop_finished_shuffles(trusted.sparkSession)
    for k in range(ORDER, 1, -1):
        # Kneser-Ney: a shorter gram counts once for each unit it follows.
        counts[k - 1] = spool(counts[k].groupBy(_suffix(k).alias("gram")).agg(F.count(F.lit(1)).alias("n")), f"grams{k - 1}")
    total = counts[1].agg(F.sum("n").alias("t"), F.count(F.lit(1)).alias("v")).first()
    if not total["v"]:
        empty = counts[1].select(F.lit(1).alias("k"), "gram", F.lit(0.0).alias("logp"), F.lit(0.0).alias("backoff"))
        return Model(empty, float(-np.log(65_536.0)), 0)
    size = total["v"] + 1
    below = None
    levels = []
    for k in range(1, ORDER + 1):
        d = _discounts(counts[k])
        n = F.col("n")
        discount = F.when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])
        if k == 1:
            left = counts[1].agg(F.sum(discount)).first()[0]
            unseen = left / total["t"] / size
            prob = counts[1].select("gram", ((n - discount) / total["t"] + unseen).alias("p"))
        else:
            contexts = counts[k].groupBy(_prefix().alias("context")).agg(
                F.sum("n").alias("all"), (F.sum(discount) / F.sum("n")).alias("gamma")
            )
            own = counts[k].select("gram", "n", _prefix().alias("context"), _suffix(k).alias("shorter"))
            lower = below.select(F.col("gram").alias("shorter"), F.col("p").alias("q"))
            prob = own.join(contexts, "context").join(lower, "shorter").select(
                "gram", ((n - discount) / F.col("all") + F.col("gamma") * F.col("q")).alias("p")
            )
            # Start marks alone are contexts that no text ends with, so they have no probability.
            weights = contexts.select(F.col("context").alias("gram"), F.log("gamma").alias("backoff"))
            known = levels[-1].drop("backoff").join(weights, "gram", "full")
            levels[-1] = known.select(
                F.lit(k - 1).alias("k"), "gram", F.coalesce("logp", F.lit(float("-inf"))).alias("logp"), F.coalesce("backoff", F.lit(0.0)).alias("backoff")
            )
        below = spool(prob, f"probabilities{k}")
        levels.append(below.select(F.lit(k).alias("k"), "gram", F.log("p").alias("logp"), F.lit(0.0).alias("backoff")))
    table = levels[0]
    for level in levels[1:]:
        table = table.unionByName(level)
    table = spool(table, "model")
    return Model(table, float(np.log(unseen)), table.count())


class Lookup:
    """All grams of a model in one open-addressing table."""

    def __init__(self, k: np.ndarray, gram: np.ndarray, logp: np.ndarray, backoff: np.ndarray, unseen: float):
        self.unseen = unseen
        self.size = 1 << max(4, int(2 * len(gram)).bit_length())
        self.key = np.zeros(self.size, dtype=np.uint64)
        self.order = np.zeros(self.size, dtype=np.uint8)
        self.logp = np.zeros(self.size)
        self.backoff = np.zeros(self.size)
        self.probes = 1
        at, rest = self._slot(k, gram), np.arange(len(gram))
        while len(rest):
            # The first of those that want a free slot gets it; the others go on to the next.
            free = self.order[at] == 0
            slot, first = np.unique(at[free], return_index=True)
            won = rest[free][first]
            self.key[slot], self.order[slot] = gram[won], k[won]
            self.logp[slot], self.backoff[slot] = logp[won], backoff[won]
            lost = np.ones(len(rest), dtype=bool)
            lost[np.flatnonzero(free)[first]] = False
            rest, at = rest[lost], (at[lost] + 1) % self.size
            self.probes += 1

    def _slot(self, k: np.ndarray | int, gram: np.ndarray) -> np.ndarray:
        mixed = (gram + np.asarray(k, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        return ((mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)).astype(np.int64) & (self.size - 1)

    def find(self, k: int, gram: np.ndarray) -> np.ndarray:
        """Slot of each gram of ``k`` units, -1 if it is not in the model."""
        at, found = self._slot(k, gram), np.full(len(gram), -1, dtype=np.int64)
        rest = np.arange(len(gram))
        for _ in range(self.probes):
            here = at[rest]
            hit = (self.key[here] == gram[rest]) & (self.order[here] == k)
            found[rest[hit]] = here[hit]
            rest = rest[~hit & (self.order[here] != 0)]
            if not len(rest):
                break
            at[rest] = (at[rest] + 1) & (self.size - 1)
        return found

    def scores(self, gram: np.ndarray) -> np.ndarray:
        """Log-probability of the last unit of each gram given those before it."""
        total = np.zeros(len(gram))
        rest, own = np.arange(len(gram)), gram
        for k in range(ORDER, 0, -1):
            at = self.find(k, own)
            hit = (at >= 0) & (self.logp[at] > -np.inf)
            total[rest[hit]] += self.logp[at[hit]]
            rest, own = rest[~hit], own[~hit]
            if not len(rest):
                return total
            if k > 1:
                context = self.find(k - 1, own >> np.uint64(16))
                total[rest] += np.where(context >= 0, self.backoff[context], 0.0)
                own = own & np.uint64((1 << 16 * (k - 1)) - 1)
        total[rest] += self.unseen
        return total


_LOOKUPS: dict[str, Lookup] = {}


def _kept_lookup(sent: tuple) -> Lookup:
    """The table of a model, built once in each Python worker and kept for its next tasks."""
    name, *parts = sent
    if name not in _LOOKUPS:
        _LOOKUPS.clear()
        _LOOKUPS[name] = Lookup(*parts)
    return _LOOKUPS[name]


def perplexities(docs: DataFrame, model: Model, broadcast_grams: int = BROADCAST_GRAMS) -> DataFrame:
    """``doc_id, lang, n_tokens, perplexity`` of every row of ``docs`` (``doc_id, text, lang``).

    A null or empty text is the end mark alone. Texts are read whole; repeated rows repeat their
    result; null ids and languages stay null; an empty table gives no rows; other columns are not
    read.
    """
    if model.n_grams > broadcast_grams:
        return _by_join(_documents(docs), model)
    table = model.table.toPandas()
    parts = (
        table["k"].to_numpy().astype(np.uint8),
        table["gram"].to_numpy().astype(np.int64).view(np.uint64),
        table["logp"].to_numpy(),
        table["backoff"].to_numpy(),
    )
    sent = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, *parts, model.unseen))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _kept_lookup(sent.value)
        for batch in batches:
            keys, langs, counts, values = [], [], [], []
            for part in _slices(batch, "text", "doc_id", "lang"):
                found, owner = _positions([t for t, _, _ in part])
                n = np.bincount(owner, minlength=len(part))
                sums = np.bincount(owner, weights=lookup.scores(found), minlength=len(part))
                keys += [k for _, k, _ in part]
                langs += [lang for _, _, lang in part]
                counts.append(n)
                values.append(np.exp(-sums / n))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()),
                    pa.array(langs, pa.string()),
                    pa.array(np.concatenate(counts) if counts else [], pa.int64()),
                    pa.array(np.concatenate(values) if values else [], pa.float64()),
                ],
                ["doc_id", "lang", "n_tokens", "perplexity"],
            )

    return _documents(docs).mapInArrow(run, "doc_id long, lang string, n_tokens long, perplexity double")


def _by_join(docs: DataFrame, model: Model) -> DataFrame:
    """The same by joining each document's distinct grams with the model, order by order. Rows are
    named by a hash of id and text, so that repeated rows are scored once and counted as often."""
    named = docs.withColumn("_row", F.xxhash64("doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, key in rows(iter([batch]), "text", "_row"):
                found, n = np.unique(_positions([text])[0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found), key)), pa.array(found.view(np.int64)), pa.array(n)], ["_row", "gram", "n"]
                )

    once = named.select("_row", "text").dropDuplicates(["_row"])
    left = once.mapInArrow(run, "_row long, gram long, n long").withColumn("carry", F.lit(0.0))
    scored = None
    for k in range(ORDER, 0, -1):
        own = model.table.filter((F.col("k") == k) & (F.col("logp") > float("-inf"))).select("gram", "logp")
        met = spool(left.join(own, "gram", "left"), f"met{k}")
        part = met.filter("logp is not null").select("_row", "n", (F.col("carry") + F.col("logp")).alias("v"))
        scored = part if scored is None else scored.unionByName(part)
        left = met.filter("logp is null").drop("logp")
        if k > 1:
            weights = model.table.filter(F.col("k") == k - 1).select(F.col("gram").alias("context"), "backoff")
            left = left.withColumn("context", _prefix()).join(weights, "context", "left").select(
                "_row", _suffix(k).alias("gram"), "n", (F.col("carry") + F.coalesce("backoff", F.lit(0.0))).alias("carry")
            )
    rest = left.select("_row", "n", (F.col("carry") + F.lit(model.unseen)).alias("v"))
    sums = scored.unionByName(rest).groupBy("_row").agg(
        F.sum("n").alias("n_tokens"), F.exp(-F.sum(F.col("n") * F.col("v")) / F.sum("n")).alias("perplexity")
    )
    return named.select("doc_id", "lang", "_row").join(sums, "_row").select("doc_id", "lang", "n_tokens", "perplexity")


def classify(docs: DataFrame, labels: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """``doc_id, lang, n_tokens, perplexity, lowest, highest, kept`` of every row of ``docs``.

    Trusted documents are those that ``labels`` (``doc_id, quality``) gives quality 1. A hash of the
    id leaves one in ``LEFT_OUT`` of them out of the model, which counts all others. ``lowest`` is the
    ``low`` quantile of the trusted documents' perplexities; ``highest`` is the ``high`` quantile of
    those left out (what a model has counted looks more familiar than new text of its kind), or of
    all trusted documents where that is more. Both are those of the document's language, or over all
    languages where it has none. Without trusted documents every document is kept. Edge cases as in
    :func:`perplexities`.
    """
    good = labels.filter("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    left_out = F.pmod(F.xxhash64("doc_id"), F.lit(LEFT_OUT)) == 0
    good = spool(good.withColumn("left_out", left_out), "trusted")
    # Few ids go to the texts; with more of them the texts are joined by shuffle.
    few = good.count() <= BROADCAST_IDS

    def sent(ids: DataFrame) -> DataFrame:
        return F.broadcast(ids) if few else ids

    model = train(_documents(docs).join(sent(good.filter("not left_out")), "doc_id", "left_semi").select("text"))
    found = spool(perplexities(docs, model), "perplexities")
    trusted = found.join(sent(good), "doc_id").select(F.col("lang").alias("_lang"), "perplexity", "left_out")
    ends = F.array(F.lit(low), F.lit(high))
    every = F.percentile_approx("perplexity", ends, 10_000)
    new = F.percentile_approx(F.when(F.col("left_out"), F.col("perplexity")), high, 10_000)
    bounds = F.array(every[0], F.greatest(every[1], new)).alias("bounds")
    by_lang = trusted.groupBy("_lang").agg(bounds)
    overall = trusted.agg(bounds).first()["bounds"]
    overall = [0.0, float("inf")] if None in overall else overall
    either = F.coalesce("bounds", F.array(*[F.lit(b) for b in overall]))
    return (
        found.join(by_lang, F.col("lang").eqNullSafe(F.col("_lang")), "left")
        .select("doc_id", "lang", "n_tokens", "perplexity", either[0].alias("lowest"), either[1].alias("highest"))
        .withColumn("kept", (F.col("perplexity") >= F.col("lowest")) & (F.col("perplexity") <= F.col("highest")))
    )
