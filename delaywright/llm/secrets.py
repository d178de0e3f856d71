"""Secret scans: fixed rules, and character Markov models compared by log-likelihood ratio.

First-order models over the characters secrets are made of describe random strings, one for each
alphabet, and ordinary identifiers, one for each way of joining words; they are counted from
labelled samples. A run of such characters, without the parts that a rule has found, is reported as
``random`` when the mixture of the random models explains it better than that of the ordinary
ones by more than a margin, which is calibrated on samples held out from training. A run that is
not random as a whole is looked at again between its ``/`` and ``=``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaywright.llm import stringsamples
from delaywright.llm.frames import rows, slices, texts

#: The rules, in the order in which kinds are listed (fixed values).
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
MIN_LENGTH = 20
MARGIN = 4.0

_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
# A greedy run that is long enough is the same match with the length inside the pattern.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
_N = len(ALPHABET) + 1
_CODE = np.zeros(256, dtype=np.uint8)
_CODE[np.frombuffer(ALPHABET.encode(), dtype=np.uint8)] = np.arange(1, _N)
_TRANSLATE = _CODE.tobytes()

Span = tuple[int, int, int]  # start, place of the kind in KINDS, end


def rule_spans(text: str) -> list[Span]:
    """What the fixed rules find: leftmost non-overlapping matches of each kind, by start."""
    found: list[Span] = []
    folded = text.lower()
    if any(w in folded for w in _WORDS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def secret_values(text: str) -> list[str]:
    """The secrets themselves among the rules' matches (without the name before them)."""
    found = [m[2] for m in _ASSIGN.finditer(text) if len(m[2]) >= 6] if any(w in text.lower() for w in _WORDS) else []
    return found + _ACCESS.findall(text) + _HEX.findall(text)


@dataclass(frozen=True)
class MarkovModels:
    """``random`` and ``ordinary``: log-probabilities of b after a (in one row for each model, by
    a * N + b; 0 is the start). ``margin`` is the log-likelihood ratio that a secret exceeds."""

    random: np.ndarray
    ordinary: np.ndarray
    margin: float = MARGIN

    @classmethod
    def from_counts(cls, counts: dict[tuple[int, str], np.ndarray], margin: float = MARGIN) -> MarkovModels:
        """``counts[label, kind]`` of transitions; label 1 is random. A class without samples has the
        even model; one of repeated characters, as in ruled lines, is always among the ordinary ones."""
        classes = []
        for label in (1, 0):
            own = [c for (at, _), c in sorted(counts.items()) if at == label and c.any()]
            classes.append([_log_chances(c) for c in own or [np.zeros(_N * _N)]])
        classes[1].append(_log_chances(1000 * np.eye(_N).ravel()))
        return cls(*map(np.stack, classes), margin)

    def score(self, run: str) -> float:
        """The log-likelihood ratio of a run of alphabet characters, random against ordinary."""
        codes = np.frombuffer(run.encode("ascii").translate(_TRANSLATE), dtype=np.uint8).astype(np.int32)
        steps = np.concatenate([codes[:1], codes[:-1] * _N + codes[1:]])
        return _mixed(self.random[:, steps].sum(axis=1)) - _mixed(self.ordinary[:, steps].sum(axis=1))

    def spans(self, text: str, taken: list[Span], min_length: int, margin: float | None = None) -> list[Span]:
        """Runs of ``text``, cut at the spans in ``taken``; parts shorter than ``min_length`` are left out."""
        margin = self.margin if margin is None else margin
        found: list[Span] = []
        pattern, at = _long_run(min_length), 0
        for start, _, end in [*sorted(taken), (len(text), 0, len(text))]:
            if start - at >= min_length:
                for m in pattern.finditer(text, at, start):
                    found += self._within(m[0], m.start(), min_length, margin)
            at = max(at, end)
        return found

    def _within(self, run: str, at: int, min_length: int, margin: float) -> list[Span]:
        if self.score(run) > margin:
            return [(at, 3, at + len(run))]
        parts = [m for m in _PART.finditer(run) if min_length <= len(m[0]) < len(run)]
        return [(at + m.start(), 3, at + m.end()) for m in parts if self.score(m[0]) > margin]


_PART = re.compile(r"[^/=]+")


def _mixed(logs: np.ndarray) -> float:
    """The logarithm of the mean likelihood."""
    most = logs.max()
    return float(most + np.log(np.exp(logs - most).mean()))


def _log_chances(counts: np.ndarray, prior: float = 0.5) -> np.ndarray:
    """Each row smoothed by ``prior`` evenly spread symbols, and by as many of the model's own
    symbols, so that an unseen step to a symbol of the model's alphabet is likelier than one out of it."""
    table = counts.reshape(_N, _N).astype(float)
    table[:, 0] = 0
    symbols = table.sum(axis=0)
    own = symbols / symbols.sum() if symbols.any() else np.full(_N, 1.0 / (_N - 1))
    even = np.full(_N, 1.0 / (_N - 1))
    smooth = table + 4 * prior * own + prior / 10 * even
    return np.log(smooth / smooth.sum(axis=1, keepdims=True)).ravel()


_LONG: dict[int, re.Pattern] = {}


def _long_run(min_length: int) -> re.Pattern:
    if min_length not in _LONG:
        _LONG[min_length] = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % min_length)
    return _LONG[min_length]


def _transitions(data: bytes) -> np.ndarray:
    """Counts of (before, after) over the runs of alphabet characters in ``data``."""
    codes = np.frombuffer(data.translate(_TRANSLATE), dtype=np.uint8).astype(np.int32)
    before = np.concatenate([[0], codes[:-1]])
    return np.bincount((before * _N + codes)[codes > 0], minlength=_N * _N)


_COUNTED = "label int, kind string, code int, n long"


def _sum_counts(counted: DataFrame) -> dict[tuple[int, str], np.ndarray]:
    """All models' counts from partial ones; a few kinds of (len(ALPHABET) + 1) ** 2 sums each."""
    counts: dict[tuple[int, str], np.ndarray] = {}
    for row in counted.groupBy("label", "kind", "code").agg(F.sum("n").alias("n")).collect():
        counts.setdefault((row["label"], row["kind"]), np.zeros(_N * _N))[row["code"]] = row["n"]
    return counts


def _emit(counts: dict[tuple[int, str], np.ndarray]) -> pa.RecordBatch:
    found = [(label, kind, code, n) for (label, kind), own in counts.items() for code, n in zip(np.flatnonzero(own).tolist(), own[own > 0].tolist(), strict=True)]
    columns = list(zip(*found, strict=True)) if found else [()] * 4
    kinds = [pa.int32(), pa.string(), pa.int32(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["label", "kind", "code", "n"])


def train(samples: DataFrame, margin: float = MARGIN) -> MarkovModels:
    """Models from labelled samples: columns ``sample`` (string), ``label`` (1: random, 0: ordinary)
    and, if there, ``kind``: each kind of a class has a model of its own. Rows with a null sample or
    label, or another label, take no part; without rows of a class its model is the even one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[int, str], np.ndarray] = {}
        for sample, label, kind in rows(batches, "sample", "label", "kind"):
            own = counts.setdefault((label, kind), np.zeros(_N * _N, dtype=np.int64))
            own += _transitions(sample.encode("utf-8", "surrogatepass"))
        yield _emit(counts)

    kind = F.coalesce(F.col("kind").cast("string"), F.lit("")) if "kind" in samples.columns else F.lit("")
    known = samples.select(F.col("sample").cast("string").alias("sample"), F.col("label").cast("int").alias("label"), kind.alias("kind"))
    known = known.filter("sample is not null and label in (0, 1)")
    return MarkovModels.from_counts(_sum_counts(known.mapInArrow(run, _COUNTED)), margin)


#: Samples of each class that the models are trained on, and calibrated on.
SAMPLES = 6000
#: Shares of the held-out samples: ordinary ones that may be called random, random ones that may be lost.
FALSE_SHARE, LOST_SHARE = 0.001, 0.01


def train_on_documents(docs: DataFrame, samples: int = SAMPLES) -> MarkovModels:
    """Models from two sources of labelled samples: generated random strings and identifiers
    (:mod:`stringsamples`), and the documents. What the rules find in any text is a random sample;
    the words of all texts, joined in the ways identifiers are, are ordinary ones. The margin is as
    great as finding all but ``LOST_SHARE`` of held-out random strings allows, but no less than leaving
    all but ``FALSE_SHARE`` of held-out identifiers unreported asks for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {(label, kind): np.zeros(_N * _N, dtype=np.int64) for label, kind in ((1, "found"), *((0, k) for k in _STYLES))}
        for _, data in slices(batches):
            clean = []
            for raw in data:
                text = raw.decode("utf-8", "surrogatepass")
                values = secret_values(text)
                counts[1, "found"] += _transitions(" ".join(values).encode()) if values else 0
                clean.append(_masked(text, rule_spans(text), " ")[0].encode("utf-8", "surrogatepass") if values else raw)
            words = [w for w in b" ".join(clean).translate(_WORD_BYTES).split() if len(w) > 1]
            for kind, joined in _joined(words):
                counts[0, kind] += _transitions(joined)
        yield _emit(counts)

    counts = _sum_counts(texts(docs).mapInArrow(run, _COUNTED))
    for label, made in ((1, stringsamples.random_strings(samples)), (0, stringsamples.ordinary_strings(samples))):
        for kind, text in made:
            own = counts.setdefault((label, f"made {kind}"), np.zeros(_N * _N))
            own += _transitions(text.encode())
    # Words joined by any of the separators; and everything ordinary in one model, for mixtures.
    if (0, "joined") in counts:
        counts[0, "joined"] = _any_separator(counts[0, "joined"])
    ordinary = [c / c.sum() for (label, _), c in counts.items() if label == 0 and c.any()]
    counts[0, "mixed"] = np.mean(ordinary, axis=0) * 100_000
    models = MarkovModels.from_counts(counts)
    ordinary, random = (
        sorted(models.score(text) for _, text in made(samples, seed=2)) for made in (stringsamples.ordinary_strings, stringsamples.random_strings)
    )
    margin = max(ordinary[int(samples * (1 - FALSE_SHARE))], random[int(samples * LOST_SHARE)])
    return replace(models, margin=margin)


#: The ways in which words of texts are joined to ordinary samples.
_STYLES = ("joined", "camel", "upper")
_WORD_BYTES = bytes(b if chr(b).isalnum() and b < 128 else 0x20 for b in range(256))


def _joined(words: list[bytes]) -> Iterator[tuple[str, bytes]]:
    line = b" ".join(words)
    yield "joined", line.lower().replace(b" ", b"_")
    yield "camel", line.title().replace(b" ", b"")
    yield "upper", line.upper().replace(b" ", b"_")


def _any_separator(counts: np.ndarray) -> np.ndarray:
    """The counts of words joined by ``_`` as if ``_``, ``-`` and ``/`` had been used alike."""
    table = counts.reshape(_N, _N).astype(float)
    places = [ALPHABET.index(c) + 1 for c in "_-/"]
    table[:, places] = table[:, [ALPHABET.index("_") + 1]] / len(places)
    table[places] = table[[ALPHABET.index("_") + 1]] / len(places)
    return table.ravel()


def scan(
    docs: DataFrame, models: MarkovModels, min_length: int = MIN_LENGTH, margin: float | None = None
) -> DataFrame:
    """``doc_id, spans`` of every row; a span is (kind, start, end, value), by start, then kind.

    Positions are code points, ends exclusive. Null and empty texts have no spans; texts are read
    whole; repeated rows repeat their result; null ids stay null; an empty table gives no rows;
    columns besides ``doc_id`` and ``text`` are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())]))
        for batch in batches:
            keys, found = [], []
            for key, text in rows(iter([batch]), "doc_id", "text"):
                base = rule_spans(text)
                spans = sorted(base + models.spans(text, base, min_length, margin))
                keys.append(key)
                found.append([{"kind": KINDS[k], "start": s, "end": e, "value": text[s:e]} for s, k, e in spans])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(found, kind)], ["doc_id", "spans"])

    return texts(docs).mapInArrow(
        run, "doc_id long, spans array<struct<kind:string,start:int,end:int,value:string>>"
    )


def span_digests(scanned: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` from the result of :func:`scan`."""

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"] != KINDS[3])
    return scanned.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def redact(
    docs: DataFrame, models: MarkovModels, mask: str = "[secret]", min_length: int = MIN_LENGTH, margin: float | None = None
) -> DataFrame:
    """``docs`` with every found span replaced by ``mask`` (overlapping spans by one); columns,
    rows and null texts stay. ``n_chars`` follows the text where it changes."""
    schema = docs.schema
    names = schema.names
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, chars = [], []
            old = batch.column(names.index("n_chars")).to_pylist() if "n_chars" in names else [None] * batch.num_rows
            for (text,), n in zip(rows(iter([batch]), "text"), old, strict=True):
                base = rule_spans(text) if text else []
                spans = sorted(base + models.spans(text, base, min_length, margin)) if text else []
                if spans:
                    text, n = _masked(text, spans, mask)
                out.append(text)
                chars.append(n)
            columns = list(batch.columns)
            columns[at] = pa.array(out, columns[at].type)
            if "n_chars" in names:
                columns[names.index("n_chars")] = pa.array(chars, columns[names.index("n_chars")].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, schema)


def _masked(text: str, spans: list[Span], mask: str) -> tuple[str, int]:
    parts, at = [], 0
    for start, _, end in spans:
        if start >= at:
            parts += [text[at:start], mask]
        at = max(at, end)
    found = "".join(parts) + text[at:]
    return found, len(found)


def sha256_of_spans(spans: list[Span]) -> str:
    """The digest of spans that :func:`span_digests` gives, for checks outside Spark."""
    return hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()
