"""Packing documents into fixed windows by non-negative least squares over length combinations.

A document's ids (its tokens and one end id) are cut into full windows and one remainder shorter
than a window. The histogram of remainders has one bin for each length, whatever the corpus. Every
way to fill a window with at most ``depth`` remainders is a column; non-negative least squares
finds how often to use each, the counts are rounded down, and what is left over is packed greedily:
each left-over goes into the open window, and what does not fit is cut off and opens the next.

Only the histogram and the plan (both bounded by the window) pass through the driver. Remainders
of one length are interchangeable, so a remainder's number within its length, made of a number
within its task and a prefix sum over tasks, says where it goes.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaywright.llm.frames import rows, texts
from delaywright.runtime import spool

WINDOW = 1024
DEPTH = 3
END_ID = 0
#: How the byte-level vocabulary splits a text before merging (a fixed value of that vocabulary).
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """Letter -> byte of byte-level vocabularies: visible bytes stand for themselves, the others
    follow from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteCoder:
    """Ids of whole texts under a byte-level vocabulary file.

    The file's added tokens are found in the text first and have ids of their own; what stands
    between them is encoded as if it were a whole text.
    """

    def __init__(self, vocabulary: str):
        with open(vocabulary, encoding="utf-8") as file:
            found = json.load(file)
        added = found.get("added_tokens") or []
        if any(t[flag] for t in added for flag in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{vocabulary}: an added token takes in more or less than its own characters")
        self._added = {t["content"]: np.array([t["id"]], dtype="<u4") for t in added}
        # Of two that begin at one place the longer one counts.
        longest = sorted(self._added, key=len, reverse=True)
        self._cut_added = re.compile(f"({'|'.join(map(re.escape, longest))})") if added else None
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in t): i for t, i in found["model"]["vocab"].items() if t not in self._added}
        encoding = tiktoken.Encoding("bytes", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})
        # One call for a text; without special tokens nothing is disallowed in it.
        self._between = partial(encoding.encode_to_numpy, disallowed_special=())

    def ids(self, text: str) -> np.ndarray:
        """The ids as little-endian unsigned 32-bit numbers."""
        if not any(t in text for t in self._added):
            return self._between(text).astype("<u4", copy=False)
        # Every second part is an added token.
        parts = self._cut_added.split(text)
        return np.concatenate([self._added[p] if i % 2 else self._between(p) for i, p in enumerate(parts)]).astype("<u4")


@lru_cache(maxsize=4)
def _coder(vocabulary: str) -> ByteCoder:
    """One for each vocabulary and worker."""
    return ByteCoder(vocabulary)


# ---------------------------------------------------------------- the plan


def combinations(window: int, depth: int) -> np.ndarray:
    """All ways to fill ``window`` with 1 to ``depth`` (at most 3) lengths, ascending, padded
    with zeros in front."""
    one = np.array([[0, 0, window]])
    short = np.arange(1, window // 2 + 1)
    two = np.stack([np.zeros_like(short), short, window - short], axis=1)
    three = [np.empty((0, 3), dtype=np.int64)]
    for a in range(1, window // 3 + 1):
        b = np.arange(a, (window - a) // 2 + 1)
        three.append(np.stack([np.full_like(b, a), b, window - a - b], axis=1))
    return np.concatenate([one, two, *three][: 1 if depth == 1 else 2 if depth == 2 else None])


def nonnegative_counts(combos: np.ndarray, histogram: np.ndarray, steps: int = 600) -> np.ndarray:
    """x >= 0 with sum over combos of x * (lengths used) near ``histogram`` in least squares.

    Accelerated projected gradient; a column has at most three entries, so a step is a gather and
    a weighted count.
    """
    window = len(histogram) - 1
    scale = max(1.0, float(histogram.max()))
    target = histogram / scale
    flat = combos.ravel()

    def used(x: np.ndarray) -> np.ndarray:
        counts = np.bincount(flat, weights=np.repeat(x, combos.shape[1]), minlength=window + 1)
        counts[0] = 0
        return counts

    weight = np.where(np.arange(window + 1) > 0, 1.0, 0.0)
    probe = np.ones(len(combos))
    for _ in range(20):
        probe = weight[combos] * used(probe)[combos]
        probe = probe.sum(axis=1)
        norm = np.linalg.norm(probe)
        probe /= norm
    step = 1.0 / (1.05 * norm)
    x = np.zeros(len(combos))
    ahead, momentum = x, 1.0
    for _ in range(steps):
        residual = (used(ahead) - target) * weight
        new = np.maximum(0.0, ahead - step * residual[combos].sum(axis=1))
        if np.dot(ahead - new, new - x) > 0:
            ahead, momentum = new, 1.0
        else:
            following = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
            ahead = new + (momentum - 1) / following * (new - x)
            momentum = following
        x = new
    return x * scale


@dataclass(frozen=True)
class Plan:
    """Where the n-th remainder of each length goes.

    Ranges of numbers, ordered by (length, first number): remainder ``number`` of ``length`` in a
    range lies in sequence ``sequence + number - first`` at ``offset``. Numbers of a length from
    ``rest[length]`` on are left-overs, laid end to end: token ``rest_at[length]`` onwards of the
    left-over stream, which starts with sequence ``rest_sequence`` and is cut at every window.
    """

    window: int
    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    rest: np.ndarray
    rest_at: np.ndarray
    rest_sequence: int
    n_sequences: int


def make_plan(histogram: np.ndarray, window: int = WINDOW, depth: int = DEPTH) -> Plan:
    """The plan for ``histogram[length]`` remainders of each length from 1 to ``window - 1``."""
    histogram = np.asarray(histogram, dtype=np.int64)
    combos = combinations(window, depth)
    known = np.append(histogram > 0, False)
    known[0] = True
    combos = combos[known[combos].all(axis=1)]
    taken = np.zeros(window + 1, dtype=np.int64)
    ranges: list[tuple[int, int, int, int]] = []
    sequence = 0
    left = np.append(histogram, 0)
    # Rounding down leaves room for another round over what is left, until nothing is gained.
    while len(combos):
        counts = np.floor(nonnegative_counts(combos, left.astype(float)) + 1e-6).astype(np.int64)
        gained = 0
        for k in np.argsort(-counts, kind="stable"):
            if counts[k] <= 0:
                break
            lengths, slots = np.unique(combos[k][combos[k] > 0], return_counts=True)
            repeat = int(min(counts[k], (left[lengths] // slots).min()))
            if repeat <= 0:
                continue
            at = 0
            for length in combos[k][combos[k] > 0]:
                ranges.append((int(length), int(taken[length]), sequence, at))
                taken[length] += repeat
                left[length] -= repeat
                at += int(length)
            sequence += repeat
            gained += repeat
        known = left > 0
        known[0] = True
        combos = combos[known[combos].all(axis=1)]
        if gained == 0 or gained < sequence // 100:
            break
    ranges.sort()
    table = np.array(ranges, dtype=np.int64).reshape(-1, 4)
    tokens = left * np.arange(window + 1)
    # Longest left-overs first, each length starting where the longer ones end.
    rest_at = tokens[::-1].cumsum()[::-1] - tokens
    n_rest = int(-(-tokens.sum() // window))
    return Plan(window, *table.T, taken, rest_at, sequence, sequence + n_rest)


# ---------------------------------------------------------------- the job

_PIECES = (
    "doc_id long, doc_tokens long, part int, full int, full_before long, full_crc array<long>, "
    "rest int, rest_number long, rest_crc long, rest_ids binary"
)


def _pieces(docs: DataFrame, vocabulary: str, window: int, end_id: int) -> DataFrame:
    """One row for each document: its windows' checksums, and its remainder with its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(vocabulary)
        part = TaskContext.get().partitionId()
        seen = np.zeros(window, dtype=np.int64)
        full_before = 0
        end = end_id.to_bytes(4, "little")
        step = 4 * window
        for batch in batches:
            out: list[list] = [[] for _ in range(10)]
            for key, text in rows(iter([batch]), "doc_id", "text"):
                ids = coder.ids(text).tobytes() + end
                full, rest = divmod(len(ids) // 4, window)
                cut = full * step
                row = (
                    key,
                    len(ids) // 4,
                    part,
                    full,
                    full_before,
                    [zlib.crc32(ids[i : i + step]) for i in range(0, cut, step)],
                    rest,
                    int(seen[rest]),
                    zlib.crc32(ids[cut:]),
                    ids[cut:],
                )
                for column, value in zip(out, row, strict=True):
                    column.append(value)
                seen[rest] += 1
                full_before += full
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            names = [c.split()[0] for c in _PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names)

    return texts(docs).mapInArrow(run, _PIECES)


def pack(
    docs: DataFrame,
    vocabulary: str,
    window: int = WINDOW,
    depth: int = DEPTH,
    end_id: int = END_ID,
) -> DataFrame:
    """Pack every row of ``docs`` into sequences of at most ``window`` ids.

    Returns one row for each piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset``. Each id of a document lies in exactly one piece; only the last sequence may be
    shorter than ``window``. Null and empty texts are the end id alone. Repeated rows are packed
    as often as they occur, null ids keep null; an empty table gives no rows; columns besides
    ``doc_id`` and ``text`` are not read. Texts of any length are cut into windows.
    """
    pieces = spool(_pieces(docs, vocabulary, window, end_id), "pieces")
    found = pieces.groupBy("rest").agg(F.count(F.lit(1)).alias("n")).collect()
    histogram = np.zeros(window, dtype=np.int64)
    for row in found:
        histogram[row["rest"]] = row["n"]
    histogram[0] = 0
    plan = make_plan(histogram, window, depth)

    by_rest = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    numbers = pieces.groupBy("rest", "part").agg(F.count(F.lit(1)).alias("n")).select(
        "rest", "part", F.coalesce(F.sum("n").over(by_rest), F.lit(0)).alias("rest_base")
    )
    windows = _running(pieces.groupBy("part").agg(F.sum("full").alias("n")), "part", "n", "full_base")
    placed = pieces.drop("rest_ids").join(numbers, ["rest", "part"]).join(windows, "part")
    whole = (
        placed.filter("full > 0")
        .select("doc_id", "doc_tokens", (F.col("full_base") + F.col("full_before")).alias("_at"), F.posexplode("full_crc").alias("_i", "ids_crc32"))
        .select(
            "doc_id",
            (F.col("_i").cast("long") * window).alias("start"),
            F.lit(window).cast("long").alias("length"),
            "ids_crc32",
            "doc_tokens",
            (F.lit(plan.n_sequences) + F.col("_at") + F.col("_i")).cast("long").alias("sequence_id"),
            F.lit(0).cast("long").alias("offset"),
        )
    )
    remainders = placed.filter("rest > 0").select(
        "doc_id", "doc_tokens", "part", "rest", "rest_number", (F.col("rest_base") + F.col("rest_number")).alias("number"), "rest_crc"
    )
    assigned = _assign(remainders, plan)
    uncut = assigned.filter("not is_cut").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
    cut = assigned.filter("is_cut").join(
        pieces.select("part", "rest", "rest_number", "rest_ids"), ["part", "rest", "rest_number"]
    )
    ids = F.expr("substring(rest_ids, cast(4 * (start - (doc_tokens - rest)) + 1 as int), cast(4 * length as int))")
    recounted = cut.select(
        "doc_id", "start", "length", F.crc32(ids).alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
    return whole.unionByName(uncut).unionByName(recounted)


def _running(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Sum of ``value`` over all smaller keys (one row for each input task), in two levels so that
    no task holds all keys."""
    block = F.expr(f"{key} div 4096").cast("int").alias("_b")
    # One row for each 4,096 input tasks comes to the driver.
    ahead, totals = 0, []
    for row in df.groupBy(block).agg(F.sum(value).alias("_t")).orderBy("_b").collect():
        totals.append((row["_b"], ahead))
        ahead += row["_t"]
    starts = df.sparkSession.createDataFrame(totals, "_b int, _t long")
    within = Window.partitionBy("_b").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.withColumn("_b", block)
        .withColumn("_w", F.coalesce(F.sum(value).over(within), F.lit(0)))
        .join(F.broadcast(starts), "_b")
        .select(key, (F.col("_w") + F.col("_t")).alias(name))
    )


def _assign(remainders: DataFrame, plan: Plan) -> DataFrame:
    """Sequence and offset of each remainder by binary search in the plan; a left-over that
    crosses the end of its sequence becomes two pieces."""
    window = plan.window
    big = np.int64(1) << 44
    keys = plan.length * big + plan.first
    schema = (
        "doc_id long, doc_tokens long, part int, rest int, rest_number long, start long, length long, "
        "ids_crc32 long, sequence_id long, offset long, is_cut boolean"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {n: batch.column(n) for n in batch.schema.names}
            rest = col["rest"].to_numpy().astype(np.int64)
            number = col["number"].to_numpy()
            tokens = col["doc_tokens"].to_numpy()
            left_over = number >= plan.rest[rest]
            sequence = np.zeros(len(rest), dtype=np.int64)
            offset = np.zeros(len(rest), dtype=np.int64)
            at = np.searchsorted(keys, rest * big + number, side="right") - 1
            ok = ~left_over
            sequence[ok] = plan.sequence[at[ok]] + number[ok] - plan.first[at[ok]]
            offset[ok] = plan.offset[at[ok]]
            stream = plan.rest_at[rest] + (number - plan.rest[rest]) * rest
            sequence[left_over] = plan.rest_sequence + stream[left_over] // window
            offset[left_over] = stream[left_over] % window
            length = np.minimum(rest, window - offset)
            tail = np.flatnonzero(length < rest)
            is_cut = length < rest
            order = np.concatenate([np.arange(len(rest)), tail])
            start = np.concatenate([tokens - rest, tokens[tail] - rest[tail] + length[tail]])
            take = pa.array(order)
            arrays = [col[n].take(take) for n in ("doc_id", "doc_tokens", "part", "rest", "rest_number")]
            arrays += [
                pa.array(start),
                pa.array(np.concatenate([length, rest[tail] - length[tail]])),
                col["rest_crc"].take(take),
                pa.array(np.concatenate([sequence, sequence[tail] + 1])),
                pa.array(np.concatenate([offset, np.zeros(len(tail), dtype=np.int64)])),
                pa.array(np.concatenate([is_cut, np.ones(len(tail), dtype=bool)])),
            ]
            yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in schema.split(", ")])

    return remainders.mapInArrow(run, schema)
