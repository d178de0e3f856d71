"""License scan by ordered signature rules, in DataFrame functions only.

A text is normalised to lower-case words, tested once for any gate, and only then tried against the
rules of which it holds a gate: words or phrases that every match of the rule contains. A match becomes an interval of words; an interval that
lies inside one of the same or a higher level is dropped. The places of the base phrases are kept
whatever covers them. Nothing is shuffled: all rules of a text are evaluated in its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaywright.llm.frames import texts
from delaywright.llm.license_rules import WEIGHTS, Rule, rules

#: What separates words, once A-Z is lower case (a fixed value).
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_OPEN, _CLOSE = "\u0001", "\u0002"
_DETECTION = "array<struct<label:string,level:int,first:int,last:int>>"


def spaced(pattern: str) -> str:
    """A rule's pattern over text in which every word has a blank of its own on either side."""
    return " (" + pattern.replace(" ", "  ") + ") "


def normalised(text: Column) -> Column:
    """`` w1  w2  w3 ``: each word, A-Z lower-cased, between two blanks of its own; no words: a blank."""
    folded = F.translate(text, _UPPER, _UPPER.lower())
    words = F.trim(F.regexp_replace(folded, SEPARATORS, " "))
    return F.concat(F.lit(" "), F.replace(words, F.lit(" "), F.lit("  ")), F.lit(" "))


def _places(words: Column, mark: str, at_end: bool) -> Column:
    found = F.transform(
        words, lambda w, i: F.when(w.endswith(mark) if at_end else w.startswith(mark), i)
    )
    return F.filter(found, lambda i: i.isNotNull())


def _detections(norm: Column, rule: Column) -> Column:
    """The intervals of words that match ``rule`` in ``norm``, leftmost and non-overlapping."""
    marked = F.regexp_replace(norm, rule["pattern"], F.lit(f" {_OPEN}$1{_CLOSE} "))
    words = F.split(F.trim(marked), "  ")
    ends = F.transform(
        F.array(words),
        lambda w: F.arrays_zip(_places(w, _OPEN, False).alias("first"), _places(w, _CLOSE, True).alias("last")),
    )
    return F.transform(
        ends[0],
        lambda p: F.struct(
            rule["label"].alias("label"), rule["level"].alias("level"), p["first"], p["last"]
        ),
    )


def scan(docs: DataFrame, signatures: list[Rule] | None = None) -> DataFrame:
    """``doc_id, n_words, base, detections`` of every row of ``docs``.

    ``base``: places of the base phrases, ``detections``: intervals that survive suppression; both
    arrays of (label, level, first, last) in word numbers from 0. Null and empty texts have no
    words and no places; whole texts are read; repeated rows repeat their result; null ids stay
    null; an empty table gives no rows; columns besides ``doc_id`` and ``text`` are not read.
    """
    signatures = rules() if signatures is None else signatures
    gates = sorted({g.replace(" ", "  ") for r in signatures for g in r.gates})
    table = F.array(
        *[
            F.struct(
                F.lit(r.label).alias("label"),
                F.lit(r.level).alias("level"),
                F.array(*[F.lit(g.replace(" ", "  ")) for g in r.gates]).alias("gates"),
                F.lit(spaced(r.pattern)).alias("pattern"),
            )
            for r in signatures
        ]
    )
    telling = "|".join(gates)
    norm = F.col("_norm")
    gated = texts(docs).withColumn("_norm", normalised(F.col("text"))).withColumn(
        "_gated", norm.rlike(f" (?:{telling}) ")
    )
    held = F.filter(F.array(*map(F.lit, gates)), lambda g: F.contains(norm, F.concat(F.lit(" "), g, F.lit(" "))))
    tried = F.transform(
        F.array(held),
        lambda own: F.filter(table, lambda r: F.arrays_overlap(own, r["gates"]) & F.rlike(norm, r["pattern"])),
    )[0]
    found = F.flatten(F.transform(tried, lambda r: _detections(norm, r)))
    scanned = gated.withColumn("_found", F.when(F.col("_gated"), found).otherwise(F.array().cast(_DETECTION)))
    spaces = F.length(norm) - F.length(F.replace(norm, F.lit(" "), F.lit("")))
    return scanned.select(
        "doc_id",
        F.when(norm == "  ", 0).otherwise(F.floor(spaces / 2)).cast("long").alias("n_words"),
        F.filter("_found", lambda d: d["level"] == 0).alias("base"),
        _surviving(F.col("_found")).alias("detections"),
    )


def _surviving(found: Column) -> Column:
    """One pass over the intervals by (first, longest first, highest level first): an interval is
    inside an earlier one exactly if the furthest end so far reaches its end. The furthest end is
    kept for each level."""
    ordered = F.array_sort(
        F.transform(
            found,
            lambda d: F.struct(
                d["first"].alias("first"), (-d["last"]).alias("minus"), (-d["level"]).alias("depth"), d["label"].alias("label")
            ),
        )
    )
    levels = sorted(WEIGHTS)
    start = F.struct(
        F.array(*[F.lit(-1) for _ in levels]).alias("furthest"), F.array().cast(_DETECTION).alias("kept")
    )

    def step(acc: Column, d: Column) -> Column:
        level, last = -d["depth"], -d["minus"]
        covered = F.array_max(F.slice(acc["furthest"], level + 1, len(levels))) >= last
        furthest = F.transform(
            acc["furthest"], lambda e, i: F.when(i == level, F.greatest(e, last)).otherwise(e)
        )
        own = F.array(
            F.struct(d["label"].alias("label"), level.alias("level"), d["first"].alias("first"), last.alias("last"))
        )
        return F.struct(
            furthest.alias("furthest"), F.when(covered, acc["kept"]).otherwise(F.concat(acc["kept"], own)).alias("kept")
        )

    return F.aggregate(ordered, start, step)["kept"]


def summarise(scanned: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` from
    :func:`scan`; score is the weight of the highest surviving level, 0 without detections."""

    def labels(found: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda d: d["label"]))), ",")

    starts = F.transform("base", lambda d: d["first"])
    weight = F.lit(0.0)
    for level, value in WEIGHTS.items():
        weight = F.when(F.array_max(F.transform("detections", lambda d: d["level"])) == level, value).otherwise(weight)
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        labels(F.col("base")).alias("base_labels"),
        labels(F.concat("base", "detections")).alias("labels"),
        weight.alias("score"),
    )


def oracle_sql() -> str:
    """DuckDB SQL for :func:`summarise` over the view ``documents``, from the same rules."""
    signatures = rules()
    values = ",\n".join(f"({i}, '{r.label}', {r.level}, '{spaced(r.pattern)}')" for i, r in enumerate(signatures))
    weights = " ".join(f"WHEN {level} THEN {value}" for level, value in WEIGHTS.items())
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH rule(rule, label, level, pattern) AS (VALUES {values}),
norm AS (
  SELECT row_number() OVER () AS row, doc_id,
         trim(regexp_replace(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'),
              '{SEPARATORS}', ' ', 'g')) AS words
  FROM documents),
wide AS (SELECT row, ' ' || replace(words, ' ', '  ') || ' ' AS norm FROM norm),
marked AS (
  SELECT row, rule, label, level,
         string_split(trim(regexp_replace(norm, pattern, ' ' || chr(1) || '\\1' || chr(2) || ' ', 'g')), '  ') AS parts
  FROM wide JOIN rule ON regexp_matches(norm, pattern)),
word AS (
  SELECT row, rule, label, level, generate_subscripts(parts, 1) - 1 AS place, unnest(parts) AS part FROM marked),
opened AS (
  SELECT *, row_number() OVER (PARTITION BY row, rule ORDER BY place) AS n FROM word WHERE starts_with(part, chr(1))),
closed AS (
  SELECT *, row_number() OVER (PARTITION BY row, rule ORDER BY place) AS n FROM word WHERE ends_with(part, chr(2))),
found AS (
  SELECT DISTINCT o.row, o.label, o.level, o.place AS first, c.place AS last
  FROM opened o JOIN closed c USING (row, rule, n)),
kept AS (
  SELECT * FROM found f WHERE NOT EXISTS (
    SELECT 1 FROM found e
    WHERE e.row = f.row AND e.level >= f.level AND e.first <= f.first AND e.last >= f.last
      AND (e.first < f.first OR e.last > f.last OR e.level > f.level OR e.label < f.label))),
base AS (
  SELECT row, count(*) AS n_base, min(first) AS first_word, max(first) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM found WHERE level = 0 GROUP BY row),
every AS (
  SELECT row, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT row, label FROM kept UNION ALL SELECT row, label FROM found WHERE level = 0) GROUP BY row),
best AS (SELECT row, max(level) AS level FROM kept GROUP BY row)
SELECT doc_id,
       CASE WHEN words = '' THEN 0 ELSE length(words) - length(replace(words, ' ', '')) + 1 END AS n_words,
       coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(CASE level {weights} ELSE 0 END AS DOUBLE) AS score
FROM norm LEFT JOIN base USING (row) LEFT JOIN every USING (row) LEFT JOIN best USING (row)
"""
