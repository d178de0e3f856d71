"""License scan against a plain search, and its plan."""

import itertools
import random
import re
from collections import defaultdict

from delaywright.llm.license_rules import BASE, WEIGHTS, rules
from delaywright.llm.licenses import scan, spaced, summarise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans(UPPER, LOWER)))


def plain_base(text):
    words, found = words_of(text), []
    for phrase, label in BASE:
        own = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(own)] == own]
    return len(words), sorted(found)


def plain_detections(text):
    """Every rule over the words, then the covering rule by all pairs."""
    words = words_of(text)
    wide = " " + "  ".join(words) + " "
    found = set()
    for rule in rules():
        if rule.gate not in words:
            continue
        for m in re.finditer(spaced(rule.pattern), wide):
            first = wide[: m.start() + 1].count(" ") // 2
            found.add((first, first + len(m[1].split()) - 1, rule.level, rule.label))
    kept = set()
    for d in found:
        covered = any(
            e[0] <= d[0] and e[1] >= d[1] and e[2] >= d[2] and (e[:3] != d[:3] or e[3] < d[3]) for e in found if e != d
        )
        if not covered:
            kept.add(d)
    return found, kept


ODD = [
    "Do what the fuc\u212a you want to", None, "", " \n", "no words of interest", "Released under the MIT License.", "MIT\x00License", "MIT Licensé", "mit-license/MIT LICENSE",
    "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.", "cc by cc by", "CC BY-SA 3.0 and cc by",
    "This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-or-later",
    "the mit license " * 400, "apache license 2 0 apache license", "Ünlicense gnu general public licensee", "日本 MIT License 日本",
    "Permission ... to permit persons to whom the Software is furnished to do so", "gnu general public license v2 mit license " * 3,
]


def test_hundreds_of_rules_compile_and_hold_their_gate():
    found = rules()
    assert len(found) > 300 and [r.level for r in found] == sorted(r.level for r in found)
    for rule in found:
        re.compile(spaced(rule.pattern))
        assert "(?<" not in rule.pattern and "(?=" not in rule.pattern


def test_equals_a_plain_search(make_docs):
    draw = random.Random(3)
    vocabulary = "gnu general public license mit apache cc by version 2 0 the licensed under sa nc 4 spdx identifier bsd clause 3 word".split()
    texts = ODD + [" ".join(draw.choice(vocabulary) for _ in range(draw.randint(1, 60))) for _ in range(120)]
    pairs = [*enumerate(texts), (4, texts[4]), (None, texts[4])]
    got = sorted((tuple(r) for r in summarise(scan(make_docs(pairs))).collect()), key=repr)
    want = []
    for key, text in pairs:
        n, base = plain_base(text)
        _, kept = plain_detections(text)
        starts = [i for i, _ in base]
        base_labels = ",".join(sorted({b for _, b in base}))
        labels = ",".join(sorted({b for _, b in base} | {d[3] for d in kept}))
        score = max((WEIGHTS[d[2]] for d in kept), default=0.0)
        want.append((key, n, len(base), min(starts, default=None), max(starts, default=None), base_labels, labels, score))
    assert got == sorted(want, key=repr)


def test_no_python_and_no_shuffle(make_docs):
    plan = summarise(scan(make_docs([(1, "MIT License")])))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange|Join", plan)
    assert summarise(scan(make_docs([]))).count() == 0


def test_specific_detections_suppress_general_ones(make_docs):
    row = scan(make_docs([(1, "Licensed under the Apache License, Version 2.0.")])).first()
    assert [(d.label, d.level) for d in row.detections] == [("apache-2.0", 2)]
    assert [(d.label, d.first) for d in row.base] == [("apache", 3)]


def ungated(text):
    """Every rule over the words, whatever its gates."""
    words = words_of(text)
    wide = " " + "  ".join(words) + " "
    found = set()
    for rule in rules():
        for m in re.finditer(spaced(rule.pattern), wide):
            first = wide[: m.start() + 1].count(" ") // 2
            found.add((first, first + len(m[1].split()) - 1, rule.level, rule.label))
    return {
        d for d in found
        if not any(e[0] <= d[0] and e[1] >= d[1] and e[2] >= d[2] and (e[:3] != d[:3] or e[3] < d[3]) for e in found if e != d)
    }


def equals_ungated(make_docs, texts):
    got = {r.doc_id: {(d.first, d.last, d.level, d.label) for d in r.detections} for r in scan(make_docs([*enumerate(texts)])).collect()}
    assert got == {i: ungated(t) for i, t in enumerate(texts)}
    return got


def test_notices_by_tag_need_no_other_word(make_docs):
    texts = [f"It is {grant} under {tag}." for grant, tag in zip(
        ["Released", "distributed", "licensed", "available", "published"] * 3,
        ["GPL 3.0", "MPL 2.0", "the AGPL-3.0-only", "LGPL 2.1", "EPL-2.0", "the terms of the ECL 2.0", "an OSL 3.0", "0BSD",
         "MIT", "WTFPL", "the CDDL 1.0", "ODC-BY 1.0", "OFL 1.1", "MS-PL", "CC BY 4.0"])]
    got = equals_ungated(make_docs, [*texts, "It lies under the table.", "found under GPL 3.0"])
    assert all(got[i] for i in range(len(texts))) and not got[len(texts)]


def alternatives(pattern):
    """Every text a rule's pattern matches, by its branches and optional parts; of a set its first."""
    parser = re._parser

    def of(parts):
        return ["".join(p) for p in itertools.product(*map(one, parts))]

    def one(part):
        kind, value = str(part[0]), part[1]
        if kind == "LITERAL":
            return [chr(value)]
        if kind == "IN":
            return [chr(value[0][1][0] if str(value[0][0]) == "RANGE" else value[0][1])]
        if kind == "SUBPATTERN":
            return of(value[3])
        if kind == "BRANCH":
            return [t for branch in value[1] for t in of(branch)]
        assert kind == "MAX_REPEAT" and value[1] < 5, part
        return [t * n for t in of(value[2]) for n in sorted({value[0], value[1]})]

    return set(of(parser.parse(pattern)))


def test_every_alternative_holds_a_gate():
    gates = defaultdict(set)
    for rule in rules():
        gates[rule.label, rule.level, rule.pattern] |= set(rule.gates)
    for (label, level, pattern), own in gates.items():
        for text in alternatives(pattern):
            assert re.fullmatch(pattern, text)
            assert any(f" {g} " in f" {text} " for g in own), (label, level, text)


def test_rules_are_tried_without_foreign_words(make_docs):
    texts = ["either version 2 of the License, or (at your option) any later version", "0BSD license", "the Open Software Licence 3.0",
             "0BSD", "Open Software License", "zero clause BSD licence"]
    assert all(equals_ungated(make_docs, texts).values())


def test_equals_an_ungated_search(make_docs):
    draw = random.Random(4)
    vocabulary = "released distributed under the terms of gpl agpl lgpl mpl epl 0bsd mit open software licence 3 2 0 1 or later only option".split()
    equals_ungated(make_docs, [*ODD, *(" ".join(draw.choice(vocabulary) for _ in range(draw.randint(1, 40))) for _ in range(100))])
