"""Signature rules of the license scan.

A pattern is written over normalised text: lower-case words with one blank between them, so that
"Version 2.0" reads "version 2 0". It matches whole words only. Each licence has a hand-written
title pattern; notices ("licensed under the ...") and machine-readable tags are made from it.
"""

from __future__ import annotations

from dataclasses import dataclass

#: Phrases whose places are always reported, and their labels (fixed values).
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: A detection is dropped when one of the same or a higher level covers it.
TITLE, NOTICE, TAG = 1, 2, 3
WEIGHTS = {0: 0.5, TITLE: 0.7, NOTICE: 0.9, TAG: 1.0}

_V = "(?:version |v )?"
_LIC = "(?:license|licence)"

#: What stands before "under" in a notice; with it, the gate of every notice.
GRANTS = ("licensed", "released", "distributed", "available", "published")

#: (label, gates, title pattern, tag words). The title is listed once for each part between "|"; a text
#: that matches holds one of all the words.
LICENSES = (
    ("agpl-3.0", "affero", f"(?:gnu )?affero general public {_LIC} {_V}3(?: 0)?", "agpl 3 0(?: only| or later)?"),
    ("agpl-1.0", "affero", f"affero general public {_LIC} {_V}1(?: 0)?", "agpl 1 0(?: only| or later)?"),
    ("gpl-1.0", "gnu", f"gnu general public {_LIC} {_V}1(?: 0)?", "gpl 1 0(?: only| or later)?"),
    ("gpl-2.0", "gnu", f"gnu general public {_LIC} {_V}2(?: 0)?", "gpl 2 0(?: only| or later)?"),
    ("gpl-3.0", "gnu", f"gnu general public {_LIC} {_V}3(?: 0)?", "gpl 3 0(?: only| or later)?"),
    ("lgpl-2.0", "gnu", f"gnu library general public {_LIC}(?: {_V}2(?: 0)?)?", "lgpl 2 0(?: only| or later)?"),
    ("lgpl-2.1", "gnu", f"gnu lesser general public {_LIC} {_V}2 1", "lgpl 2 1(?: only| or later)?"),
    ("lgpl-3.0", "gnu", f"gnu lesser general public {_LIC} {_V}3(?: 0)?", "lgpl 3 0(?: only| or later)?"),
    ("gfdl-1.1", "gnu", f"gnu free documentation {_LIC} {_V}1 1", "gfdl 1 1(?: only| or later)?"),
    ("gfdl-1.2", "gnu", f"gnu free documentation {_LIC} {_V}1 2", "gfdl 1 2(?: only| or later)?"),
    ("gfdl-1.3", "gnu", f"gnu free documentation {_LIC} {_V}1 3", "gfdl 1 3(?: only| or later)?"),
    ("apache-1.0", "apache", f"apache (?:software )?{_LIC} {_V}1 0", "apache 1 0"),
    ("apache-1.1", "apache", f"apache (?:software )?{_LIC} {_V}1 1", "apache 1 1"),
    ("apache-2.0", "apache", f"apache (?:software )?{_LIC} {_V}2(?: 0)?", "apache 2 0"),
    ("mit-0", "mit", f"mit no attribution(?: {_LIC})?", "mit 0"),
    ("mit", "license", "(?:the )?mit license", "mit"),
    ("x11", "x11", f"(?:mit )?x11 {_LIC}", "x11"),
    ("isc", "isc", f"isc {_LIC}", "isc"),
    ("0bsd", "bsd,0bsd", f"(?:zero clause bsd|bsd zero clause|0 clause bsd|0bsd)(?: {_LIC})?", "0bsd"),
    ("bsd-1-clause", "bsd", f"(?:bsd 1 clause|1 clause bsd)(?: {_LIC})?", "bsd 1 clause"),
    ("bsd-2-clause", "bsd,clause", f"(?:(?:bsd 2|2) clause (?:bsd )?|(?:simplified|freebsd) bsd ){_LIC}", "bsd 2 clause"),
    ("bsd-3-clause", "bsd", f"(?:(?:new|modified|revised|3 clause) bsd|bsd 3 clause)(?: {_LIC})?", "bsd 3 clause"),
    ("bsd-4-clause", "bsd", f"(?:(?:original|4 clause) bsd|bsd 4 clause)(?: {_LIC})?", "bsd 4 clause"),
    ("mpl-1.0", "mozilla", f"mozilla public {_LIC} {_V}1 0", "mpl 1 0"),
    ("mpl-1.1", "mozilla", f"mozilla public {_LIC} {_V}1 1", "mpl 1 1"),
    ("mpl-2.0", "mozilla", f"mozilla public {_LIC} {_V}2(?: 0)?", "mpl 2 0"),
    ("epl-1.0", "eclipse", f"eclipse public {_LIC} {_V}1(?: 0)?", "epl 1 0"),
    ("epl-2.0", "eclipse", f"eclipse public {_LIC} {_V}2(?: 0)?", "epl 2 0"),
    ("edl-1.0", "eclipse", f"eclipse distribution {_LIC}(?: {_V}1(?: 0)?)?", "edl 1 0"),
    ("cddl-1.0", "cddl|distribution", f"common development and distribution {_LIC} {_V}1(?: 0)?", "cddl 1 0"),
    ("cddl-1.1", "cddl|distribution", f"common development and distribution {_LIC} {_V}1 1", "cddl 1 1"),
    ("cpl-1.0", "common", f"common public {_LIC}(?: {_V}1 0)?", "cpl 1 0"),
    ("ipl-1.0", "ibm", f"ibm public {_LIC}(?: {_V}1 0)?", "ipl 1 0"),
    ("eupl-1.1", "eupl|european", f"(?:european union public {_LIC}|eupl) {_V}1 1", "eupl 1 1"),
    ("eupl-1.2", "eupl|european", f"(?:european union public {_LIC}|eupl) {_V}1 2", "eupl 1 2"),
    ("ecl-2.0", "educational", f"educational community {_LIC}(?: {_V}2 0)?", "ecl 2 0"),
    ("afl-3.0", "academic", f"academic free {_LIC}(?: {_V}3 0)?", "afl 3 0"),
    ("osl-3.0", "software", f"open software {_LIC}(?: {_V}3 0)?", "osl 3 0"),
    ("artistic-1.0", "artistic", f"artistic {_LIC} {_V}1(?: 0)?", "artistic 1 0"),
    ("artistic-2.0", "artistic", f"artistic {_LIC} {_V}2(?: 0)?", "artistic 2 0"),
    ("bsl-1.0", "boost", f"boost software {_LIC}(?: {_V}1 0)?", "bsl 1 0"),
    ("busl-1.1", "business", f"business source {_LIC}(?: {_V}1 1)?", "busl 1 1"),
    ("sspl-1.0", "server", f"server side public {_LIC}(?: {_V}1(?: 0)?)?", "sspl 1 0"),
    ("elastic-2.0", "elastic", f"elastic {_LIC} {_V}2(?: 0)?", "elastic 2 0"),
    ("unlicense", "unlicense", "(?:the )?unlicense", "unlicense"),
    ("wtfpl", "wtfpl", f"wtfpl(?: {_V}2)?", "wtfpl"),
    ("zlib", "zlib", f"zlib(?: libpng)? {_LIC}", "zlib"),
    ("libpng", "libpng", f"libpng {_LIC}(?: {_V}2)?", "libpng(?: 2 0)?"),
    ("python-2.0", "python", f"python (?:software foundation )?{_LIC}(?: {_V}2(?: 0)?)?", "python 2 0"),
    ("psf-2.0", "psf", f"psf {_LIC}(?: agreement)?(?: {_V}2)?", "psf 2 0"),
    ("php-3.01", "php", f"php {_LIC} {_V}3 01", "php 3 01"),
    ("ruby", "ruby", f"ruby {_LIC}", "ruby"),
    ("postgresql", "postgresql", f"postgresql {_LIC}", "postgresql"),
    ("openssl", "openssl", f"openssl {_LIC}", "openssl"),
    ("curl", "curl", f"curl {_LIC}", "curl"),
    ("ncsa", "ncsa", f"(?:university of illinois )?ncsa(?: open source)? {_LIC}", "ncsa"),
    ("ofl-1.0", "sil", f"sil open font {_LIC} {_V}1 0", "ofl 1 0"),
    ("ofl-1.1", "sil", f"sil open font {_LIC} {_V}1 1", "ofl 1 1"),
    ("odbl-1.0", "database", f"open (?:data commons open )?database {_LIC}(?: {_V}1 0)?", "odbl 1 0"),
    ("odc-by-1.0", "commons", f"open data commons attribution {_LIC}(?: {_V}1 0)?", "odc by 1 0"),
    ("pddl-1.0", "pddl", f"pddl(?: {_V}1 0)?", "pddl 1 0"),
    ("cc0-1.0", "cc0", f"(?:creative commons )?cc0(?: {_V}1 0)?(?: universal)?", "cc0 1 0"),
    ("ms-pl", "microsoft", f"microsoft public {_LIC}", "ms pl"),
    ("ms-rl", "microsoft", f"microsoft reciprocal {_LIC}", "ms rl"),
    ("upl-1.0", "universal", f"universal permissive {_LIC}(?: {_V}1 0)?", "upl 1 0"),
    ("vim", "vim", f"vim {_LIC}", "vim"),
    ("mulan-2.0", "mulan", f"mulan (?:permissive software|psl) {_LIC}?(?: ?{_V}2)?", "mulanpsl 2 0"),
    ("public-domain", "domain", "(?:released|placed|dedicated|is) (?:in|into|to) the public domain", "public domain"),
    ("proprietary", "reserved", "all rights reserved", "proprietary"),
)

#: Creative Commons: every combination of its elements, written out by element.
CC_ELEMENTS = (
    ("by", "attribution"),
    ("by-sa", "attribution share ?alike"),
    ("by-nd", "attribution no ?deriv(?:ative)?s"),
    ("by-nc", "attribution non ?commercial"),
    ("by-nc-sa", "attribution non ?commercial share ?alike"),
    ("by-nc-nd", "attribution non ?commercial no ?deriv(?:ative)?s"),
)
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

#: Sentences that name a licence without its title: (label, gate word, pattern).
SENTENCES = (
    ("mit", "furnished", "to permit persons to whom the software is furnished to do so"),
    ("mit", "merge", "to use copy modify merge publish distribute sublicense and or sell copies"),
    ("isc", "hereby", "to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd-2-clause", "redistributions", "redistributions of source code must retain the above copyright notice"),
    ("bsd-3-clause", "endorse", "may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software"),
    ("apache-2.0", "compliance", "you may not use this file except in compliance with the license"),
    ("gpl-2.0", "option", "either version 2 of the license or at your option any later version"),
    ("gpl-3.0", "option", "either version 3 of the license or at your option any later version"),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented"),
    ("wtfpl", "fuck", "you just do what the fuck you want to"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("cc0-1.0", "waived", "waived all copyright and related or neighboring rights"),
    ("boost-1.0", "boost", "boost software license version 1 0 august 17th 2003"),
    ("mpl-2.0", "mozilla", "subject to the terms of the mozilla public license v 2 0"),
    ("proprietary", "confidential", "confidential and proprietary"),
    ("proprietary", "permission", "without (?:prior|express) written permission"),
    ("copyright-notice", "copyright", "copyright (?:c )?[12][0-9]{3}"),
)


@dataclass(frozen=True)
class Rule:
    """``gates`` are words or phrases; a text must hold one of them before the pattern is tried, and
    every text that matches does."""

    label: str
    level: int
    gates: tuple[str, ...]
    pattern: str

    @property
    def gate(self) -> str:
        """The last word of the first gate."""
        return self.gates[0].split()[-1]


def rules() -> list[Rule]:
    """All rules in order: the base phrases, then by level, then as listed above."""
    found = [Rule(label, 0, ("cc" if label == "cc-by" else "license",), phrase) for phrase, label in BASE]
    notice = f"(?:{'|'.join(GRANTS)}) under (?:the )?(?:terms of )?(?:the )?(?:an? )?"
    under = tuple(f"{word} under" for word in GRANTS)
    for label, gates, title, tag in LICENSES:
        for gate in gates.split("|"):
            found.append(Rule(label, TITLE, tuple(gate.split(",")), title))
        found.append(Rule(label, NOTICE, under, notice + f"(?:{title}|{tag})"))
        found.append(Rule(label, TAG, ("spdx",), f"spdx {_LIC} identifier {tag}"))
    for parts, words in CC_ELEMENTS:
        short = parts.replace("-", " ")
        for version in CC_VERSIONS:
            number = version.replace(".", " ")
            label = f"cc-{parts}-{version}"
            found.append(Rule(label, TITLE, ("cc",), f"cc {short} {number}"))
            found.append(Rule(label, TITLE, ("creative",), f"creative commons {words} {number}(?: international| unported| generic)?"))
            found.append(Rule(label, NOTICE, under, notice + f"(?:cc {short}|creative commons {words}) {number}"))
            found.append(Rule(label, TAG, ("spdx",), f"spdx {_LIC} identifier cc {short} {number}"))
    found += [Rule(label, NOTICE, (gate,), pattern) for label, gate, pattern in SENTENCES]
    return sorted(found, key=lambda r: r.level)
