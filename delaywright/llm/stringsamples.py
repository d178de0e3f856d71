"""Labelled samples for the secret scan: random strings of several alphabets, and ordinary
identifiers, paths, addresses, dates and numbers, made by rule from a fixed word list.

The samples are drawn by a seeded generator; another seed gives samples of the same kinds that
no model has been trained on.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ALPHABETS = {
    "digits": _DIGITS,
    "hex": _DIGITS + "abcdef",
    "upper hex": _DIGITS + "ABCDEF",
    "lower": _LOWER,
    "upper": _UPPER,
    "base32": _UPPER + "234567",
    "lower base36": _LOWER + _DIGITS,
    "upper base36": _UPPER + _DIGITS,
    "letters": _LOWER + _UPPER,
    "base62": _LOWER + _UPPER + _DIGITS,
    "base64": _LOWER + _UPPER + _DIGITS + "+/",
    "url base64": _LOWER + _UPPER + _DIGITS + "-_",
}

#: Words of ordinary identifiers.
WORDS = (
    "access account action address attribute author backup batch binary body buffer "
    "button cache call channel character child client cluster column command config connection content "
    "control copy customer data date default delivery device document domain element "
    "email engine environment error example export factory feature field filter folder format "
    "frame function gateway generate global handler hash height history host http identifier index "
    "info input instance integer interface invoice iterator java job journey keyboard label language layer "
    "length library limit line local location log machine manager mapping maximum member memory "
    "message method mixin model module monitor name network notify number observer online option "
    "order output owner package parameter parser password pattern payment pending position prefix "
    "price primary process product profile project property protocol provider proxy public purchase queue "
    "quick radio range record reference registry report request resource response result return route rule "
    "schedule schema score script search section security select sequence server service session shadow shared signal "
    "singleton source special status storage stream string style support switch system table target task template test "
    "thread time timeout token transaction type unique update upload user utility validation value vector version "
    "view virtual visitor volume warning weather weekly widget window wizard worker wrapper write xml zero zone"
).split()
_ROOTS = ("", "/usr/local/lib/", "/home/user/", "/var/log/", "https//www/", "https//example/com/", "http//", "src/main/", "C/Program/Files/", "opt/")
_ENDINGS = ("", "", "", "/index", "/html", "2", "3", "_v2", "-1-0", "/2024", "_01", "64")


def random_strings(n: int, seed: int = 1, least: int = 20, most: int = 40) -> Iterator[tuple[str, str]]:
    """``(kind, string)``: characters drawn evenly from one of the alphabets."""
    draw = random.Random(seed)
    kinds = list(ALPHABETS)
    for i in range(n):
        kind = kinds[i % len(kinds)]
        yield kind, "".join(draw.choices(ALPHABETS[kind], k=draw.randint(least, most)))


def ordinary_strings(n: int, seed: int = 1) -> Iterator[tuple[str, str]]:
    """``(kind, string)`` of at least 20 characters each."""
    draw = random.Random(seed)
    kinds = ("joined", "path", "camel", "acronym", "upper", "numbers")
    made = 0
    while made < n:
        kind = kinds[made % len(kinds)]
        text = _ordinary(draw, kind)
        if len(text) >= 20:
            made += 1
            yield kind, text


def _ordinary(draw: random.Random, kind: str) -> str:
    words = draw.choices(WORDS, k=draw.randint(3, 9))
    if kind == "joined":
        return draw.choice("_-/=+").join(words) + draw.choice(_ENDINGS)
    if kind == "path":
        return draw.choice(_ROOTS) + "/".join(draw.choice(("", "", "-", "_")).join(words[i : i + 2]) for i in range(0, len(words), 2)) + draw.choice(_ENDINGS)
    if kind == "camel":
        first = draw.choice((words[0], words[0].title()))
        return first + "".join(w.title() for w in words[1:]) + draw.choice(("", "", "2", "Id", "_t"))
    if kind == "acronym":
        return "".join(w[: draw.randint(3, 4)].upper() if draw.random() < 0.25 else w.title() for w in words)
    if kind == "upper":
        return draw.choice(("_", "_", "-")).join(words).upper() + draw.choice(("", "", "_2", "_ID"))
    return _numbers(draw)


def _numbers(draw: random.Random) -> str:
    def date() -> str:
        return draw.choice(("{:04d}-{:02d}-{:02d}", "{:04d}/{:02d}/{:02d}", "{:04d}_{:02d}_{:02d}")).format(
            draw.randint(1980, 2040), draw.randint(1, 12), draw.randint(1, 28)
        )

    def time() -> str:
        return draw.choice("T-_") + f"{draw.randint(0, 23):02d}-{draw.randint(0, 59):02d}-{draw.randint(0, 59):02d}"

    kinds = (
        lambda: date() + time() + draw.choice("-_/") + date(),
        lambda: date() + draw.choice(("--", "_to_", "-", "/")) + date() + draw.choice(("", time())),
        lambda: "-".join(str(draw.randint(0, 9999)) for _ in range(draw.randint(5, 9))),
        lambda: "+" + "-".join(f"{draw.randint(0, 999):03d}" for _ in range(draw.randint(5, 7))),
        lambda: draw.choice("=-_") * draw.randint(20, 60),
    )
    return draw.choice(kinds)()
