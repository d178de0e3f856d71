"""Secret scan: the rules against a plain reading of them, the models, redaction."""

import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest

from delaywright.llm import secrets, stringsamples

KINDS = ("assign", "access", "hex")


def plain_base(text):
    """The rules by the letter: all leftmost non-overlapping matches of a kind, then the lengths."""
    found = []
    assign = re.compile(
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    for m in assign.finditer(text):
        if len(m.group(2)) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if m.end() - m.start() >= 24]
    return sorted(found)


ODD = [
    None, "", "plain words only", "PASSWORD: hunter2", "password = short", 'token="abcdef"', "secret=token=abcdef",
    "secret:token = abcdefgh", "toKen=abcdefg", "api_key:'A/b+c.d=e-f'", "AKIA" + "A1" * 8, "AKIAAKIA" + "B" * 12,
    "é😀 apikey = " + "0123456789abcdef" * 2, "x" * 50_000 + " token = " + "ab12" * 10, "AKIA1", "f" * 23, "f" * 24 + "g" + "0" * 30,
]


def test_rules_equal_a_plain_reading():
    draw = random.Random(11)
    parts = ["token", "Secret", "api_key", "apikey", "PASSWD", "=", ":", " ", '"', "'", "abc", "AKIA", "A1B2C3D4", "dead0beef1", "ab", ".", "é", "\n"]
    for text in [t or "" for t in ODD] + ["".join(draw.choice(parts) for _ in range(draw.randint(0, 25))) for _ in range(4000)]:
        assert secrets.rule_spans(text) == plain_base(text), text


@pytest.fixture(scope="module")
def models(spark):
    draw = random.Random(2)
    alphabet = secrets.ALPHABET[:62]
    words = "the of configuration identifier get_user_name maximum-length-value internationalization responsibilities".split()
    samples = [("".join(draw.choice(alphabet) for _ in range(32)), 1) for _ in range(200)]
    samples += [("_".join(draw.choice(words) for _ in range(4)), 0) for _ in range(400)]
    samples += [(None, 1), ("ignored", None), ("ignored", 5), ("", 0)]
    return secrets.train(spark.createDataFrame(samples, "sample string, label int"))


def test_models_part_random_strings_from_identifiers(models):
    draw = random.Random(4)
    alphabet = secrets.ALPHABET[:62]
    assert all(models.score("".join(draw.choice(alphabet) for _ in range(24))) > 0 for _ in range(100))
    assert models.score("get_user_identifier_length_value") < 0
    found = models.spans("call get_user_identifier_length_value with Zk3Qv9XbT7LmW2RpY8NcD4Hs", [], 20)
    assert [k for _, k, _ in found] == [3]


def test_scan_digests_and_redaction(spark, make_docs, models):
    pairs = [*enumerate(ODD), (2, ODD[2]), (None, "token = abcdef")]
    docs = make_docs(pairs)
    scanned = {(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in secrets.span_digests(secrets.scan(docs, models)).collect()}
    want = set()
    for key, text in pairs:
        base = plain_base(text or "")
        digest = hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in base).encode()).hexdigest()
        want.add((key, *[sum(k == n for _, k, _ in base) for n in range(3)], digest))
    assert scanned == want
    rows = secrets.scan(docs, models).collect()
    assert len(rows) == len(pairs)
    text = dict(pairs)
    for r in rows:
        assert all(text[r.doc_id][s.start : s.end] == s.value for s in r.spans)
    masked = secrets.redact(docs, models).orderBy("doc_id").collect()
    assert masked[0].asDict().keys() == docs.first().asDict().keys()
    by_id = {r.doc_id: r for r in masked}
    assert by_id[0].text is None and by_id[2].text == ODD[2] and by_id[3].text == "[secret]"
    assert by_id[13].text == "x" * 50_000 + " [secret]" and by_id[13].n_chars == 50_009


def test_training_on_documents_and_empty_tables(make_docs):
    texts = [(i, f"ordinary words of a document token = {hashlib.md5(str(i).encode()).hexdigest()}") for i in range(30)]
    models = secrets.train_on_documents(make_docs(texts))
    assert models.score(hashlib.md5(b"x").hexdigest()) > 0 > models.score("ordinarywordsofadocument")
    nothing = secrets.train_on_documents(make_docs([]))
    assert secrets.scan(make_docs([]), nothing).count() == 0
    assert secrets.span_digests(secrets.scan(make_docs([(1, "")]), nothing)).first().spans == ""


def test_runs_beside_a_rule_are_scored(make_docs, models):
    draw = random.Random(8)
    key = "".join(draw.choice(secrets.ALPHABET[:62]) for _ in range(40))
    access, inside = "AKIA" + "Q7" * 8, "0a1b2c3d4e5f" * 2
    texts = [f"id {access}/{key} end", f"{key}Z{inside}Z{key}", f"{access}/{key[:10]}", f"token={key}.x {key}"]
    got = {r.doc_id: [(s.kind, s.value) for s in r.spans] for r in secrets.scan(make_docs([*enumerate(texts)]), models).collect()}
    assert got[0] == [("access", access), ("random", f"/{key}")]
    assert [k for k, _ in got[1]] == ["random", "hex", "random"] and "".join(v for _, v in got[1]) == texts[1]
    assert got[2] == [("access", access)]
    assert got[3] == [("assign", f"token={key}.x"), ("random", key)]
    masked = {r.doc_id: r.text for r in secrets.redact(make_docs([*enumerate(texts)]), models).collect()}
    assert all(key not in t for t in masked.values())


#: Ordinary strings that are not made by the generator.
ORDINARY = [
    "getUserIdentifierLengthValueFromContext", "/usr/local/lib/python3/site-packages/numpy", "XMLHttpRequestEventTargetMixinFactory",
    "MAX_CONNECTION_POOL_TIMEOUT_SECONDS", "https//example/com/path/to/some/page/index", "2024-01-01T00-00-00-2024-02-02",
    "org/apache/commons/collections/iterators", "com-example-service-registration-controller", "test_that_nothing_else_is_reported_here",
    "AbstractSingletonProxyFactoryBean", "unsubscribe-preferences/newsletter", "Donaudampfschifffahrtsgesellschaft",
    "=========================", "PURCHASE_ORDER_CONFIRMATION_NUMBER", "/var/lib/postgresql/backups/weekly/2023",
]


def test_registered_models_part_random_strings_from_identifiers(spark, sf_dir):
    """The models as the query trains them, on strings drawn with other seeds."""
    models = secrets.train_on_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    found = {}
    for kind, text in stringsamples.random_strings(3000, seed=77):
        found.setdefault(kind, []).append(models.score(text) > models.margin)
    assert sum(map(sum, found.values())) > 0.95 * 3000
    assert all(sum(hits) > 0.85 * len(hits) for hits in found.values()), {k: sum(v) / len(v) for k, v in found.items()}
    wrong = [text for _, text in stringsamples.ordinary_strings(3000, seed=78) if models.score(text) > models.margin]
    assert len(wrong) < 0.01 * 3000
    assert [text for text in ORDINARY if models.spans(text, [], 20)] == []
    inside = "/opt/service/config/" + "Zk3Qv9XbT7LmW2RpY8NcD4Hs" + "/index"
    assert [inside[a:b] for a, _, b in models.spans(inside, [], 20)] in ([inside], ["Zk3Qv9XbT7LmW2RpY8NcD4Hs"])


def test_score_is_the_ratio_of_two_mixtures():
    """By hand, with two models a class over two letters."""
    n = len(secrets.ALPHABET) + 1
    draw = np.random.default_rng(3)
    random_, ordinary = (np.log(draw.dirichlet(np.ones(n), (2, n))).reshape(2, -1) for _ in range(2))
    models = secrets.MarkovModels(random_, ordinary)
    text = "aB9_/"
    codes = [0, *(secrets.ALPHABET.index(c) + 1 for c in text)]

    def likelihood(tables):
        return sum(math.exp(sum(t[a * n + b] for a, b in itertools.pairwise(codes))) for t in tables) / len(tables)

    assert models.score(text) == pytest.approx(math.log(likelihood(random_) / likelihood(ordinary)))
