"""Known formats against a character-wise search, guess costs against all cuts, times on long runs."""

import hashlib
import itertools
import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tidepanel.llm import secret_scan as secrets
from tidepanel.llm.common import table

RANKS = secrets.word_ranks(["the", "summer", "su", "horse", "house", "ab", "hello"])


def brute_cost(text):
    """Least cost over all cuts, each span priced by itself."""

    def word(s):
        lowered = s.lower()
        plain = lowered.translate(secrets._UNSIGNED)
        signs = sum(a != b for a, b in zip(lowered, plain))
        ok = len(s) >= 2 and plain.isalpha() and plain in RANKS and signs < len(s)
        return secrets._word_cost(RANKS[plain], s, signs) if ok else math.inf

    def date(s):
        return min((c for a, b, c in secrets._dates(s) if (a, b) == (0, len(s))), default=math.inf)

    def walk(s):
        ways = [secrets._direction(a, b) for a, b in itertools.pairwise(s)]
        if len(s) < 3 or None in ways:
            return math.inf
        turns = sum(a != b for a, b in itertools.pairwise([None, *ways]))
        return secrets._START + turns * secrets._TURN + (len(ways) - turns) * secrets._AHEAD

    def repeat(s):
        units = [p for p in range(1, 9) if len(s) % p == 0 and len(s) // p >= (3 if p == 1 else 2) and s == s[:p] * (len(s) // p)]
        return min((brute_cost(s[:p]) + secrets._COPIES for p in units), default=math.inf)

    best = [0.0]
    for i in range(1, len(text) + 1):
        spans = [(j, text[j:i]) for j in range(i)]
        best.append(min([best[i - 1] + secrets._char_cost(text[i - 1])] + [best[j] + min(word(s), date(s), walk(s), repeat(s)) for j, s in spans]))
    return best[-1]


@pytest.mark.parametrize("seed", range(4))
def test_cost_equals_all_cuts(seed):
    pick = random.Random(seed)
    parts = ["the", "Summer", "h0rse", "HOUSE", "hellooo", "2024", "12/03/1999", "19990312", "qwe", "asdfg", "abc", "321", "xyxyxy", "aaaa", "!", "$", "é", "zQ7", "hotel", "5u"]
    for _ in range(60):
        text = "".join(pick.choices(parts, k=pick.randrange(1, 5)))
        assert secrets.guess_cost(text, RANKS) == pytest.approx(brute_cost(text)), text


def test_cheap_and_dear_passwords():
    for cheap in ("password", "Summer2024", "qwertyuiop", "aaaaaaaaaaaaaaaa", "abcabcabcabc", "12/03/1999", "changeme", "x" * 5000):
        assert secrets.guess_cost(cheap, RANKS) < secrets.LEAST_COST
    for dear in ("kJ8#dL2$pQ", "f3ef4d6b2755a36d7d9c25bd72c4d5f6", "Vq7-tRz9-mK2x"):
        assert secrets.guess_cost(dear, RANKS) > secrets.LEAST_COST


def brute_base(text):
    """Matches found one by one at each place, in characters."""
    name = "(?:" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key")) + ")"
    patterns = {
        "assign": (re.compile(name + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[1]) >= 6),
        "access": (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
        "hex": (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
    }
    out = []
    for order, (kind, (pattern, good)) in enumerate(patterns.items()):
        at = 0
        while at < len(text):
            m = pattern.match(text, at)
            if m and good(m):
                out.append((m.start(), order, m.end(), kind))
            at = m.end() if m else at + 1
    return [(k, a, b) for a, _, b, k in sorted(out)]


TEXTS = [
    "token:token = abcdefgh",
    'é PassWord" = "abc-DEF+1" and ToKen=\'x\' apikey : 123456 api_key=12345 aPi_KEY==12345',
    "AKIA" + "A" * 15 + " AKIA" + "B7" * 8 + "c AKIAAKIA" + "Z" * 12,
    "ab" * 11 + "c9 " + "0123456789abcdef" * 2 + "G" + "F" * 30 + "a" * 24,
    "ſecret=abcdefgh toKen=abcdefgh secret=" + "0a" * 20,
    "ü" * 50 + "token=" + "deadbeef" * 4,
    "passwd\t=abcdefgh secret  :  'zzzzzz' token=\n abcdefgh token=[abcdefgh]",
]


def base_of(text):
    return [(k, a, b) for k, a, b, _ in secrets.find(text, RANKS) if k != "guess"]


def test_known_formats_equal_brute_force():
    for text in TEXTS:
        assert base_of(text) == brute_base(text), text
    pick = random.Random(3)
    pieces = ["token", "SECRET", "api", "_", "key", "=", ":", " ", '"', "'", "abc", "Z9", "AKIA", "0123456789abcdef", "é", "\n", "passwd", "ABCDEFGH12345678"]
    for _ in range(1500):
        text = "".join(pick.choices(pieces, k=12))
        assert base_of(text) == brute_base(text), text


def test_values_that_no_format_knows():
    def guessed(text):
        return [text[a:b] for k, a, b, _ in secrets.find(text, RANKS) if k == "guess"]

    assert guessed("ünser pwd: kJ8#dL2$pQ9.") == ["kJ8#dL2$pQ9"]
    assert guessed("mot de passe est Zx9!kw2#Qp4v, bon") == ["Zx9!kw2#Qp4v"]
    assert guessed('password = "abcdef!@#xyz12"') == ["abcdef!@#xyz12"]
    assert guessed("postgres://bob:kJ8xxdL2pQ9z@host/db") == ["kJ8xxdL2pQ9z"]
    assert guessed("the password is protected by law, the token is unique.") == []
    assert guessed("pwd: changeme pass=Summer2024 secret is hello") == []
    assert guessed("token=" + "f3" * 20) == []  # lies in a known format
    assert [c for *_, c in secrets.find("token=changeme", RANKS)] == [secrets.guess_cost("changeme", RANKS)]


@pytest.mark.parametrize(
    "text",
    ["0123456789abcdef" * 2**16, "token" * 200_000, "password" + " " * 10**6, 'token="' * 140_000, "AKIA" * 250_000, "://a:" * 200_000, "password is " * 80_000, "pass=abcdefgh " * 70_000, "secret='" + "kJ8#dL2$pQ" * 20_000 + "'"],
    ids=lambda t: t[:12],
)
def test_long_runs_in_linear_time(text):
    began = time.process_time()
    secrets.find(text, RANKS)
    assert time.process_time() - began < 12


def test_registered_query(spark):
    d = "/root/testdata/sf0.01"
    held = {r.doc_id: r.text or "" for r in table(spark, d, "documents").collect()}
    rows = secrets.op12_secret_scan(spark, d).collect()
    assert len(rows) == len(held) and any(r.n_assign for r in rows)
    for r in rows:
        base = brute_base(held[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == kind for k, *_ in base) for kind in secrets.BASE)
        listed = [":".join(map(str, s)) for s in base]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("guess")] == listed


def test_edge_cases_and_empty_tables(spark):
    rows = [(1, None), (2, ""), (3, "token=abcdefgh"), (3, "token=abcdefgh"), (None, "pwd: kJ8#dL2$pQ9")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"spans": F.lit(1), "kind": F.lit("x"), "word": F.lit("y")})
    words = secrets.common_words(docs)
    found = secrets.scan(docs, words, keep=["doc_id", "kind", "spans", "text"]).collect()
    assert sorted((r.doc_id or 0, r.kind, len(r.spans)) for r in found) == [(0, "x", 1), (1, "x", 0), (2, "x", 0), (3, "x", 1), (3, "x", 1)]
    assert secrets.scan(docs.limit(0), secrets.common_words(docs.limit(0))).collect() == []


def test_word_list_counts_all_documents(spark):
    docs = spark.createDataFrame([("b b a",), ("a c é",), ("A, b; x1y",), (None,), ("été ab",)], "text string")
    assert sorted((r.word, r.n) for r in secrets.common_words(docs).collect()) == [("ab", 1), ("été", 1)]
    more = spark.createDataFrame([("zz yy",), ("yy xx",), ("xx yy",)], "text string").repartition(3)
    assert sorted((r.word, r.n) for r in secrets.common_words(more, 2).collect()) == [("xx", 2), ("yy", 3)]
