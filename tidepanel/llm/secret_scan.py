"""Secrets in texts: known formats, and values in a credential's place that are hard to guess.

What a password costs to guess is the least cost of cutting it into words, dates, repeats, keyboard walks and spans tried by brute
force, in decimal digits of the number of guesses; the cuts are found by dynamic programming over its characters. A word costs its
rank among the words of the whole corpus, which one aggregation counts. Values behind a credential's name ("pwd:", "mot de passe est", the
password of an address) that cost enough are secrets, whatever their format; placeholders and plain words are not.
"""

from __future__ import annotations

import functools
import itertools
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepanel.llm.common import query, stored, table, texts

BASE, KINDS = ("assign", "access", "hex"), ("assign", "access", "hex", "guess")
LEAST_COST = 8.0  # decimal digits of guesses
LEAST_LENGTH = 6
WORDS = 20_000  # size of the word list, which every task holds
_LONGEST_WORD = 24
_HELD_WORDS = 300_000

# Known formats, on UTF-8 bytes; names and their values with A-Z lowered.
_ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{24,}")
# Where a credential's value follows, in the languages of the corpus.
_CONTEXT = re.compile(
    rb"""(?:password|passwd|passphrase|passcode|(?<![a-z])pass|(?<![a-z])pwd|secret|token|(?:api|access|private)[\x20_-]?key|credentials?"""
    rb"""|(?<![a-z])auth|passwort|kennwort|mot\x20de\x20passe|contrase\xc3\xb1a|(?<![a-z])clave)["'`]?[\x20\t]*"""
    # Behind a verb, a value of letters only is a word of the sentence.
    rb"""(?:(?:[:=]+>?|->)[\x20\t]*|(?:is|ist|est|es)[\x20\t]++(?![a-z\x80-\xff]+[.:!?,;]*+(?:\s|$)))"""
    rb"""(?:"([^"\n]+)"|'([^'\n]+)'|["'`]?([^\s"'`,;<>()\[\]{}|]+))"""
)
_BEARER = re.compile(rb"(?<![a-z])(?:bearer|basic)\x20+([a-z0-9+/_.=~-]+)")
_ADDRESS = re.compile(rb"://[^\s/@:]+:([^\s/@]+)@")
_RUN = re.compile(r"[^\W\d_]+")

# Common passwords beside the corpus's words (fixed values).
PASSWORDS = ("password", "passwort", "admin", "administrator", "welcome", "letmein", "login", "master", "changeme", "secret", "default", "test", "example", "dragon", "monkey", "iloveyou")
# Signs that stand for letters (fixed values).
_SIGNS = {"@": "a", "4": "a", "3": "e", "1": "l", "!": "i", "0": "o", "$": "s", "5": "s", "7": "t"}
_UNSIGNED = str.maketrans(_SIGNS)
_KEYS = {c: (r, i) for r, row in enumerate(("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")) for i, c in enumerate(row)}
# From a key to its neighbours; each row lies half a key to the right of the one above.
_NEAR = {(0, 1), (0, -1), (1, 0), (1, -1), (-1, 0), (-1, 1)}
_START, _TURN, _AHEAD = math.log10(94), math.log10(6), math.log10(1.1)
_COPIES, _LONGEST_UNIT = 1.0, 8
_YEAR, _DAY, _SEPARATED = math.log10(200), math.log10(31 * 12), math.log10(4)
_WITH_SEPARATOR = re.compile(r"([0-9]{1,4})([-/._])([0-9]{1,2})\2([0-9]{1,4})")


def word_ranks(words: Iterable[str]) -> dict[str, int]:
    """Ranks from 1 of words given most common first, with the common passwords before them."""
    return {w: i for i, w in enumerate(dict.fromkeys([*PASSWORDS, *words]), 1)}


def _char_cost(c: str) -> float:
    if "0" <= c <= "9":
        return 1.0
    if c.isascii() and c.isalpha():
        return math.log10(26)
    return math.log10(33) if c.isascii() else 2.0


def _word_cost(rank: int, text: str, signs: int) -> float:
    """Of a word as it is written: capitals and signs in place of letters."""
    upper, letters = sum(c.isupper() for c in text), len(text) - signs
    if not upper:
        cases = 1
    elif upper in (1, letters) and (text[0].isupper() or upper == letters):
        cases = 2
    else:
        cases = sum(math.comb(letters, i) for i in range(1, min(upper, letters - upper) + 1)) + 1
    return math.log10(rank + 1) + math.log10(cases) + signs * math.log10(2)


def _words(text: str, ranks: Mapping[str, int]) -> Iterator[tuple[int, int, float]]:
    """(start, end, cost) of dictionary words, also with signs in place of letters."""
    lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    plain = lowered.translate(_UNSIGNED)
    signs = list(itertools.accumulate((a != b for a, b in zip(lowered, plain)), initial=0))
    for i in range(len(text)):
        if not plain[i].isalpha():
            continue
        for j in range(i + 2, min(len(text), i + _LONGEST_WORD) + 1):
            if not plain[j - 1].isalpha():
                break
            changed = signs[j] - signs[i]
            rank = ranks.get(plain[i:j])
            if rank is not None and changed < j - i:
                yield i, j, _word_cost(rank, text[i:j], changed)


def _is_date(parts: tuple[str, str, str]) -> float | None:
    """Cost of day, month and year in any usual order; None if they are no date."""
    best = None
    for y, m, d in ((0, 1, 2), (2, 1, 0), (2, 0, 1)):
        year, month, day = parts[y], parts[m], parts[d]
        if len(year) not in (2, 4) or len(month) > 2 or len(day) > 2 or not 1 <= int(month) <= 12 or not 1 <= int(day) <= 31:
            continue
        if len(year) == 4 and not 1900 <= int(year) <= 2099:
            continue
        cost = _DAY + (_YEAR if len(year) == 4 else 2.0)
        best = cost if best is None else min(best, cost)
    return best


def _dates(text: str) -> Iterator[tuple[int, int, float]]:
    """(start, end, cost) of years and of dates with and without separators."""
    for i, c in enumerate(text):
        if not "0" <= c <= "9":
            continue
        for n in (4, 6, 8):
            run = text[i : i + n]
            if len(run) < n or not (run.isascii() and run.isdigit()):
                break
            if n == 4:
                if 1900 <= int(run) <= 2099:
                    yield i, i + 4, _YEAR
                continue
            cuts = [(run[:2], run[2:4], run[4:])] + ([(run[:4], run[4:6], run[6:])] if n == 8 else [])
            costs = [cost for parts in cuts if (cost := _is_date(parts)) is not None]
            if costs:
                yield i, i + n, min(costs)
        found = _WITH_SEPARATOR.match(text, i)
        for n in range(1, len(found[4]) + 1) if found else ():
            if (cost := _is_date((found[1], found[3], found[4][:n]))) is not None:
                yield i, found.start(4) + n, cost + _SEPARATED


def _direction(a: str, b: str) -> tuple | None:
    """The way from one key to a neighbouring one, or along the alphabet."""
    a, b = a.lower(), b.lower()
    if a in _KEYS and b in _KEYS:
        way = (_KEYS[b][0] - _KEYS[a][0], _KEYS[b][1] - _KEYS[a][1])
        if way in _NEAR:
            return way
    if a.isascii() and b.isascii() and a.isalnum() and b.isalnum() and a.isalpha() == b.isalpha() and abs(ord(a) - ord(b)) == 1:
        return ("next", ord(b) - ord(a))
    return None


def guess_cost(text: str, ranks: Mapping[str, int]) -> float:
    """Decimal digits of the guesses that the cheapest cut of a text needs; linear in its length."""
    return _cheapest(text, ranks, functools.cache(lambda unit: _cheapest(unit, ranks, None)))


def _cheapest(text: str, ranks: Mapping[str, int], unit_cost: Callable[[str], float] | None) -> float:
    n, inf = len(text), math.inf
    unit_cost = unit_cost or (lambda unit: _cheapest(unit, ranks, None))
    ends: dict[int, list[tuple[int, float]]] = {}
    for start, end, cost in itertools.chain(_words(text, ranks), _dates(text)):
        ends.setdefault(end, []).append((start, cost))
    best = [0.0] + [inf] * n
    copies = [[inf] * (n + 1) for _ in range(_LONGEST_UNIT + 1)]  # by unit length: cheapest repeat that ends here
    same = [0] * (_LONGEST_UNIT + 1)  # characters equal to those a unit earlier
    way, begun, walk = None, inf, inf  # of the walks that end here: direction, cost with two keys, with more
    for i in range(1, n + 1):
        least = best[i - 1] + _char_cost(text[i - 1])
        for start, cost in ends.get(i, ()):
            least = min(least, best[start] + cost)
        for p in range(1, min(_LONGEST_UNIT, i - 1) + 1):
            same[p] = same[p] + 1 if text[i - 1] == text[i - 1 - p] else 0
            needed = 2 if p == 1 else 1  # further copies: aaa, abab
            if same[p] >= p * needed:
                new = best[i - p * (needed + 1)] + unit_cost(text[i - p : i]) + _COPIES
                copies[p][i] = min(copies[p][i - p], new)
                least = min(least, copies[p][i])
        old, way = way, _direction(text[i - 2], text[i - 1]) if i > 1 else None
        if way is None:
            begun = walk = inf
        else:
            walk = min(begun, walk) + (_AHEAD if way == old else _TURN)
            begun = best[i - 2] + _START + _TURN
            least = min(least, walk)
        best[i] = least
    return best[n]


def known_spans(data: bytes, lowered: bytes) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the known formats, in bytes; leftmost and not overlapping within a kind."""
    out = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(lowered) if m.end(1) - m.start(1) >= 6]
    out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(data) if m.end() - m.start() >= 20]
    return out + [(m.start(), m.end(), "hex") for m in _HEX.finditer(data)]


def credential_values(lowered: bytes) -> list[tuple[int, int]]:
    """Byte ranges of values in a credential's place, without the sentence's end behind them."""
    found = set()
    for pattern in (_CONTEXT, _BEARER, _ADDRESS):
        for m in pattern.finditer(lowered):
            a, b = m.span(m.lastindex)
            if m.lastindex != 1 or pattern is not _CONTEXT:
                while b > a and lowered[b - 1] in b".:?":
                    b -= 1
            found.add((a, b))
    return sorted((a, b) for a, b in found if b - a >= LEAST_LENGTH)


def find(text: str, ranks: Mapping[str, int], least_cost: float = LEAST_COST) -> list[tuple[str, int, int, float | None]]:
    """(kind, start, end, cost) in characters, by start, then kind. Known formats always stay; the cost is that of the value."""
    data = text.encode()
    lowered = data.lower()  # of bytes, lower() changes A-Z only
    known, values = sorted(known_spans(data, lowered)), credential_values(lowered)
    if not known and not values:
        return []
    costs = [guess_cost(data[a:b].decode(), ranks) for a, b in values]
    starts, reach = [a for a, _ in values], list(itertools.accumulate((b for _, b, _ in known), max))
    spans = []
    for a, b, kind in known:
        inside = itertools.takewhile(lambda i: starts[i] < b, range(bisect_left(starts, a), len(starts)))
        spans.append((a, b, kind, next((costs[i] for i in inside if values[i][1] <= b), None)))
    for (a, b), cost in zip(values, costs):
        before = bisect_right(known, a, key=lambda k: k[0])  # known spans that begin here or earlier
        if cost >= least_cost and not (before and reach[before - 1] >= b):
            spans.append((a, b, "guess", cost))
    place = np.r_[0, np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)]  # characters before each byte
    return sorted(((k, int(place[a]), int(place[b]), c) for a, b, k, c in spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def common_words(docs: DataFrame, n: int = WORDS) -> DataFrame:
    """(word, n): the ``n`` words in most documents; equal counts in alphabetical order. All documents are counted."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

        for _, rows in texts(batches, "text"):
            for text in rows:
                held.update({w for w in _RUN.findall(text.lower()) if 2 <= len(w) <= _LONGEST_WORD})
                if len(held) > _HELD_WORDS:
                    yield out()
                    held.clear()
        if held:
            yield out()

    counted = docs.select("text").mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counted = stored(counted, "word_counts")
    # The count that the last word of the list has: one row for each different count is summed up, not one for each word.
    more = F.sum("words").over(Window.orderBy(F.desc("n")))
    steps = counted.groupBy("n").agg(F.count(F.lit(1)).alias("words")).select("n", "words", more.alias("so_far"))
    least = steps.where(F.col("so_far") - F.col("words") < n).agg(F.min("n")).first()[0] or 0
    return stored(counted.where(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(n), "common_words")


SPANS = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("cost", T.DoubleType())])
)


def scan(docs: DataFrame, words: DataFrame, *, keep: list[str] | None = None, least_cost: float = LEAST_COST) -> DataFrame:
    """Columns ``keep`` (default doc_id) of every row with its spans (kind, start, end, cost), by start, then kind.

    Kinds: assign, access and hex are known formats; guess is a value in a credential's place that costs ``least_cost`` digits of
    guesses or more and does not lie in one of them. Start and end count characters, end exclusive; the cost is that of the credential's
    value, null where there is none. ``words`` has word and n, of at most a bounded number of rows (``common_words``). Null and empty texts
    have no spans, repeated rows have the same, texts are read whole in linear time, an empty table gives none. An input column
    named spans is replaced.
    """
    keep = ["doc_id"] if keep is None else [c for c in keep if c != "spans"]
    ranked = [r.word for r in words.orderBy(F.desc("n"), "word").collect()]  # as many as common_words was asked for
    shared = docs.sparkSession.sparkContext.broadcast(word_ranks(ranked))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("cost", pa.float64())]))
    columns = list(dict.fromkeys([*keep, "text"]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("kind", "start", "end", "cost")
        for part, rows in texts(batches, "text"):
            found = [[dict(zip(names, s)) for s in find(t, shared.value, least_cost)] for t in rows]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], pa.array(found, kind)], [*keep, "spans"])

    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField("spans", SPANS)])
    return docs.select(columns).mapInArrow(search, schema)


def _of_kinds(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query()
def op12_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    """Counts and places of secrets in every document."""
    docs = table(spark, d, "documents")
    found = scan(docs, common_words(docs))
    spans = F.col("spans")
    counts = [F.size(_of_kinds(spans, k)).cast("bigint").alias(f"n_{k}") for k in BASE]
    base = _listed(_of_kinds(spans, *BASE))
    return found.select("doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), _listed(spans).alias("spans"))
