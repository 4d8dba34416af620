"""Reversed search against a plain scoring of every pair."""

import math
import re

import pytest
from pyspark.sql import functions as F

from tidepanel.llm.reverse_search import reverse_search, term_counts

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, best=10):
    held = [(i, terms(t)) for i, t in docs if terms(t)]
    n, total = len(held), sum(len(w) for _, w in held)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = set()
    for item, own in wanted.items():
        found = []
        for doc, words in held:
            score = 0
            for t in own & set(words):
                df = sum(t in w for _, w in held)
                w, tf = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))), words.count(t)
                m = 100 - 90 + (90 * len(words) * n) // total
                score += w * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                found.append((-score, doc is None, doc))
        for rank, (score, _, doc) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:best], 1):
            out.add((item, rank, doc, -score))
    return out


DOCS = [
    (1, "Red fox, red FOX; größe"),
    (2, "red fox red fox größe"),
    (3, None),
    (4, ""),
    (5, "... --"),
    (6, "blue whale " * 5000),
    (7, "red whale Ünder under"),
    (7, "red whale Ünder under"),
    (None, "red fox red fox größe"),
    (9, "nothing of this kind"),
    (-3, "fox"),
]
ITEMS = [("a", "RED fox fox"), ("b", "whale ünder Größe"), ("c", None), ("d", "absent"), (None, "blue"), ("e", "fox"), ("e", "whale"), ("a", "RED fox fox")]


def rows(df):
    return {tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()}


@pytest.mark.parametrize("block_bytes", [4 * 2**20, 100])
def test_edge_cases_equal_brute_force(spark, block_bytes):
    docs = spark.createDataFrame(DOCS, "doc_id int, text string").withColumns({"n": F.lit(1), "item_id": F.lit("x"), "score": F.lit(2)})
    items = spark.createDataFrame(ITEMS, "item_id string, text string").withColumns({"rank": F.lit(0), "term": F.lit("t")})
    for parts in (1, 5):
        found = reverse_search(docs.repartition(parts), items, best=3, block_bytes=block_bytes)
        assert rows(found) == brute(DOCS, ITEMS, 3)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame(DOCS, "doc_id int, text string"), spark.createDataFrame(ITEMS, "item_id string, text string")
    assert rows(reverse_search(docs.limit(0), items)) == set()
    assert rows(reverse_search(docs, items.limit(0))) == set()


def test_long_text_is_counted_whole():
    text = "Alpha-beta " * 300_000 + "x" * 3_000_000 + " alpha"
    assert term_counts(text) == {b"alpha": 300_001, b"beta": 300_000, b"x" * 3_000_000: 1}


def test_ties_go_to_the_smaller_id(spark):
    docs = [(i, "same words here") for i in range(40, 0, -1)]
    found = reverse_search(spark.createDataFrame(docs, "doc_id long, text string").repartition(7), spark.createDataFrame([(1, "words")], "item_id long, text string"))
    assert rows(found) == brute(docs, [(1, "words")]) and [r.doc_id for r in found.orderBy("rank").collect()] == list(range(1, 11))
