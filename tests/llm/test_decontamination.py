import random
import re

import pytest

from tidepanel.llm import decontamination
from tidepanel.llm.decontamination import contamination, decontaminate, words_of

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, tests):
    out = {}
    for doc_id, text in docs:
        w, hit, items = words(text), set(), set()
        for item, t in tests:
            v = words(t)
            n = min(10, len(v))
            grams = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
            for i in range(len(w) - n + 1 if n else 0):
                if tuple(w[i : i + n]) in grams:
                    hit |= set(range(i, i + n))
                    items.add("" if item is None else str(item))
        out[doc_id] = (len(w), len(hit), sorted(items))
    return out


def tables():
    rng = random.Random(1)
    vocabulary = ["The", "cat", "naïve", "東京", "x1", "42", "of", "É", "zebra", "on"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "--", "\x00"]) for _ in range(n))
    tests = [(i, text(rng.choice([1, 3, 9, 10, 11, 30]))) for i in range(14)]
    tests += [(10, text(12)), (3, text(25)), (70, None), (71, ""), (72, "..."), (None, "only here as null item")]
    docs = [(i, text(rng.randrange(0, 120))) for i in range(60)]
    for i in range(20):
        docs.append((100 + i, text(5) + rng.choice(tests[:14])[1].upper().replace("É", "é") if i % 2 else text(8) + (tests[i % 14][1] + " ") * 2))
    docs += [(300, None), (301, ""), (302, "qq " * 40_000 + (tests[3][1] or "")), (303, "only here as null item")]
    return docs, tests


@pytest.mark.parametrize("block", [200, 1 << 24])
def test_same_as_brute_force(spark, block):
    docs, tests = tables()
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    t = spark.createDataFrame(tests, "item_id bigint, text string")
    found = contamination(d, t, block_bytes=block).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in found} == brute(docs, tests)
    assert all(r.contaminated == (r.n_hit > 0) for r in found)


def test_longest_match_and_place(spark):
    item = " ".join(f"w{i}" for i in range(30))
    body = "start " + " ".join(f"w{i}" for i in range(4, 29)) + " end"
    d = spark.createDataFrame([(1, body), (2, "w1 w2 w3")], "doc_id bigint, text string")
    found = {r.doc_id: r for r in contamination(d, spark.createDataFrame([(9, item)], "item_id bigint, text string")).collect()}
    assert (found[1].longest, found[1].spans, found[1]["items"]) == (25, [1, 26], ["9"])
    assert (found[2].longest, found[2].spans) == (0, [])


def test_word_hash_depends_on_the_word_only():
    starts, ends, hashes = words_of("abc ABC xabc cba abc".encode())
    assert hashes[0] == hashes[1] == hashes[4] and len(set(hashes.tolist())) == 3


def test_removal_keeps_columns_and_handles_empty(spark):
    schema = "doc_id bigint, text string, n_words string, spans bigint, item_id bigint"
    d = spark.createDataFrame([(1, "a b", "k", 5, None), (1, "a b", "k", 5, None), (None, None, None, None, 2)], schema)
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate(d, none).columns == d.columns and decontaminate(d, none).count() == 3
    hit = spark.createDataFrame([(1, "b")], "item_id bigint, text string")
    assert [r.item_id for r in decontaminate(d, hit).collect()] == [2]
    assert contamination(spark.createDataFrame([], schema), hit).count() == 0


def test_copies_of_an_item_are_read_once_in_bounded_blocks(spark, monkeypatch):
    tests = [(1, "p q r s t u v w x y z")] * 500 + [(i, f"one{i} two three four five six seven eight nine ten") for i in range(2, 60)]
    sizes, build = [], decontamination.build_index
    monkeypatch.setattr(decontamination, "build_index", lambda rows, window: sizes.append(sum(len(t) + 64 for _, t in rows)) or build(rows, window))
    d = spark.createDataFrame([(1, "a p q r s t u v w x y z"), (2, "none")], "doc_id bigint, text string")
    found = contamination(d, spark.createDataFrame(tests, "item_id bigint, text string"), block_bytes=3000).collect()
    assert {r.doc_id: r["items"] for r in found} == {1: ["1"], 2: []}
    assert len(sizes) > 1 and max(sizes) <= 6000 and sum(sizes) == sum(len(t) + 64 for _, t in set(tests))


def test_short_items_are_reported_not_removed(spark):
    tests = spark.createDataFrame([(1, "Paris"), (2, "in 1984, naïve"), (3, "a b c d e f g H"), (4, None), (5, "...")], "item_id bigint, text string")
    docs = [(1, "from paris " * 9), (2, "In 1984 naïve too"), (3, "x A B C D E F G H y"), (4, "a b c d e f g")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    with pytest.warns(UserWarning, match="2 test items of fewer than 8 words"):
        assert sorted(r.doc_id for r in decontaminate(d, tests, least_words=8).collect()) == [1, 2, 4]
    assert [r.doc_id for r in decontaminate(d, tests).collect()] == [4]
    assert {r.doc_id: r["items"] for r in contamination(d, tests).collect()} == {1: ["1"], 2: ["2"], 3: ["3"], 4: []}
