import random
import re

import numpy as np
import pytest

from tidepanel.llm import jaccard
from tidepanel.llm.jaccard import keep_one


def runs(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """Ids of the documents to keep."""
    sets = [runs(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    low = {}
    for i, (n, _) in enumerate(rows):
        low[root(i)] = min(low.get(root(i), n), n)
    return sorted(low.values())


def edited(rng, text, edits):
    w = text.split()
    for at in rng.sample(range(len(w)), edits):
        w[at] = f"edit{rng.randrange(10**6)}"
    return " ".join(w)


def made():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    line = " ".join(rng.choices(words, k=25))
    base = [" ".join(rng.choices(words, k=rng.randrange(20, 300))) for _ in range(30)]
    out = base + [f"{line} {t}" for t in base[:10]]
    out += [edited(rng, t, rng.randrange(1, max(2, len(t.split()) // 30))) for t in base for _ in range(4)]
    group = " ".join(rng.choices(words, k=120))  # around the limit, so components are chains
    out += [edited(rng, group, rng.randrange(1, 5)) for _ in range(60)]
    out += [base[0].upper(), base[1].replace(" ", "\n"), base[2], base[2], "", None, " ", "a", "A", "b", "a b c", "a b c d e f"]
    rng.shuffle(out)
    return [(i * 7 % 1009, t) for i, t in enumerate(out)]


@pytest.mark.parametrize("common", [0, 5, 200_000])
def test_same_as_all_pairs(spark, monkeypatch, common):
    monkeypatch.setattr(jaccard, "COMMON", common)
    rows = made()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert sorted(r.doc_id for r in keep_one(df).collect()) == brute(rows)


def test_near_copies_many_bits_apart_are_one(spark):
    """A pair of similarity 0.8 or more, three bits or more apart by fingerprints of three words."""
    from tidepanel.llm.simhash import fingerprint, shingle_hashes

    rng = random.Random(2)
    text = " ".join(f"w{rng.randrange(5000)}" for _ in range(200))
    copy = edited(rng, text, 4)
    bits = [fingerprint(shingle_hashes(t, 3)) for t in (text, copy)]
    assert ((bits[0] ^ bits[1]) & (2**64 - 1)).bit_count() > 2 and jaccard.similar(*map(jaccard.shingles, (text, copy)))
    df = spark.createDataFrame([(2, text), (1, copy), (3, "w1 w2 w3 w4 w5 w6")], "doc_id bigint, text string")
    assert sorted(r.doc_id for r in keep_one(df).collect()) == [1, 3]


def test_stage_of_the_pipeline(spark):
    from tidepanel.llm import pipeline

    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    kept = {r.doc_id for r in pipeline.drop_near_duplicates(spark, docs, d).select("doc_id").collect()}
    # The later ones of the pairs found by comparing all.
    assert kept.isdisjoint({56, 255, 770, 875, 944}) and len(kept) == 922


def test_prefix_of_small_sets():
    none = np.empty(0, np.uint64)
    assert [len(jaccard.prefix(np.arange(n, dtype=np.uint64), none, none)) for n in (0, 1, 4, 5, 10)] == [0, 1, 1, 2, 3]


def test_large_cells_of_two_blocks(spark, monkeypatch):
    """A shingle of very many sets is cut into blocks: groups of near copies with a hub that few of them are similar to."""
    monkeypatch.setattr(jaccard, "CELL_ROWS", 50)
    rng = random.Random(8)
    text = " ".join(f"w{rng.randrange(4000)}" for _ in range(150))
    rows = [(i, edited(rng, text, rng.randrange(1, 8))) for i in range(160)]
    rows += [(500 + i, " ".join([text, *(f"x{rng.randrange(10**6)}" for _ in range(rng.randrange(20, 60)))])) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert sorted(r.doc_id for r in keep_one(df).collect()) == brute(rows)


def test_pairs_of_large_and_small_cells_agree():
    rng = np.random.default_rng(4)
    n = 300
    size = np.sort(rng.integers(5, 60, n))
    at = (size << 32) + rng.integers(0, 3, n)
    sig, root = rng.permutation(n).astype(np.int64), rng.integers(0, 6, n)
    wanted = set()
    for i in range(n):
        for j in range(i):
            if root[i] != root[j] and jaccard._fits(at[i : i + 1], at[j : j + 1])[0]:
                wanted.add((min(sig[i], sig[j]), max(sig[i], sig[j])))
    assert set(map(tuple, jaccard._pairs(np.zeros(n, int), at, sig, root, 0, 0))) == wanted
    block = sig % 2
    crossed = {(a, b) for a, b in wanted if a % 2 != b % 2}
    assert set(map(tuple, jaccard._pairs(block, at, sig, root, 0, 0))) == crossed
    picked = set(map(tuple, jaccard._pairs(np.zeros(n, int), at, sig, root, 2, 1)))
    assert picked <= wanted and len(picked) <= 2 * n
    some = slice(0, jaccard.SMALL_CELL)
    small = set(map(tuple, jaccard._small_pairs(np.zeros(jaccard.SMALL_CELL, int), at[some], sig[some], root[some])))
    assert small == {p for p in wanted if set(p) <= set(sig[some].tolist())}


def test_histograms_rule_out_no_similar_pair():
    rng = np.random.default_rng(5)
    for _ in range(300):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 400)).astype(np.uint64) * np.uint64(2))
        keep = a[rng.random(len(a)) < rng.uniform(0.75, 1)]
        b = np.unique(np.concatenate([keep, rng.integers(0, 2**63, rng.integers(0, len(a) // 6 + 1)).astype(np.uint64)]))
        if len(b) and jaccard.similar(a, b):
            assert jaccard.may_be_similar(jaccard.histogram(a), len(a), jaccard.histogram(b), len(b))
    far = [np.unique(rng.integers(0, 2**63, 300).astype(np.uint64) * np.uint64(2)) for _ in range(2)]
    assert not jaccard.may_be_similar(jaccard.histogram(far[0]), 300, jaccard.histogram(far[1]), 300)


def test_bitmaps_keep_all_similar_pairs_of_a_large_cell_and_few_others():
    """Edits of one text: all fit in size and place, few are similar. Rows must not grow with the square of the group."""
    rng = random.Random(12)
    text = " ".join(f"w{rng.randrange(4000)}" for _ in range(150))
    sets = [jaccard.shingles(edited(rng, text, rng.randrange(1, 12))) for _ in range(300)]
    sets = sorted(sets, key=len)
    at = np.array([len(h) << 32 for h in sets])
    sig, root, block = np.arange(300), np.arange(300), np.zeros(300, int)
    bits = jaccard._matrix(np.array([jaccard.bitmap(h) for h in sets], object))
    wanted = {(j, i) for i in range(300) for j in range(i) if jaccard.similar(sets[i], sets[j])}
    plain = set(map(tuple, jaccard._pairs(block, at, sig, root, 0, 0)))
    bound = set(map(tuple, jaccard._pairs(block, at, sig, root, 0, 0, bits)))
    assert wanted and wanted <= bound <= plain and len(plain) > 40_000 and len(bound) < 2 * len(wanted) < 5_000
    picked = [set(map(tuple, jaccard._pairs(block, at, sig, root, 4, seed, bits))) for seed in (0, 1)]
    assert all(p <= bound and len(p) <= 4 * 300 for p in picked)
    joined = {i for p in wanted for i in p}
    assert {i for p in picked[0] & wanted for i in p} == joined  # the best partners are similar ones, where there are any


def test_fingerprints_of_close_copies_meet_in_trees(spark):
    """The stage goes through SimHash fingerprints and BK-trees; each set that these link gets the first of its component as hub."""
    rng = random.Random(6)
    base = [" ".join(f"w{rng.randrange(5000)}" for _ in range(900)) for _ in range(20)]
    rows = base + [f"{t} end" for t in base]
    sets = [jaccard.shingles(t) for t in rows]
    sigs, fps = [jaccard.signature(h) for h in sets], [jaccard.fingerprint(h) for h in sets]
    near = {(min(sigs[i], sigs[i + 20]), max(sigs[i], sigs[i + 20])) for i in range(20) if ((fps[i] ^ fps[i + 20]) & (2**64 - 1)).bit_count() <= 2}
    found = jaccard._tree_hubs(spark.createDataFrame(list(zip(sigs, fps)), "sig bigint, fp bigint"))
    assert len(near) > 10 and {(r.a, r.b) for r in found.collect()} == near


def test_shingles_are_those_of_the_words():
    """Equal runs have equal hashes, different ones different, whatever separates the words."""
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["a", "B", "ab", "é", "x-y", "aa"]) for _ in range(rng.randrange(0, 12))) for _ in range(400)] + ["a\tb \n c  d\x0be", "A B C D E"]
    seen = {}
    for t in texts:
        held, own = jaccard.shingles(t), runs(t)
        assert len(held) == len(own)
        for u, other in list(seen.items())[:60]:
            assert len(np.intersect1d(held, other)) == len(own & runs(u))
        seen[t] = held
    assert jaccard.shingles("a\tb \n c  d\x0be").tolist() == jaccard.shingles("A B C D E").tolist()


def test_empty_table_nulls_and_clashing_columns(spark):
    schema = "doc_id bigint, text string, none int, id string, tie int, c0 string, sig int"
    rows = [(3, None, 1, "x", 2, "c", 4), (2, "", 1, "x", 2, "c", 4), (None, " \n", 1, "x", 2, "c", 4), (5, "w " * 50_000, 0, "y", 1, "d", 5), (5, "w " * 50_000, 0, "y", 1, "d", 5), (None, "q", 7, "z", 8, "e", 6)]
    df = spark.createDataFrame(rows, schema)
    found = sorted(map(tuple, keep_one(df).collect()), key=str)
    assert found == sorted([rows[1], rows[3], rows[5]], key=str)
    assert keep_one(df.limit(0)).collect() == [] and keep_one(df).columns == df.columns
