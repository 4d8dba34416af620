import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tidepanel.llm import langid
from tidepanel.llm.langid import BUCKETS, cluster, fit, gram_counts, identify, op4_language_id

SYLLABLES = {"aa": "ka ki ku ta to mo ra".split(), "bb": "stra ung ein sch ich ber".split(), "cc": "ção ões lha nho que".split()}


def sample(n, seed=0):
    rng = random.Random(seed)
    word = lambda lang: "".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 4)))
    out = []
    for i in range(n):
        lang = "aabbcc"[2 * (i % 3) : 2 * (i % 3) + 2]
        out.append((i, " ".join(word(lang) for _ in range(rng.randrange(3, 60))), lang))
    return out


@pytest.fixture(scope="module")
def model(spark):
    return fit(spark.createDataFrame(sample(300), "doc_id bigint, text string, lang string"), centroids=2, sample=60)


def test_counts_of_all_grams():
    found = gram_counts(["ab", ""])
    assert found.shape == (2, BUCKETS) and found[0].sum() == 4 + 3 + 2 and found[1].sum() == 2 + 1


def test_clusters_are_found():
    rng = np.random.default_rng(0)
    points = np.eye(5)[rng.integers(0, 3, 200)] + 0.05 * rng.normal(size=(200, 5))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    centres = cluster(points, 3)
    assert sorted(c.argmax() for c in centres) == [0, 1, 2]


def test_held_out_texts(spark, model):
    rows = sample(300, seed=9)
    found = identify(spark.createDataFrame(rows, "doc_id bigint, text string, lang string").select("doc_id", "text"), model).collect()
    right = sum(r.lang_pred == lang for r, (_, _, lang) in zip(sorted(found), rows))
    assert right >= 0.98 * len(rows) and all(0 <= r.score <= 1 for r in found)
    assert len(model.languages) == 6 and Counter(model.languages) == {"aa": 2, "bb": 2, "cc": 2}


def test_same_as_looking_at_every_centroid(spark, model):
    rows = [(i, t) for i, t, _ in sample(40, seed=4)]
    found = {r.doc_id: r for r in identify(spark.createDataFrame(rows, "doc_id bigint, text string"), model, reject=False).collect()}
    for i, t in rows:
        v = langid.vectors([t], model.idf)[0]
        best = max(range(6), key=lambda c: (float(v @ model.centres[c]), -c))
        assert found[i].lang_pred == model.languages[best]
        assert abs(found[i].score - float(v @ model.centres[best])) < 1e-5


def test_far_texts_are_rejected_only_on_demand(spark, model):
    df = spark.createDataFrame([(1, "xyzzyx wqwqw zzxx " * 5)], "doc_id bigint, text string")
    (strict,), (open_,) = identify(df, model).collect(), identify(df, model, reject=False).collect()
    assert strict.lang_pred == "und" and strict.rejected and open_.rejected and open_.lang_pred in SYLLABLES


def test_odd_rows(spark, model):
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "日本"), (None, "ka ki ku"), (5, "stra " * 60_000), (5, "stra " * 60_000)]
    found = identify(spark.createDataFrame(rows, "doc_id bigint, text string"), model, reject=False).collect()
    by = {r.doc_id: (r.lang_pred, r.score) for r in found}
    assert len(found) == 7 and by[1] == by[2] == by[3] == ("und", 0.0)
    assert by[4][0] in SYLLABLES and by[None][0] == "aa" and by[5][0] == "bb"


def test_nothing_to_learn_from(spark):
    empty = fit(spark.createDataFrame([(1, "x", None), (2, "1", "aa")], "doc_id bigint, text string, lang string"))
    df = spark.createDataFrame([(1, "ka"), (2, None)], "doc_id bigint, text string")
    assert [(r.lang_pred, r.score) for r in identify(df, empty).collect()] == [("und", 0.0)] * 2
    assert identify(df.limit(0), empty).count() == 0


def test_query_on_the_smallest_table(spark):
    d = "/root/testdata/sf0.001"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    found = op4_language_id(spark, d).collect()
    assert sorted(r.doc_id for r in found) == sorted(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_copies_do_not_crowd_out_a_language(spark, monkeypatch):
    """A language of very many copies of one text is learned from its other texts too, each of them once."""
    rows = [t for t in sample(120) if t[2] != "cc"] + [(900, "lha que nho", "cc")] * 3000 + [t for t in sample(60) if t[2] == "cc"]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    for least in (1, 5):  # five centroids need as many different texts
        model = fit(df, centroids=least, sample=5)
        assert Counter(model.languages) == {"aa": least, "bb": least, "cc": least}
        found = np.unique(model.centres.round(4), axis=0)
        assert len(found) == 3 * least
