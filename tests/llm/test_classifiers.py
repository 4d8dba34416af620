import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidepanel.llm import linear, quality, toxicity
from tidepanel.llm.quality import MAX_STRENGTH, QualityModel, assess, site_posteriors

WORDS = [f"{a}{b}" for a in "ban cor del fim gor hul".split() for b in "an el ir os ut".split()]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def toxic_corpus(spark):
    """Insults by (two) spellings; threats only ever come with an insult."""
    rng, rows, labels = random.Random(2), [], []
    for i in range(600):
        text, insult = prose(rng, rng.randrange(10, 60)), i % 3 == 0
        threat = insult and i % 2 == 0
        if insult:
            text = f"{text} {rng.choice(['idiotus', 'idiotae', 'scum'])} {prose(rng, 5)}"
        if threat:
            text += " beware" if rng.random() < 0.8 else ""
        rows.append((i, text))
        labels.append((i, int(insult), int(threat)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    return docs, spark.createDataFrame(labels, "doc_id bigint, insult int, threat int")


@pytest.fixture(scope="module")
def chain(toxic_corpus):
    docs, labels = toxic_corpus
    known = labels.where(F.col("doc_id") < 400)
    return toxicity.fit(docs, known, {"insult": "insult", "threat": "threat"})


def test_chain_on_unseen_documents(toxic_corpus, chain):
    docs, labels = toxic_corpus
    found = toxicity.score(docs, chain).join(labels, "doc_id").where("doc_id >= 400").collect()
    assert sum(r.is_insult == (r.insult == 1) for r in found) >= 0.97 * len(found)
    # The link sees the earlier category: no threat without an insult, and a positive weight for it.
    assert not any(r.p_threat > 0.5 and not r.is_insult for r in found)
    assert chain.models[1].numFeatures == len(chain.words.vocabulary) + 1
    assert chain.models[1].coefficients[len(chain.words.vocabulary)] > 0


def test_later_links_train_on_out_of_fold_probabilities(toxic_corpus, monkeypatch):
    docs, labels = toxic_corpus
    seen = []
    real = toxicity.fit_logistic
    monkeypatch.setattr(toxicity, "fit_logistic", lambda df, *a, **k: seen.append(df) or real(df, *a, **k))
    toxicity.fit(docs, labels, {"insult": "insult", "threat": "threat"})
    assert len(seen) == 1 + toxicity.FOLDS + 1
    for fold, df in enumerate(seen[1 : 1 + toxicity.FOLDS]):
        assert fold not in {r.fold for r in df.select("fold").distinct().collect()}
    assert seen[-1].count() == docs.count()


def test_odd_rows_get_base_rates(spark, chain):
    schema = "doc_id bigint, text string, words string, p_insult string"
    df = spark.createDataFrame([(1, None, "a", "b"), (2, "", None, None), (2, "", None, None), (None, "scum " * 40_000, "", "")], schema)
    found = toxicity.score(df, chain).collect()
    by = {r.doc_id: r.p_insult for r in found}
    assert len(found) == 4 and by[1] == by[2] and by[None] > 0.5
    assert toxicity.score(df.limit(0), chain).count() == 0


def test_labels_without_two_classes(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id bigint, text string")
    ones = spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id bigint, x int")
    assert [r.p_x for r in toxicity.score(docs, toxicity.fit(docs, ones, {"x": "x"})).collect()] == [1.0, 1.0]
    none = ones.limit(0)
    assert [r.p_x for r in toxicity.score(docs, toxicity.fit(docs, none, {"x": "x"})).collect()] == [0.0, 0.0]


def test_sample_is_bounded_and_repeated_labels_count_once(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    labels = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("y"))
    n = linear.labelled_sample(docs, labels.unionAll(labels), ["y"], 500).count()
    assert 400 < n < 600


def brute_sites(rows):
    def strength(groups, mean):
        n = sum(c for _, c in groups)
        if len(groups) < 2:
            return MAX_STRENGTH
        ss = sum(c * (g / c - mean) ** 2 for g, c in groups)
        between = (ss - (len(groups) - 1) * mean * (1 - mean)) / (n - sum(c * c for _, c in groups) / n)
        return MAX_STRENGTH if between <= 0 else min(max(mean * (1 - mean) / between - 1, 1.0), MAX_STRENGTH)

    paths, hosts = defaultdict(list), defaultdict(list)
    for host, path, good in rows:
        paths[host, path].append(good)
        hosts[host].append(good)
    mean = sum(g for *_, g in rows) / len(rows)
    a = strength([(sum(v), len(v)) for v in hosts.values()], mean)
    b = strength([(sum(v), len(v)) for v in paths.values()], mean)
    host = {h: (sum(v) + a * mean) / (len(v) + a) for h, v in hosts.items()}
    return {k: (host[k[0]], (sum(v) + b * host[k[0]]) / (len(v) + b)) for k, v in paths.items()}


def test_posteriors_as_by_hand(spark):
    rng = random.Random(4)
    rows = [(f"h{i % 7}", f"h{i % 7}/p{i % 3}", float(rng.random() < (0.2 if i % 7 < 2 else 0.9))) for i in range(900)]
    rows += [("tiny", "tiny/x", 0.0)]
    found, mean = site_posteriors(spark.createDataFrame(rows, "host string, path string, good double"))
    wanted = brute_sites(rows)
    got = {(r.host, r.path): (r.host_posterior, r.path_posterior) for r in found.collect()}
    assert got.keys() == wanted.keys()
    assert all(math.isclose(a, b, rel_tol=1e-9) for k in got for a, b in zip(got[k], wanted[k]))
    # One bad document does not condemn its site; a large bad one keeps its own mean.
    assert got["tiny", "tiny/x"][1] > 0.1 and got["h0", "h0/p0"][1] < 0.3


def test_quality_of_unseen_documents_and_odd_rows(spark):
    rng = random.Random(3)
    rows = []
    for i in range(500):
        bad = i % 4 == 0
        text = prose(rng, 40)
        rows.append((i, " ".join(f"{w}%%%" for w in text.split()) if bad else text, f"s{i % 5}"))
    rows += [(900, None, None), (901, "", "s1"), (902, "good words here. " * 9000, None), (903, rows[1][1], "s2"), (903, rows[1][1], "s2")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, host string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(300)] + [(None, 1)], "doc_id bigint, quality int")
    model = quality.fit(df, labels)
    found = assess(df, labels, model, host=F.col("host"), path=F.col("host")).collect()
    by = {r.doc_id: r for r in found}
    assert len(found) == len(rows) and all(by[i].keep == (i % 4 != 0) for i in range(500))
    assert by[903].keep and by[900].host == "" and 0 <= by[901].quality <= 1
    assert assess(df.limit(0), labels, model, host=F.col("host"), path=F.col("host")).count() == 0


def test_a_site_moves_its_documents(spark):
    rows = [(i, "same text.", "bad" if i < 100 else "good") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([(i, int(i >= 100)) for i in range(0, 200, 2)], "doc_id bigint, quality int")
    found = assess(df, labels, QualityModel(0.5), host=F.col("source"), path=F.col("source")).collect()
    low = {r.quality for r in found if r.host == "bad"}
    high = {r.quality for r in found if r.host == "good"}
    assert max(low) < 0.5 < min(high)


def sigmoid(x):
    return 1 / (1 + math.exp(-x))


def log_odds(p):
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


def plain_chain(chain, text):
    """Probabilities of every link, word by word."""
    words = set(re.findall(r"[^\W_]+", text.lower()))
    held = words | {w[:4] + "*" for w in words}
    at, earlier, out = {w: i for i, w in enumerate(chain.words.vocabulary)}, [], []
    for model in chain.models:
        weights = model.coefficients.toArray()
        x = model.intercept + sum(weights[at[w]] for w in held if w in at) + sum(a * b for a, b in zip(weights[len(at) :], earlier))
        out.append(sigmoid(x))
        earlier.append(log_odds(out[-1]))
    return out


def test_chain_scores_word_by_word(spark, toxic_corpus, chain):
    docs, _ = toxic_corpus
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = toxicity.score(docs, chain).collect()
    for r in found:
        assert [r.p_insult, r.p_threat] == pytest.approx(plain_chain(chain, texts[r.doc_id]), abs=1e-9)
        assert (r.is_insult, r.is_threat) == (r.p_insult >= 0.5, r.p_threat >= 0.5)


def test_vocabulary_is_that_of_highest_chi_square(spark, toxic_corpus, chain):
    docs, labels = toxic_corpus
    known = {r.doc_id: (r.insult, r.threat) for r in labels.where("doc_id < 400").collect()}
    rows = [(set(re.findall(r"[^\W_]+", r.text.lower())), known[r.doc_id]) for r in docs.where("doc_id < 400").collect()]
    rows = [(w | {x[:4] + "*" for x in w}, y) for w, y in rows]
    tokens = {t for w, _ in rows for t in w}
    tokens = {t for t in tokens if sum(t in w for w, _ in rows) >= toxicity.LEAST_DOCUMENTS}
    wanted = set()
    for c in (0, 1):
        total, ones = len(rows), sum(y[c] for _, y in rows)
        scored = []
        for t in tokens:
            n, both = sum(t in w for w, _ in rows), sum(y[c] for w, y in rows if t in w)
            gap = both * (total - ones) - (n - both) * ones
            scored.append((-total * gap * gap / max(n * (total - n) * ones * (total - ones), 1), t))
        wanted |= {t for x, t in sorted(scored)[: toxicity.TOKENS_PER_CATEGORY] if x < 0}
    assert set(chain.words.vocabulary) == wanted


def test_combined_quality_as_by_hand(spark):
    d = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = quality.fit(docs, labels)
    p = {r.doc_id: r.p_doc for r in model.evidence(docs, "p_doc").select("doc_id", "p_doc").collect()}
    rows = docs.collect()
    label = {r.doc_id: float(r.quality) for r in labels.collect()}
    sites = {r.doc_id: (r.source or "", "/".join(x for x in (r.source, r.lang) if x is not None)) for r in rows}
    good = [(*sites[r.doc_id], label.get(r.doc_id, p[r.doc_id])) for r in rows]
    posterior, mean = brute_sites(good), sum(g for *_, g in good) / len(good)
    for store in (True, False):
        found = assess(docs, labels, model, host=F.col("source"), path=F.concat_ws("/", "source", "lang"), store=store).collect()
        assert len(found) == len(rows)
        for r in found:
            host, path = posterior[sites[r.doc_id]]
            wanted = sigmoid(log_odds(p[r.doc_id]) + quality.SITE_WEIGHT * (log_odds(path) - log_odds(mean)))
            assert (r.host_posterior, r.path_posterior, r.quality) == pytest.approx((host, path, wanted), abs=1e-9)
            assert r.keep == (r.quality >= quality.KEEP_FROM)
