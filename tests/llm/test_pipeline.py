import re
from collections import defaultdict

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from test_decontamination import words
from test_jaccard import brute
from tidepanel.llm.pii import QUERY_KEY, Pseudonyms

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], D).cache())
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "pseudonyms", "packing"]
    assert all(df.columns == stages[0].columns and df.schema == stages[0].schema for df in stages[1:-1])


def test_quality_rejects_labelled_junk_and_keeps_the_rest(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{D}/labels.parquet").collect()}
    kept = texts(stages[1])
    assert all((i in kept) == (q == 1) for i, q in labels.items())
    assert len(kept) > 0.7 * stages[0].count()


def test_one_document_of_each_component(stages):
    """Five-word Jaccard of 0.8 or more, over all pairs."""
    before, after = texts(stages[1]), texts(stages[2])
    assert sorted(after) == brute(sorted(before.items())) and all(after[i] == before[i] for i in after)


def test_no_passage_of_the_benchmark_left(spark, stages):
    grams = set()
    for r in spark.read.parquet(f"{D}/benchmark.parquet").collect():
        w = words(r.text)
        n = min(10, len(w))
        grams |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1) if n}
    lengths = {len(g) for g in grams}

    def hit(text):
        w = words(text)
        return any(tuple(w[i : i + n]) in grams for n in lengths for i in range(len(w) - n + 1))

    before, after = texts(stages[2]), texts(stages[3])
    assert after == {i: t for i, t in before.items() if not hit(t)}


def test_personal_values_are_replaced_and_nothing_else(stages):
    before, after = texts(stages[3]), texts(stages[4])
    pseudonyms = Pseudonyms(QUERY_KEY)
    assert after == {i: pseudonyms.apply(t)[0] for i, t in before.items()}
    mails = {m for t in before.values() for m in re.findall(r"\S+@\S+", t)}
    assert mails and not any(m in t for m in mails for t in after.values())


def test_all_that_is_left_is_packed(stages):
    pieces = defaultdict(int)
    for r in stages[5].collect():
        pieces[r.doc_id] += r.length
        assert r.offset + r.length <= 2048
    assert pieces.keys() == texts(stages[4]).keys()
    assert {r.doc_id: r.doc_tokens for r in stages[5].collect()} == pieces


def test_run_gives_the_last_stage(spark, stages):
    found = corpus_pipeline.run(spark, D)
    key = ["doc_id", "start", "length", "ids_crc32"]  # places in windows follow the order of the files
    assert found.select(key).exceptAll(stages[5].select(key)).isEmpty() and found.count() == stages[5].count()


def test_odd_rows_go_through_every_stage(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet").limit(60)
    odd = [(None, None, None, None, None), (7_000_001, "", "en", None, 0), (7_000_002, "Fine words. " * 20_000, None, "src0", 1)]
    rows = docs.unionByName(spark.createDataFrame(odd * 2, docs.schema))
    rows = rows.withColumns({"quality": F.lit("x"), "n_words": F.lit(1), "host": F.lit(None).cast("string"), "_id": F.lit(2)})
    for df in (rows, rows.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, D)
            if name != "packing":
                assert out.columns == rows.columns
                df = out.cache()
            assert out.count() <= 10**6
