import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidepanel.llm.sharding import HASH_BITS, assign_shards


def brute(rows, limit):
    """Splits buckets bit by bit."""
    bits = lambda k: format(int(hashlib.md5(str("" if k is None else k).encode()).hexdigest()[:15], 16), "060b")
    out, todo = {}, [("", rows)]
    while todo:
        prefix, inside = todo.pop()
        if sum(b for _, b in inside) <= limit or len(inside) == 1:
            out |= {k: (prefix, sum(b for _, b in inside)) for k, _ in inside}
            continue
        halves = defaultdict(list)
        for k, b in inside:
            halves[bits(k)[: len(prefix) + 1]].append((k, b))
        todo += halves.items()
    return out


@pytest.mark.parametrize("step", [2, 16])
def test_same_buckets_as_splitting_by_hand(spark, step):
    rows = [(i, (i * 37) % 90 + 1) for i in range(300)] + [(None, 5), (1000, 5000)]
    df = spark.createDataFrame(rows, "doc_id bigint, n int").withColumn("shard", F.lit("old"))
    found = assign_shards(df, F.col("n"), limit=400, step=step).collect()
    assert {r.doc_id: (r.shard, r.shard_bytes) for r in found} == brute(rows, 400)
    assert len(found) == len(rows) and all(len(r.shard) == r.depth for r in found)


def test_rows_of_one_key_over_the_limit_split_further(spark):
    df = spark.createDataFrame([(7, 10)] * 200 + [(8, 10)] * 3, "doc_id bigint, n int")
    found = assign_shards(df, F.col("n"), limit=100).collect()
    held = defaultdict(int)
    for r in found:
        held[r.shard] += r.row_bytes
        assert r.doc_id == 8 or r.depth > HASH_BITS
    assert len(found) == 203 and max(held.values()) <= 100
    assert all(held[r.shard] == r.shard_bytes for r in found)


def test_empty(spark):
    assert assign_shards(spark.createDataFrame([], "doc_id bigint, n int"), F.col("n")).count() == 0
