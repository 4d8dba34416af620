import math
import random

import pytest

from tidepanel.llm import topk
from tidepanel.llm.topk import exact_topk, integer_vectors


def brute(rows, k=5):
    ok = [
        (i, tuple(math.floor(256 * x) for x in v))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, v in sorted(set(ok)):
        if q % 50:
            continue
        scores = sorted({(-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q and len(w) == len(v)})
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)]
    return out


def search(spark, rows, k=5):
    vectors = integer_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).cache()
    found = exact_topk(vectors, vectors.where("vec_id % 50 = 0"), k)
    return sorted(tuple(r) for r in found.collect())


def floats(rng, n, spread=1.0):
    return [round(rng.gauss(0, spread) * 64) / 256 for _ in range(n)]


@pytest.mark.parametrize(("cells", "block", "query_block"), [(256, 8192, 1024), (2, 37, 3), (16, 64, 1)])
def test_same_as_brute_force(spark, monkeypatch, cells, block, query_block):
    monkeypatch.setattr(topk, "CELLS", cells)
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", query_block)
    rng = random.Random(cells)
    rows = [(i, floats(rng, 8)) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(40)]  # copies of a query
    rows += [(2000 + i, [0.5] * 8) for i in range(60)]  # ties, 2000 and 2050 are queries
    rows += [(3000 + i, floats(rng, 3)) for i in range(4)] + [(3050, floats(rng, 3)), (4000, floats(rng, 5))]
    rows += [(5000, None), (5001, [1.0, None] * 4), (5002, [math.nan] * 8), (5050, [math.inf] * 8), (None, [1.0] * 8)]
    rows += [rows[3]] * 2
    rng.shuffle(rows)
    assert search(spark, rows) == brute(rows)


def test_other_k_and_few_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])]
    assert search(spark, rows) == [(0, 1, 1, 32768), (0, 2, 2, -65536)]
    assert search(spark, rows, 1) == [(0, 1, 1, 32768)]
    assert search(spark, rows[:1]) == [] and search(spark, rows[1:]) == []
    assert search(spark, [(0, []), (1, []), (50, [])]) == [(0, 1, 1, 0), (0, 2, 50, 0), (50, 1, 0, 0), (50, 2, 1, 0)]


def test_components_are_floored(spark):
    rows = [(0, [1.0]), (1, [-0.001]), (2, [0.0039]), (3, [0.0079])]
    assert search(spark, rows) == [(0, 1, 3, 512), (0, 2, 2, 0), (0, 3, 1, -256)]


def test_components_too_large_are_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        search(spark, [(0, [1e30]), (1, [2.0])])
    assert search(spark, [(0, [2.0**20]), (1, [-(2.0**20)])]) == [(0, 1, 1, -(2**56))]


def test_empty_table_and_clashing_columns(spark, tmp_path):
    schema = "vec_id bigint, embedding array<float>, v int, dim string, own int, block int, score int, query_id int"
    rows = [(50 * i, [float(i), 1.0], 1, "x", 2, 3, 4, 5) for i in range(4)]
    for name, some in (("full", rows), ("empty", [])):
        spark.createDataFrame(some, schema).write.parquet(f"{tmp_path}/{name}/embeddings.parquet")
    found = sorted(tuple(r) for r in topk.op8_exact_topk(spark, f"{tmp_path}/full").collect())
    assert found == brute([(i, v) for i, v, *_ in rows])
    assert topk.op8_exact_topk(spark, f"{tmp_path}/empty").collect() == []
