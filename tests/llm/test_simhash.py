import random
import re

import pytest
import xxhash

from tidepanel.llm import simhash
from tidepanel.llm.simhash import components, linked_groups, near_duplicates


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, values):
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= 2:
                parent[root(i)] = root(j)
    low = {}
    for i, n in enumerate(ids):
        low[root(i)] = min(low.get(root(i), n), n)
    return [low[root(i)] for i in range(len(ids))]


def texts():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    base = [" ".join(rng.choices(words, k=rng.randrange(1, 150))) for _ in range(60)]
    near = []
    for t in base[:40]:
        w = t.split()
        w[rng.randrange(len(w))] = "Änderung"
        near.append("\t ".join(w).upper() if rng.random() < 0.5 else "\n".join(w))
    short = ["", None, "a", "b", "a b", "a b c", "A\x0bB\x0cc", " ", "ÀÉ x y"]
    return base + near + short + base[:10] + ["word " * 20_000]


@pytest.mark.parametrize("limit", [1, 1000])
def test_same_as_brute_force(spark, limit):
    rows = [(i * 7 % 1000, t) for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in near_duplicates(df, shard_limit=limit).collect()}
    prints = [brute_fingerprint(t) for _, t in rows]
    wanted = brute_components([i for i, _ in rows], prints)
    assert found == {i: (f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, wanted)}


@pytest.mark.parametrize("limit", [1, 3, 1000])
def test_chains_of_flipped_bits(spark, limit, monkeypatch):
    rng = random.Random(5)
    values = {0}
    for start in [rng.getrandbits(64) for _ in range(8)] + [2**64 - 1, 1 << 63]:
        for _ in range(15):
            values.add(start)
            start ^= 1 << rng.randrange(64) | (1 << rng.randrange(64) if rng.random() < 0.6 else 0)
            if rng.random() < 0.2:
                start ^= 7 << rng.randrange(60)
    values = sorted(values)
    signed = [v - (v >> 63 << 64) for v in values]
    wanted = brute_components(signed, values)
    fps = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    roots = {r.node: r.root for r in components(simhash.links(fps, limit)).collect()}
    assert [roots.get(v, v) for v in signed] == wanted


def test_tree_links_are_complete():
    values = [0, 1, 3, 7, 15, 255, 3 << 40, (3 << 40) + 1]
    assert dict(linked_groups(values, 1)) == {1: 0, 3: 0, 7: 0, 15: 0, (3 << 40) + 1: 3 << 40}


def test_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 300)] + [(500, 501)], "a bigint, b bigint")
    roots = {r.node: r.root for r in components(edges).collect()}
    assert roots == {i: 0 for i in range(301)} | {500: 500, 501: 500}


def test_nulls_repeats_and_empty(spark):
    schema = "doc_id bigint, text string, fp string, component_id string"
    assert near_duplicates(spark.createDataFrame([], schema)).count() == 0
    df = spark.createDataFrame([(None, "p q r s", "x", "y"), (4, "p q r s", None, None), (4, "p q r s", None, None), (None, None, None, None)], schema)
    found = sorted((r.fingerprint == "0" * 16, r.doc_id or -1, r.component_id) for r in near_duplicates(df).collect())
    assert found == [(False, -1, 4), (False, 4, 4), (False, 4, 4), (True, -1, None)]


@pytest.mark.parametrize("task_links", [20, 50_000])
def test_components_take_no_more_tasks_than_their_links_need(spark, monkeypatch, task_links):
    """A chain and a star in a session of very many shuffle partitions that are not joined: rounds write few files."""
    made = []
    write = simhash.materialise

    def noted(df):
        made.append(write(df))
        return made[-1]

    monkeypatch.setattr(simhash, "materialise", noted)
    monkeypatch.setattr(simhash, "TASK_LINKS", task_links, raising=False)
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 60)]
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        found = {(r.node, r.root) for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
        parts = [df.rdd.getNumPartitions() for df in made[1:]]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert found == {(i, 0) for i in range(61)} | {(1000 + i, 1000) for i in range(60)}
    assert parts and max(parts) <= max(1, -(-4 * len(edges) // task_links))
