import random
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest

from tidepanel.llm import substrings
from tidepanel.llm.substrings import LENGTH, anchors, common_prefixes, remove_repeats, suffix_array


def brute(docs):
    seen, out = set(), {}
    for doc_id, text in sorted(docs, key=lambda r: (r[0] is not None, r[0])):
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - LENGTH + 1):
            s = data[i : i + LENGTH]
            if s in seen:
                gone[i : i + LENGTH] = True
            seen.add(s)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = int((np.diff(gone.astype(int)) == 1).sum() + gone[0])
        out[doc_id] = (len(data), int(gone.sum()), spans, sha256(kept).hexdigest())
    return out


def corpus():
    rng = random.Random(8)
    words = ["the", "naïve", "of", "straße", "qu", "a", "ñandú", "zz", "end.", "\n"]
    text = lambda n: " ".join(rng.choice(words) + rng.choice(words) for _ in range(n))
    base = [text(rng.randrange(1, 200)) for _ in range(50)]
    passage = text(30)
    docs = base + [b[: rng.randrange(len(b))] + "!" + b[rng.randrange(len(b)) :] for b in base[:30]] + base[:8]
    docs += [text(rng.randrange(0, 30)) + passage + text(rng.randrange(0, 30)) for _ in range(40)]
    docs += ["Esñmi " * 300, "ab" * 400, "x" * 99, "x" * 100, "x" * 101, "x" * 700, "", None]
    docs += [passage * 3 + text(4) + passage, passage[:110], passage[5:104]]
    rows = list(enumerate(docs))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("spread", "slice_bytes", "bucket_bytes"), [(500, 2**20, 2**25), (500, 4000, 20_000), (2, 4000, 20_000), (0, 2**20, 2**25)])
def test_same_as_brute_force(spark, monkeypatch, spread, slice_bytes, bucket_bytes):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    monkeypatch.setattr(substrings, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(substrings, "BYTES_PER_BUCKET", bucket_bytes)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(df, spread).collect()}
    assert found == brute(rows)


def test_shards_of_any_size(monkeypatch):
    docs = [(i, t or "") for i, t in sorted(corpus())]
    ids = [i for i, _ in docs]
    wanted = brute(docs)
    for shard_bytes in (300, 3000, 2**20):
        monkeypatch.setattr(substrings, "SHARD_BYTES", shard_bytes)
        rows, slices = [], []
        for part in (docs[:50], docs[50:90], docs[90:]):
            own = [i for i, _ in part]
            every = substrings._packed(np.unique(anchors([t.encode() for _, t in part])[4]))
            table = pa.table({"doc": own, "tie": own, "text": [t for _, t in part]})
            replies = pa.table({"usual": pa.array([every], pa.binary())})
            slices.append((table.append_column("slice", pa.array([len(slices)] * len(own))), replies))
        claims = pa.concat_tables([substrings._claims(7)(*s) for s in slices]).sort_by("bucket").to_pylist()
        told = []
        for bucket in range(7):
            held = pa.Table.from_pylist([r for r in claims if r["bucket"] == bucket])
            told += substrings._answers(held).to_pylist() if held.num_rows else []
        for n, (table, replies) in enumerate(slices):
            answers = [r for r in told if r["slice"] == n] + [{"bucket": None, "answers": None, **r} for r in replies.to_pylist()]
            rows += substrings._contexts(7)(table, pa.Table.from_pylist(answers)).to_pylist()
        dealt = pa.RecordBatch.from_pylist(sorted(rows, key=lambda r: (r["h"], r["context"] or b"", r["doc"], r["tie"], r["a"])))
        ranges = {}
        for b in substrings._search_shards(iter([dealt])):
            for r in b.to_pylist():
                ranges.setdefault(r["doc"], set()).update(range(r["a"], r["b"]))
        assert {i: len(ranges.get(i, ())) for i in ids} == {i: wanted[i][1] for i in ids}


def test_packed_hashes_come_back():
    h = np.array([0, 1, 255, 2**39, 2**40 - 1])
    assert substrings._unpacked(substrings._packed(h)).tolist() == h.tolist() and substrings._unpacked(b"").tolist() == []


def test_suffix_array_and_prefixes():
    rng = random.Random(1)
    for text in ["banana" * 9, "a" * 50, "".join(rng.choice("ab") for _ in range(300)), "x"]:
        raw = np.frombuffer(text.encode(), np.uint8)
        order, at = suffix_array(raw)
        wanted = sorted(range(len(text)), key=lambda i: text[i:])
        assert order.tolist() == wanted and [order[k] for k in at] == list(range(len(text)))
        lcp = common_prefixes(raw, order, at, np.array([0]), np.array([len(raw)]), 1000)
        for k in range(1, len(wanted)):
            a, b = text[wanted[k - 1] :], text[wanted[k] :]
            assert lcp[k] == next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_every_string_has_one_anchor():
    docs = [t.encode() for _, t in corpus() if t]
    doc, at, low, high, h = anchors(docs)
    for d, data in enumerate(docs):
        mine = doc == d
        covered = [p for a, b in zip(low[mine], high[mine]) for p in range(a, b + 1)]
        assert covered == list(range(max(0, len(data) - LENGTH + 1)))
        assert all(b <= a_ <= a + LENGTH - substrings.GRAM for a_, a, b in zip(at[mine], low[mine], high[mine])) or not len(covered)


def test_repeated_rows_nulls_and_empty(spark):
    schema = "doc_id bigint, text string, doc string, tie int, a int"
    assert remove_repeats(spark.createDataFrame([], schema)).count() == 0
    t = "".join(random.Random(3).choices("abcdef ", k=400))
    rows = [(5, t, "x", 1, 1), (5, t, "x", 1, 1), (6, t, None, None, None), (None, t[:200], None, None, 2), (7, None, None, None, None)]
    found = sorted((r.doc_id or -1, r.n_bytes, r.n_removed) for r in remove_repeats(spark.createDataFrame(rows, schema)).collect())
    assert found == [(-1, 200, 0), (5, 400, 200), (5, 400, 200), (6, 400, 400), (7, 0, 0)]
    assert all(len(r.kept) == r.n_bytes - r.n_removed for r in remove_repeats(spark.createDataFrame(rows, schema)).collect())
