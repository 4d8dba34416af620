import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidepanel.llm.packing import GRANULE, WINDOW, cuts, encoder, pack, queues_of


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def check(tokenizer, rows, found):
    """Every id in exactly one piece, checksums, gapless sequences; returns the number of sequences."""
    pieces = defaultdict(list)
    for r in found:
        pieces[r.doc_id].append(r)
    for doc_id, text, *_ in rows:
        ids, at = np.array(ids_of(tokenizer, text), dtype="<u4"), 0
        for p in sorted(pieces[doc_id], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    windows = defaultdict(list)
    for r in found:
        windows[r.sequence_id].append((r.offset, r.length))
    for spans in windows.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= WINDOW
    assert sum(sum(n for _, n in s) < WINDOW for s in windows.values()) <= 1
    assert set(windows) == set(range(len(windows)))
    return len(windows)


def test_ids_are_those_of_the_tokenizer(tokenizer):
    odd = ["", " ", "a  b \n c\t", "<|endoftext|> x<|endoftext|>", "naïve 東京 🙂​\x1c\x85 1234 can't WE'LL", "\r\n\r\n  x"]
    for text in odd:
        assert encoder().encode(text, allowed_special="all") == tokenizer.encode(text, add_special_tokens=False).ids


def test_cuts_are_aligned():
    for n in range(1, 1500):
        at = 0
        for length in cuts(n):
            assert at % length == 0
            at += length
        assert at == n


def test_packs_every_id_once(spark, tokenizer):
    words = "the cat sat on a mat and looked at 17 birds ".split()
    rows = [(i, " ".join(words[(i + j) % 10] for j in range(i * 7 % 900)), f"s{i % 3 and i % 7}") for i in range(120)]
    rows += [(500, None, "s1"), (501, "", None), (502, "word " * 30_000, "s0")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    found = pack(df).collect()
    assert check(tokenizer, rows, found) == -(-sum(r.length for r in found) // WINDOW)


def test_windows_follow_the_targets(spark):
    rows = [(i, "word " * 3000, "ab"[i % 2]) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = pack(df, targets={"a": 3.0, "b": 1.0}).collect()
    tokens = defaultdict(Counter)
    for r in found:
        tokens[r.sequence_id][r.source] += r.length
    # Source a ends first; until then every window holds three quarters of it, give or take one granule.
    last_of_a = max(r.sequence_id for r in found if r.source == "a" and r.round is not None)
    for s in range(last_of_a - 1):
        assert abs(tokens[s]["a"] - 3 * tokens[s]["b"]) <= 4 * GRANULE
    total = Counter()
    for s in range(last_of_a - 1):
        total.update(tokens[s])
        assert abs(total["a"] - 0.75 * sum(total.values())) <= GRANULE
    assert all(r.deficit is None or 0 <= r.deficit < GRANULE for r in found)


def test_repeated_rows_and_empty_table(spark):
    schema = "doc_id bigint, text string, source string, lang string, slot bigint"
    assert pack(spark.createDataFrame([], schema)).count() == 0
    df = spark.createDataFrame([(1, "one two", "s", "en", 1)] * 3 + [(None, "x", None, None, None)], schema)
    found = pack(df).collect()
    assert Counter(r.doc_id for r in found if r.start == 0) == {1: 3, None: 1}


def test_ids_of_all_documents_are_those_of_the_tokenizer(spark, tokenizer):
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    for text, wanted in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert encoder().encode(text, allowed_special="all") == wanted.ids


def round_robin(queues):
    """(source, slot, round, deficit) in the order of sending, queue by queue and round by round."""
    out, rounds = [], 0
    for phase in (0, 1):
        mine = [q for q in queues if q.phase == phase]
        left, deficit, r = {q.name: q.slots for q in mine}, {q.name: Fraction(0) for q in mine}, 0
        while any(left.values()):
            r += 1
            for q in sorted(mine, key=lambda q: q.name):
                if left[q.name]:
                    deficit[q.name] += Fraction(GRANULE * q.weight, q.largest)
                    if deficit[q.name] >= GRANULE:
                        deficit[q.name] -= GRANULE
                        out.append((q.name, q.slots - left[q.name], rounds + r, float(deficit[q.name])))
                        left[q.name] -= 1
        rounds += r
    return out


@pytest.mark.parametrize(
    "targets",
    [None, {}, {"a": 3.0, "b": 1.0}, {"a": 1.0, "b": 0.0}, {"a": 0.0, "b": 0.0, "c": 0.0, "": 0.0}, {"a": 0.3, "b": 0.7, "c": 0.11, "": 0.0}, {"z": 5.0}],
)
def test_slots_are_those_of_a_round_robin(spark, targets):
    sizes = {"a": 3000, "b": 700, "c": 1900, "": 900, "tiny": 3}
    rows = [(i, "word " * (n // 4), q or None) for q, n in sizes.items() for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    found = pack(df, targets=targets).collect()
    slots = Counter()
    for r in found:
        slots[r.source] += r.length
    queues = queues_of({q: n // GRANULE for q, n in slots.items()}, targets)
    sent = {}
    for r in found:
        if r.round is not None:
            slot = (r.sequence_id * WINDOW + r.offset) // GRANULE
            assert sent.setdefault(slot, (r.source, r.round, r.deficit)) == (r.source, r.round, r.deficit)
    wanted = [(q, r, pytest.approx(d)) for q, _, r, d in round_robin(queues)]
    assert [sent[i] for i in range(len(sent))] == wanted
    if targets == {"a": 1.0, "b": 0.0}:
        others = max(r.round for r in found if r.round and r.source != "b")
        assert min(r.round for r in found if r.round and r.source == "b") == others + 1


def test_shares_must_be_numbers(spark):
    df = spark.createDataFrame([(1, "x", "a")], "doc_id bigint, text string, source string")
    for bad in (-1.0, float("nan"), float("inf")):
        with pytest.raises(ValueError, match="shares"):
            pack(df, targets={"a": bad})
