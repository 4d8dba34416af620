"""Benchmark decontamination: test suffixes looked up in suffix arrays of the training texts.

A shard is a slice of documents inside a task. Its words are hashed in numpy and replaced by their number in the test vocabulary.
Only suffixes that start with enough consecutive test words can match; they are sorted to the window's length,
which gives the shard's sparse suffix array. Every test suffix is then found in it by binary search. Matches are
confirmed on the words themselves, and neighbouring ones on the same diagonal join into the longest verbatim match.

The test table is measured first and goes to the tasks in blocks of bounded size, one pass over the documents each.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepanel.llm.common import n_bytes, query, stored, table, texts

WINDOW = 10
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK_BYTES = 16 * 2**20
_FACTOR = 0x9E3779B97F4A7C15  # odd, so it can be inverted modulo 2^64
_LETTER = np.zeros(256, np.uint8)
_LETTER[list(b"0123456789abcdefghijklmnopqrstuvwxyz") + list(range(0x80, 0x100))] = 1
_LETTER[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = 1
_CODE = np.arange(256, dtype=np.uint64)
_CODE[0x41:0x5B] += np.uint64(0x20)
_CODE = (_CODE + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
_CODE ^= _CODE >> np.uint64(29)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the factor and of its inverse."""
    if len(_POWERS.get("up", ())) < n:
        for name, x in (("up", _FACTOR), ("down", pow(_FACTOR, -1, 2**64))):
            out = np.full(n, x, np.uint64)
            out[0] = 1
            _POWERS[name] = np.cumprod(out)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def words_of(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word in UTF-8 bytes, and its hash (A-Z lowered)."""
    raw = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = _LETTER[raw]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    up, down = _powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_CODE[raw] * up[: len(raw)], out=total[1:])
    return starts, ends, (total[ends] - total[starts]) * down[starts]


@dataclass(frozen=True)
class TestIndex:
    """Windows of a block of test items over a numbered vocabulary, ready for binary search."""

    hashes: np.ndarray  # sorted hashes of the vocabulary
    vocabulary: list[bytes]
    shortest: np.ndarray  # by word: length of the shortest window it starts
    windows: np.ndarray  # distinct windows: word numbers from 1, 0 beyond the end
    lengths: np.ndarray
    items: list[list[int]]  # by window: places in item_ids
    item_ids: list[str]


def build_index(rows: list[tuple[str, str]], window: int = WINDOW) -> TestIndex:
    """Index of (item id, text) rows; a text of fewer words than the window is one window."""
    item_ids = sorted({i for i, _ in rows})
    place = {name: n for n, name in enumerate(item_ids)}
    words, owners = {}, []
    for name, text in rows:
        data = (text or "").encode()
        starts, ends, hashes = words_of(data)
        for a, b, h in zip(starts.tolist(), ends.tolist(), hashes.tolist()):
            words[h] = data[a:b].lower()
        owners.append((place[name], hashes))
    known = np.array(sorted(words), np.uint64)
    grams: dict[tuple[int, ...], set[int]] = {}
    for item, hashes in owners:
        numbers = (np.searchsorted(known, hashes) + 1).tolist()
        n = min(window, len(numbers))
        for i in range(len(numbers) - n + 1 if n else 0):
            grams.setdefault(tuple(numbers[i : i + n]), set()).add(item)
    shortest = np.full(len(known), window + 1)
    for g in grams:
        shortest[g[0] - 1] = min(shortest[g[0] - 1], len(g))
    order = sorted(grams)
    windows = np.zeros((len(order), window), np.int32)
    for i, g in enumerate(order):
        windows[i, : len(g)] = g
    lengths = np.array([len(g) for g in order], np.int64)
    return TestIndex(known, [words[h] for h in known.tolist()], shortest, windows, lengths, [sorted(grams[g]) for g in order], item_ids)


def _sortable(rows: np.ndarray, fill: int = 0) -> np.ndarray:
    """Rows of numbers as byte strings of the same order."""
    out = np.ascontiguousarray(rows.astype(">u4"))
    return out.view(f"S{4 * rows.shape[1]}").ravel()


def search(index: TestIndex, docs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For a shard: the first word of each document (one more at the end), and by match: word place, window, document."""
    data = b"\0".join(docs)
    starts, ends, hashes = words_of(data)
    sizes = np.array([len(x) + 1 for x in docs], np.int64)
    first = np.searchsorted(starts, np.r_[0, np.cumsum(sizes)])
    none = np.empty(0, np.int64)
    if not len(starts) or not len(index.windows):
        return first, none, none, none
    width = index.windows.shape[1]
    number = np.searchsorted(index.hashes, hashes)
    number[number == len(index.hashes)] = 0
    known = index.hashes[number] == hashes
    doc_of = np.repeat(np.arange(len(docs)), np.diff(first))
    # Consecutive test words from each word on, within its document.
    n = len(starts)
    stop = np.where(known, n, np.arange(n))
    stop = np.minimum(np.minimum.accumulate(stop[::-1])[::-1], first[doc_of + 1])
    run = stop - np.arange(n)
    at = np.flatnonzero(known & (run >= index.shortest[number]))
    if not len(at):
        return first, none, none, none
    columns = at[:, None] + np.arange(width)
    suffixes = np.where(columns < stop[at][:, None], number[np.minimum(columns, n - 1)] + 1, 0).astype(np.int32)
    keys = _sortable(suffixes)
    order = np.argsort(keys, kind="stable")  # the suffix array, to the depth of the window
    keys = keys[order]
    upper = index.windows.copy().astype(np.int64)
    upper[np.arange(width) >= index.lengths[:, None]] = 2**32 - 1
    low = np.searchsorted(keys, _sortable(index.windows), "left")
    high = np.searchsorted(keys, _sortable(upper), "right")
    found = np.flatnonzero(high > low)
    if not len(found):
        return first, none, none, none
    window = np.repeat(found, (high - low)[found])
    place = np.concatenate([at[order[low[w] : high[w]]] for w in found])
    # Equal hashes are confirmed on the words.
    used = sorted({(p + j, index.windows[w, j] - 1) for p, w in zip(place.tolist(), window.tolist()) for j in range(index.lengths[w])})
    wrong = {p for p, v in used if data[starts[p] : ends[p]].lower() != index.vocabulary[v]}
    if wrong:
        keep = [not wrong.intersection(range(p, p + index.lengths[w])) for p, w in zip(place.tolist(), window.tolist())]
        place, window = place[keep], window[keep]
    return first, place, window, doc_of[place]


def spans(places: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int]]:
    """Union of [place, place + length) as maximal ranges."""
    out: list[list[int]] = []
    for a, b in sorted(zip(places.tolist(), (places + lengths).tolist())):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


MATCHES = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.LongType())),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("longest", T.LongType()),
    ]
)


def _pass(block: DataFrame, rows: DataFrame, others: list[str], window: int) -> DataFrame:
    """``rows`` with the matches of one block of the test table added to those found so far."""
    held = [(r.item_id, r.text) for r in block.toLocalIterator()]  # a block: bounded by BLOCK_BYTES
    shared = rows.sparkSession.sparkContext.broadcast(build_index(held, window))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for part, docs in texts(batches, "text"):
            first, place, which, owner = search(index, [t.encode() for t in docs])
            order = np.argsort(owner, kind="stable")
            ranges = np.searchsorted(owner[order], np.arange(len(docs) + 1))
            earlier = part.column("_found").to_pylist()
            found = []
            for i, before in enumerate(earlier):
                chosen = order[ranges[i] : ranges[i + 1]]
                words, flat, names, longest = int(first[i + 1] - first[i]), [], set(), 0
                if before:
                    flat, names, longest = before["spans"], set(before["items"]), before["longest"]
                if len(chosen):
                    own, windows = place[chosen] - first[i], which[chosen]
                    names |= {index.item_ids[k] for w in set(windows.tolist()) for k in index.items[w]}
                    union = spans(own, index.lengths[windows])
                    longest = max(longest, _longest(index, own, windows))
                    pairs = np.array([*zip(flat[::2], flat[1::2]), *union], np.int64)
                    flat = [x for ab in spans(pairs[:, 0], pairs[:, 1] - pairs[:, 0]) for x in ab]
                found.append({"n_words": words, "spans": flat, "items": sorted(names), "longest": longest})
            kind = pa.struct(
                [("n_words", pa.int64()), ("spans", pa.list_(pa.int64())), ("items", pa.list_(pa.string())), ("longest", pa.int64())]
            )
            arrays = [*[part.column(c) for c in others], pa.array(found, kind)]
            yield pa.RecordBatch.from_arrays(arrays, [*others, "_found"])

    schema = T.StructType([*[rows.schema[c] for c in others], T.StructField("_found", MATCHES)])
    return rows.mapInArrow(find, schema)


def _longest(index: TestIndex, places: np.ndarray, windows: np.ndarray) -> int:
    """Words of the longest run in which each next place holds a window of an item of the one before."""
    best, running = 0, {}
    for p, w in sorted(zip(places.tolist(), windows.tolist())):
        length = int(index.lengths[w])
        for item in index.items[w]:
            last, begun = running.get(item, (-2, p))
            begun = begun if p - last <= 1 else p
            running[item] = (p, begun)
            best = max(best, p + length - begun)
    return best


def _dealt(items: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """``items``, all different, with their _block, and the number of blocks.

    A block has at most twice ``block_bytes``, or that and the longest item: more blocks are tried until all do.
    """
    size = n_bytes() + 64
    total, longest = items.agg(F.sum(size), F.max(size)).first()
    blocks = -(-(total or 0) // block_bytes) or 1
    while True:
        dealt = items.withColumn("_block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
        if blocks == 1 or dealt.groupBy("_block").agg(F.sum(size).alias("n")).agg(F.max("n")).first()[0] <= block_bytes + max(block_bytes, longest):
            return dealt, blocks
        blocks *= 2


def contamination(docs: DataFrame, tests: DataFrame, *, keep: list[str] | None = None, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Columns ``keep`` (default doc_id) of every row of ``docs`` with what it shares with ``tests`` (item_id, text).

    Adds n_words, n_hit (words inside an occurrence of a test window), spans (word ranges hit: start, end, ..), items
    (ids as sorted strings; a null id as the empty one), longest (words of the longest verbatim match) and contaminated.
    Null and empty texts have no words and no windows. Repeated rows are judged alike, test items of one id together.
    An empty test table leaves every document clean. Columns of these names are replaced.
    """
    keep = ["doc_id"] if keep is None else keep
    items = tests.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    items, blocks = _dealt(stored(items.dropDuplicates(["item_id", "text"]), "test_items"), block_bytes)
    others = list(dict.fromkeys([*keep, "text"]))
    rows = docs.select(others).withColumn("_found", F.lit(None).cast(MATCHES))
    for b in range(blocks):
        if b:
            rows = stored(rows, "matches")
        rows = _pass(items.where(F.col("_block") == b), rows, others, window)
    ends = F.expr("aggregate(sequence(0, size(_found.spans) - 1), 0L, (s, i) -> s + if(i % 2 = 0, -1, 1) * _found.spans[i])")
    n_hit = F.when(F.size("_found.spans") > 0, ends).otherwise(F.lit(0).cast("bigint"))
    added = {"n_words": F.col("_found.n_words"), "n_hit": n_hit, "spans": F.col("_found.spans")}
    added |= {"items": F.col("_found.items"), "longest": F.col("_found.longest"), "contaminated": F.size("_found.spans") > 0}
    return rows.withColumns(added).select(*[c for c in keep if c not in added], *added)


def short_items(tests: DataFrame, least_words: int) -> DataFrame:
    """Rows of ``tests`` whose text has words, but fewer than ``least_words``."""
    n = F.size(F.regexp_extract_all("text", F.lit(_WORD), F.lit(0)))
    return tests.where((n > 0) & (n < least_words))


def decontaminate(docs: DataFrame, tests: DataFrame, *, least_words: int = 1) -> DataFrame:
    """Rows of ``docs`` that share a window of ``least_words`` words (at most the window's length) with no item of ``tests``, with all their columns.

    Shorter items remove nothing; a warning names their number, and ``contamination`` reports the documents that have them.
    """
    if least_words > WINDOW:
        raise ValueError(f"a window has {WINDOW} words")
    if least_words > 1:
        short = short_items(tests, least_words)
        if n := short.count():
            names = [str(r.item_id) for r in short.select("item_id").limit(10).collect()]
            warnings.warn(f"{n} test items of fewer than {least_words} words remove no documents: {', '.join(names)}", stacklevel=2)
        n_words = F.coalesce(F.size(F.regexp_extract_all("text", F.lit(_WORD), F.lit(0))), F.lit(0))
        tests = tests.where(n_words >= least_words)
    named = docs.toDF(*[f"c{i}_{c}" for i, c in enumerate(docs.columns)])
    text = named.columns[docs.columns.index("text")]
    found = contamination(named.withColumn("text", F.col(text)), tests, keep=named.columns)
    return found.where(~F.col("contaminated")).select(*[F.col(a).alias(b) for a, b in zip(named.columns, docs.columns)])


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT CAST(item_id AS varchar) AS item, n, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM (SELECT item_id, w, least(len(w), {WINDOW}) AS n FROM b WHERE len(w) > 0), unnest(range(1, len(w) - n + 2)) t(i)),
grams AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM d, (SELECT DISTINCT n FROM win), unnest(range(1, len(w) - n + 2)) t(i)),
m AS (SELECT doc_id, i, n, item FROM grams JOIN win USING (n, k)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS bigint) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)"""
)
def op9_contamination(spark: SparkSession, d: str) -> DataFrame:
    """Words of every document that occur in windows of the benchmark."""
    found = contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )
