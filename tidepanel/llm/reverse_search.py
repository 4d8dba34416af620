"""Ranked lexical search, reversed: the searching items are indexed, the documents stream through.

The index maps each term to the items that hold it and goes to the tasks in blocks of bounded size. A document's term counts are
looked up in it, which gives its score for every item that shares a term; each task keeps a heap of the best documents for
each item, and the heaps are merged by a grouped limit, first within some of the tasks, then over all.

Term counts come first: one pass over the texts counts the index's terms in each document and writes them, so that document
frequencies and lengths, which the scores need, are known before the second pass reads the counts only.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepanel.llm.common import n_bytes, query, stored, table

BEST = 10
BLOCK_BYTES = 4 * 2**20  # of item texts in an index
MERGE_GROUPS = 64  # groups of tasks whose heaps are merged first
_PIECE = 2**20
_NULL_ID = 2**63 - 1
_SCORES = 2**21  # scores and postings held at once
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_BETWEEN = re.compile(rb"[^0-9a-z\x80-\xff]")


def term_counts(text: str | None) -> Counter:
    """Occurrences of each term (UTF-8 bytes, A-Z lowered) of a text; long texts go in pieces that end between terms."""
    data = (text or "").encode().lower()  # of bytes, lower() changes A-Z only
    found: Counter = Counter()
    at = 0
    while at < len(data):
        edge = _BETWEEN.search(data, at + _PIECE)
        end = edge.start() if edge else len(data)
        found.update(_TERM.findall(data, at, end))
        at = end
    return found


@dataclass(frozen=True)
class ItemIndex:
    """Terms of a block of items, and by term the places of its items: those of term t are postings[starts[t]:starts[t + 1]]."""

    terms: dict[bytes, int]
    starts: np.ndarray
    postings: np.ndarray
    item_ids: list


def build_index(rows: list[tuple[object, str | None]]) -> ItemIndex:
    """Index of (item id, text) rows; rows of one id are one item."""
    held: dict[object, set[bytes]] = {}
    for name, text in rows:
        held.setdefault(name, set()).update(term_counts(text))
    item_ids = sorted(held, key=lambda x: (x is None, x))
    by_term: dict[bytes, list[int]] = {}
    for place, name in enumerate(item_ids):
        for term in held[name]:
            by_term.setdefault(term, []).append(place)
    order = sorted(by_term)
    sizes = [len(by_term[t]) for t in order]
    postings = np.array([p for t in order for p in by_term[t]], np.int64)
    return ItemIndex({t: i for i, t in enumerate(order)}, np.r_[0, np.cumsum(sizes)].astype(np.int64), postings, item_ids)


def weight(n: int, df: int) -> int:
    """Of a term that ``df`` of ``n`` documents hold."""
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


class Heaps:
    """The best documents for each item: higher score first, then smaller id, null ids last."""

    def __init__(self, items: int, best: int):
        self.best, self.held = best, [[] for _ in range(items)]
        self.score, self.key = np.zeros(items, np.int64), np.full(items, _NULL_ID)  # of the last of a full heap

    def offer(self, items: np.ndarray, scores: np.ndarray, keys: np.ndarray) -> None:
        """Documents of positive scores, one for each place; ids as keys, null as the largest number."""
        good = (scores > self.score[items]) | ((scores == self.score[items]) & (keys < self.key[items]))
        for i, s, k in zip(items[good].tolist(), scores[good].tolist(), keys[good].tolist()):
            heap = self.held[i]
            if len(heap) < self.best:
                heapq.heappush(heap, (s, -k))
            else:
                heapq.heappushpop(heap, (s, -k))
            if len(heap) == self.best:
                self.score[i], self.key[i] = heap[0][0], -heap[0][1]


def score_batch(index: ItemIndex, weights: np.ndarray, lengths: np.ndarray, firsts: np.ndarray, terms: np.ndarray, tf: np.ndarray, n: int, total: int) -> np.ndarray:
    """Scores (documents x items) of documents whose term numbers and counts lie at ``firsts[i]:firsts[i + 1]``."""
    items = len(index.item_ids)
    m = np.array([10 + (90 * x * n) // total for x in lengths.tolist()], np.int64)
    owner = np.repeat(np.arange(len(lengths)), np.diff(firsts))
    gained = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[owner]))
    sizes = index.starts[terms + 1] - index.starts[terms]
    # The postings of every term, one after another.
    places = np.arange(int(sizes.sum())) + np.repeat(index.starts[terms] - np.r_[0, np.cumsum(sizes)[:-1]], sizes)
    cells = np.repeat(owner * items, sizes) + index.postings[places]
    out = np.zeros(len(lengths) * items, np.int64)
    np.add.at(out, cells, np.repeat(gained, sizes))  # whole numbers, no rounding
    return out.reshape(len(lengths), items)


def _counted(docs: DataFrame, index) -> DataFrame:
    """(doc_id, n, terms, tf): documents that have terms, with those of the index."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index.value.terms
        for batch in batches:
            ids, sizes, firsts, terms, tf = [], [], [0], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                found = term_counts(text.as_py())
                if found:
                    shared = known.keys() & found.keys()
                    ids.append(doc_id)
                    sizes.append(found.total())
                    terms += [known[t] for t in shared]
                    tf += [found[t] for t in shared]
                    firsts.append(len(terms))
            arrays = [
                pa.array(ids, pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), pa.array(terms, pa.int32())),
                pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), pa.array(tf, pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "terms", "tf"])

    return docs.mapInArrow(count, "doc_id bigint, n bigint, terms array<int>, tf array<bigint>")


def _frequencies(counts: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each term of the index."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], ["term", "df"])

    out = np.zeros(size, np.int64)
    held = counts.select("terms").mapInArrow(add, "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    for r in held.toLocalIterator():  # a row for each term of a block
        out[r.term] = r.df
    return out


def _best_of_tasks(counts: DataFrame, shared, n: int, total: int, best: int) -> DataFrame:
    """(item, task, doc_id, score): the heap of each item in each task."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        index, weights = shared.value
        heaps = Heaps(len(index.item_ids), best)
        for batch in batches:
            lists = batch.column("terms")
            firsts = lists.offsets.to_numpy().astype(np.int64)
            terms, tf = lists.values.to_numpy(), batch.column("tf").values.to_numpy()
            lengths = batch.column("n").to_numpy()
            keys = batch.column("doc_id").fill_null(_NULL_ID).to_numpy()
            # So many documents that their scores and postings stay small.
            found_in = np.r_[0, np.cumsum(index.starts[terms + 1] - index.starts[terms])]
            load = np.cumsum(np.diff(found_in[firsts]) + len(index.item_ids))
            cuts = np.searchsorted(load, np.arange(0, load[-1] + _SCORES, _SCORES)) if len(load) else []
            for a, b in zip(cuts, [*cuts[1:], batch.num_rows]):
                if a == b:
                    continue
                held = slice(firsts[a], firsts[b])
                found = score_batch(index, weights, lengths[a:b], firsts[a : b + 1] - firsts[a], terms[held], tf[held], n, total)
                at = np.flatnonzero((found > 0) & (found >= heaps.score))
                doc, item = np.divmod(at, len(index.item_ids))
                heaps.offer(item, found.ravel()[at], keys[a:b][doc])
        rows = [(i, s, -k) for i, heap in enumerate(heaps.held) for s, k in heap]
        items, scores, keys = (np.array(c, np.int64) for c in zip(*rows)) if rows else [np.empty(0, np.int64)] * 3
        task = np.full(len(items), TaskContext.get().partitionId())
        ids = pa.array(keys, pa.int64(), mask=keys == _NULL_ID)
        yield pa.RecordBatch.from_arrays([pa.array(items), pa.array(task), ids, pa.array(scores)], ["item", "task", "doc_id", "score"])

    return counts.mapInArrow(search, "item bigint, task bigint, doc_id bigint, score bigint")


def reverse_search(docs: DataFrame, items: DataFrame, *, best: int = BEST, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``best`` documents of positive score for each item.

    ``docs`` has doc_id (whole number) and text, ``items`` item_id and text. Null and empty texts have no terms: such documents are not
    counted, such items find nothing. Repeated rows of ``docs`` are documents of their own, with ranks of their own; a null doc_id comes
    last among equal scores. Rows of ``items`` with one id are one item, a null id is an id. Texts are read whole, in pieces. An empty
    table on either side gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType
    rows = stored(items.select("item_id", "text").distinct(), "search_items")
    size = n_bytes() + 64
    total = rows.agg(F.sum(size)).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    # By id, so that an item is in one block; ids are dealt anew while a block is too large and can be split.
    while blocks > 1:
        dealt = rows.groupBy("item_id").agg(F.sum(size).alias("n")).groupBy(F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
        worst = dealt.agg(F.sum("n").alias("n"), F.max("n").alias("one")).agg(F.max(F.col("n") - F.col("one"))).first()[0]
        if worst <= 2 * block_bytes:
            break
        blocks *= 2
    counted = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    out: DataFrame | None = None
    for b in range(blocks):
        block = rows.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        index = build_index([(r.item_id, r.text) for r in block.toLocalIterator()])  # bounded by block_bytes
        if not index.terms:
            continue
        counts = stored(_counted(counted, spark.sparkContext.broadcast(index)), "term_counts")
        n, length = counts.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n:
            break
        weights = np.array([weight(n, df) for df in _frequencies(counts, len(index.terms)).tolist()], np.int64)
        found = _best_of_tasks(counts, spark.sparkContext.broadcast((index, weights)), n, length, best)
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        group = F.pmod(F.col("task"), F.lit(MERGE_GROUPS))
        merged = found.withColumn("rank", F.row_number().over(Window.partitionBy("item", group).orderBy(*order)))
        merged = merged.where(F.col("rank") <= best)
        merged = merged.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
        merged = merged.where(F.col("rank") <= best)
        names = spark.createDataFrame(list(enumerate(index.item_ids)), f"item bigint, item_id {kind.simpleString()}")
        part = stored(merged.join(names, "item").select("item_id", "rank", "doc_id", "score"), "search_results")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id bigint, score bigint")
    return out


_TERMS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@query(
    f"""WITH d AS (SELECT doc_id, {_TERMS.format("coalesce(text, '')")} AS w FROM documents),
stats AS (SELECT count(*) AS n, CAST(sum(len(w)) AS bigint) AS l FROM d WHERE len(w) > 0),
it AS (SELECT DISTINCT item_id, unnest({_TERMS.format("coalesce(text, '')")}) AS t FROM benchmark),
tf AS (SELECT doc_id, len, t, count(*) AS tf FROM (SELECT doc_id, CAST(len(w) AS bigint) AS len, unnest(w) AS t FROM d)
  WHERE t IN (SELECT t FROM it) GROUP BY 1, 2, 3),
w AS (SELECT t, CAST(floor(1000 * ln((2 * (SELECT n FROM stats) + 2) / (2 * count(*) + 1))) AS bigint) AS w FROM tf GROUP BY 1),
s AS (SELECT item_id, doc_id,
  CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * len * (SELECT n FROM stats)) // (SELECT l FROM stats))))) AS bigint) AS score
  FROM tf JOIN w USING (t) JOIN it USING (t) GROUP BY 1, 2)
SELECT item_id, CAST(rank AS int) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= {BEST}"""
)
def op11_reverse_search(spark: SparkSession, d: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return reverse_search(table(spark, d, "documents"), table(spark, d, "benchmark"))
