"""Mixture-controlled packing: deficit round-robin over source queues fills token windows.

Documents are tokenised once and cut into pieces: granules of ``GRANULE`` tokens, and the binary expansion of what
remains (128, 64, .. 1 tokens). A source's queue holds its granules, then its smaller pieces by falling size, so every
piece starts at a multiple of its own size and never crosses a slot of one granule. Token ids are
reduced to one checksum per piece inside the tokenising task; they are neither stored nor shuffled.

Round r adds the quantum ``GRANULE * weight / largest weight`` to the deficit of each source; a source whose deficit
reaches a granule sends one slot and keeps the rest. Slot k of a source therefore leaves in round
ceil((k + 1) * largest weight / weight), whatever window or partition that falls into, and by the end of round r a source has sent
floor(r * weight / largest weight) slots or all it has. Each piece adds these up over the sources, in whole numbers, and so knows its own
place: there is no running state and no table of slots. Slots in order of (round, source) fill
the windows, without gaps. Sources with a share of 0 wait until the others end. The last, incomplete slots of all sources
follow by falling size of their pieces; only the very last window can be short.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepanel.llm.common import query, stored, table, texts

WINDOW = 2048
GRANULE = 256
END_ID = 1
WEIGHTS = 2**20  # of the largest share: shares as whole numbers
TOKENIZER = "byte_bpe_50k"

PIECES = "doc_id bigint, queue string, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, chunk bigint, at bigint"


@functools.cache
def encoder(name: str = TOKENIZER):
    """Encoder of a public byte-level vocabulary.

    The vocabulary of ``<name>.json`` read from its rank file: same ids as the tokenizers library gives (a test
    compares them, the end-of-text marker included), at five times its speed.
    """
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    marker = {"<|endoftext|>": len(ranks)}
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=marker)


def cuts(n: int) -> list[int]:
    """Piece lengths of a document of n tokens: whole granules, then its remainder's powers of two, falling."""
    rest = n % GRANULE
    return [GRANULE] * (n // GRANULE) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces with their checksum, their task and their place among the task's pieces of that queue and size."""
    import numpy as np

    encode, chunk, counts = encoder().encode, TaskContext.get().partitionId(), {}
    for part, docs in texts(batches, "text"):
        columns: list[list] = [[] for _ in range(8)]
        for doc_id, queue, text in zip(part.column("doc_id").to_pylist(), part.column("queue").to_pylist(), docs):
            ids = np.array([*encode(text, allowed_special="all"), END_ID], dtype="<u4")
            raw, n, start = memoryview(ids.tobytes()), len(ids), 0
            for length in cuts(n):
                crc = zlib.crc32(raw[4 * start : 4 * (start + length)])
                at = counts[queue, length] = counts.get((queue, length), -1) + 1
                for column, value in zip(columns, (doc_id, queue, start, length, crc, n, chunk, at)):
                    column.append(value)
                start += length
        kinds = (pa.int64(), pa.string(), *[pa.int64()] * 6)
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in PIECES.split(", ")])


@dataclass(frozen=True)
class Queue:
    """A source's slots; ``weight`` of ``largest`` is its share of a round. Queues of a later phase wait for the earlier ones."""

    name: str
    slots: int
    phase: int
    weight: int
    largest: int

    def round(self, k: int) -> int:
        """In which slot k leaves, counted from 1 in its phase."""
        return -(-(k + 1) * self.largest // self.weight)


def queues_of(slots: Mapping[str, int], targets: Mapping[str, float] | None) -> list[Queue]:
    """Queues by name. Shares are the queues' sizes, or the targets; a source without a target gets the smallest one above 0."""
    if targets is not None and any(not 0 <= v < math.inf for v in targets.values()):
        raise ValueError(f"shares must be numbers from 0 on: {dict(targets)}")
    low = min((v for v in (targets or {}).values() if v > 0), default=1.0)
    share = {q: float(n) if targets is None else float(targets.get(q, low)) for q, n in slots.items()}
    most = max(share.values(), default=0.0)
    out = []
    for q in sorted(slots):
        first = share[q] > 0 or not most
        weight = max(1, round(share[q] / most * WEIGHTS)) if share[q] > 0 else 1
        out.append(Queue(q, slots[q], 0 if first else 1, weight, WEIGHTS if share[q] > 0 else 1))
    return out


def pack(docs: DataFrame, *, targets: Mapping[str, float] | None = None) -> DataFrame:
    """Pieces of all documents with ``sequence_id`` and ``offset`` in windows of ``WINDOW`` tokens.

    ``docs`` needs doc_id, text and source. ``targets`` gives token shares by source; a source without a share gets the
    smallest one above 0, one with a share of 0 waits until the others end. By default the shares are the sources' sizes, so all queues
    end together. A queue that ends early leaves its place to the others. A null text is empty and yields its end token; a null source shares
    the queue of the empty name; repeated rows and ids are packed row by row. Texts of any length are tokenised whole and cut into pieces. Slots of one
    round go by source; pieces of equal size in a queue go in the order of their tasks and rows. An empty table gives no rows. The list of
    sources, a row each, is read by the driver.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("source", F.lit("")).alias("queue"), "text"
    )
    pieces = stored(rows.mapInArrow(_pieces, PIECES), "pieces")

    # Start of each task's pieces in their queue: running sums over a small table of (queue, size, task).
    counts = pieces.groupBy("queue", "length", "chunk").agg(F.count(F.lit(1)).alias("n"))
    counts = stored(counts, "piece_counts")
    along = Window.partitionBy("queue").orderBy(F.desc("length"), "chunk")
    starts = counts.select(
        "queue", "length", "chunk", (F.sum(F.col("n") * F.col("length")).over(along) - F.col("n") * F.col("length")).alias("before")
    )
    sizes = counts.groupBy("queue").agg(F.floor(F.sum(F.col("n") * F.col("length")) / GRANULE).cast("bigint").alias("slots"))
    queues = queues_of({r.queue: r.slots for r in sizes.toLocalIterator()}, targets)

    placed = pieces.join(starts, ["queue", "length", "chunk"]).withColumn(
        "queue_at", F.col("before") + F.col("at") * F.col("length")
    )
    placed = placed.withColumn("k", F.floor(F.col("queue_at") / GRANULE))
    placed = _with_slots(placed, queues)
    whole = placed.where("k < slots").withColumn("position", F.col("slot") * GRANULE + F.col("queue_at") % GRANULE)

    # Fewer than GRANULE tokens a source remain: by falling size again, so that they stay aligned.
    tail = placed.where("k >= slots")
    falling = Window.orderBy(F.desc("length"), "queue")
    ends = tail.groupBy("queue", "length").agg(F.min("queue_at").alias("first_at"), F.count(F.lit(1)).alias("n"))
    ends = ends.withColumn("tail_at", F.sum(F.col("n") * F.col("length")).over(falling) - F.col("n") * F.col("length"))
    tail = tail.join(ends.select("queue", "length", "first_at", "tail_at"), ["queue", "length"]).withColumn(
        "position", F.lit(sum(q.slots for q in queues) * GRANULE) + F.col("tail_at") + F.col("queue_at") - F.col("first_at")
    )
    tail = tail.withColumns({"round": F.lit(None).cast("bigint"), "deficit": F.lit(None).cast("double")})
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "queue", "round", "deficit", "position"]
    return whole.select(columns).unionByName(tail.select(columns)).select(
        *columns[:5],
        F.floor(F.col("position") / WINDOW).alias("sequence_id"),
        (F.col("position") % WINDOW).alias("offset"),
        F.col("queue").alias("source"),
        "round",
        "deficit",
    )


def _with_slots(placed: DataFrame, queues: list[Queue]) -> DataFrame:
    """Rows (queue, k) with the queue's slots, and the round, the slot in the output and the deficit that the queue keeps after sending it."""
    rounds = max((q.round(q.slots - 1) for q in queues if not q.phase and q.slots), default=0)
    earlier = sum(q.slots for q in queues if not q.phase)
    schema = "queue string, slots bigint, phase int, weight bigint, largest bigint"
    own = placed.sparkSession.createDataFrame([(q.name, q.slots, q.phase, q.weight, q.largest) for q in queues], schema)
    out = placed.join(F.broadcast(own), "queue")  # a row a source
    out = out.withColumn("_round", F.expr("((k + 1) * largest + weight - 1) div weight"))
    sent = []
    for phase in (0, 1):
        terms = []
        for q in (q for q in queues if q.phase == phase and q.slots):
            by_then = F.least(F.lit(q.slots), F.expr(f"((_round - 1) * {q.weight}L) div {q.largest}L"))
            with_it = F.least(F.lit(q.slots), F.expr(f"(_round * {q.weight}L) div {q.largest}L"))
            terms.append(F.when(F.lit(q.name) < F.col("queue"), with_it).otherwise(by_then))
        sent.append(_sum(terms) + (earlier if phase else 0))
    deficit = F.greatest(F.lit(0).cast("bigint"), F.expr("_round * weight - (k + 1) * largest")) * F.lit(float(GRANULE)) / F.col("largest")
    added = {"slot": F.when(F.col("phase") == 0, sent[0]).otherwise(sent[1]), "deficit": deficit}
    added["round"] = F.col("_round") + F.when(F.col("phase") == 1, rounds).otherwise(0)
    return out.withColumns(added).drop("_round", "phase", "weight", "largest")


def _sum(terms: list[Column]) -> Column:
    """A sum as a balanced tree, so that many sources do not make a deep expression."""
    if len(terms) < 2:
        return terms[0] if terms else F.lit(0).cast("bigint")
    half = len(terms) // 2
    return _sum(terms[:half]) + _sum(terms[half:])


@query()
def op3_mixture_packing(spark: SparkSession, d: str) -> DataFrame:
    """All documents in windows of 2,048 tokens, mixed by source."""
    return pack(table(spark, d, "documents"))
