"""SimHash near-duplicates: fingerprints linked at a small Hamming distance through BK-trees.

The 64 bits are cut into four blocks. Fingerprints at distance two or less agree in at least two blocks, so each fingerprint goes
to six shards, one per pair of blocks and their value. A shard's fingerprints form a BK-tree, whose children are
keyed by their distance to the parent; a search follows only edges within the radius of the distance met. The
trees live where their shard is: copies of all of them would not fit every executor at scale.
A shard of over ``SHARD_LIMIT`` fingerprints is split likewise by its other bits: four blocks of these, and each fingerprint in the six
shards of their pairs, until a shard fits or only ``LEAST_BITS`` bits are left, which are 256 different fingerprints at most.
A shard reports its linked groups as stars around their smallest member, so output is linear in the
shard. Components come from star contraction.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.llm.common import query, stored, table, texts
from tidepanel.sources.scratch import materialise

RADIUS = 2
BITS = 64
LEAST_BITS = 8
SHARD_LIMIT = 1000
TASK_LINKS = 50_000  # links that a task of the contraction gets at least
SEED = 42


def shingle_hashes(text: str, width: int) -> np.ndarray:
    """XXH64 of every run of ``width`` words; of the whole sequence if there are fewer words."""
    import xxhash

    words = text.encode().lower().split()  # of bytes: lowers A-Z, splits at the six ASCII blanks only
    if len(words) <= width:
        runs = [b" ".join(words)] if words else []
    else:
        runs = map(b" ".join, zip(*[words[i:] for i in range(width)]))
    return np.fromiter((xxhash.xxh64_intdigest(r, SEED) for r in runs), np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Signed 64-bit number whose bit is 1 where it is in over half the hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at : at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, tie, fp) of every row, tie being a hash of the text; null and empty texts have fingerprint zero."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in texts(batches, "text"):
            found = pa.array([fingerprint(shingle_hashes(t, width)) for t in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("tie"), found], ["doc_id", "tie", "fp"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("tie"), "text")
    return rows.mapInArrow(compute, "doc_id bigint, tie bigint, fp bigint")


def linked_groups(values: list[int], radius: int) -> list[tuple[int, int]]:
    """(value, smallest value of its group) for the groups a BK-tree search links; lone values are left out."""
    nodes: list[tuple[int, dict[int, int]]] = []
    parent = list(range(len(values)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, value in enumerate(values):
        todo = [0] if nodes else []
        while todo:
            at = todo.pop()
            other, children = nodes[at]
            distance = (value ^ other).bit_count()
            if distance <= radius:
                a, b = sorted((root(i), root(at)))
                parent[b] = a
            todo += [c for d, c in children.items() if abs(d - distance) <= radius]
        at = 0
        while nodes:
            other, children = nodes[at]
            distance = (value ^ other).bit_count()
            if distance not in children:
                children[distance] = i
                break
            at = children[distance]
        nodes.append((value, {}))
    return [(v, values[r]) for i, v in enumerate(values) if (r := root(i)) != i]


def _tree_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each shard; rows come sorted by (shard, fp), a shard may go over several batches."""

    def links(fps: np.ndarray, cuts: np.ndarray) -> Iterator[tuple[int, int]]:
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b - a > 1:
                # Unsigned for the distances; sorted as signed, so that the first is the smallest.
                found = linked_groups([int(v) & (2**64 - 1) for v in fps[a:b]], RADIUS)
                yield from ((v - (v >> 63 << 64), r - (r >> 63 << 64)) for v, r in found)

    kept_shards, kept_fps = np.empty(0, np.int64), np.empty(0, np.int64)
    for batch in _then_none(batches):
        if batch is not None:
            kept_shards = np.concatenate([kept_shards, batch.column("shard").to_numpy(zero_copy_only=False)])
            kept_fps = np.concatenate([kept_fps, batch.column("fp").to_numpy(zero_copy_only=False)])
        starts = np.flatnonzero(np.r_[True, kept_shards[1:] != kept_shards[:-1]]) if len(kept_shards) else np.empty(0, int)
        cuts = starts if batch is not None else np.r_[starts, len(kept_shards)]
        found = list(links(kept_fps, cuts)) if len(cuts) > 1 else []
        if len(cuts):
            kept_shards, kept_fps = kept_shards[cuts[-1] :], kept_fps[cuts[-1] :]
        yield pa.RecordBatch.from_arrays(
            [pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], ["a", "b"]
        )


def _then_none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _signed(v: int) -> int:
    return v - (v >> 63 << 64)


def finer(mask: int) -> list[int]:
    """Masks of the bits that members of a shard's parts agree in: those of ``mask`` and two of four blocks of the others."""
    rest = [i for i in range(BITS) if not mask >> i & 1]
    n = len(rest) // 4
    blocks = [sum(1 << i for i in rest[k * n : (k + 1) * n]) for k in range(4)]
    return [mask | a | b for a, b in combinations(blocks, 2)]


def links(fps: DataFrame, shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within the radius, a star per group of a shard."""
    masks, left = finer(0), BITS // 2
    children = F.array(*[F.lit(_signed(m)) for m in masks])
    members = fps.select("fp", F.explode(children).alias("mask"))
    shards: list[DataFrame] = []
    while True:
        members = members.withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = materialise(members.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
        last = left <= LEAST_BITS
        fit = sizes if last else sizes.where(F.col("n") <= shard_limit)
        shards.append(members.join(fit, ["mask", "value"], "left_semi").select(F.xxhash64("mask", "value").alias("shard"), "fp"))
        large = sizes.where(F.col("n") > shard_limit)
        if last or large.isEmpty():
            break
        parts = F.create_map(*[c for m in masks for c in (F.lit(_signed(m)), F.array(*[F.lit(_signed(x)) for x in finer(m)]))])
        chosen = members.join(large, ["mask", "value"], "left_semi")
        members = chosen.select("fp", F.explode(parts[F.col("mask")]).alias("mask")).distinct()
        masks, left = sorted({x for m in masks for x in finer(m)}), left // 2
    dealt = reduce(DataFrame.unionByName, shards).repartition("shard").sortWithinPartitions("shard", "fp")
    return dealt.mapInArrow(_tree_links, "a bigint, b bigint").where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links, root being the component's smallest node.

    Alternates large-star and small-star contraction; each round is written to the shared folder. Minima are pre-aggregated
    and joined back, so a node with very many links is not gathered in one task. A round has no more tasks than its links need: every task
    of an exchange leaves files until the driver collects its garbage, and the rounds are many.
    """

    def star(pairs: DataFrame, tasks: int) -> DataFrame:
        low = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return pairs.join(low, "u").coalesce(tasks)

    def state(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    before, pairs = None, materialise(pairs)
    while (now := state(pairs)) != before:
        before, tasks = now, max(1, -(-now[0] // TASK_LINKS))
        pairs = pairs.coalesce(tasks)
        both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            pairs.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        large = star(both, tasks).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        down = star(large.coalesce(tasks).select(F.col("a").alias("u"), F.col("b").alias("v")), tasks)
        small = down.select(F.explode(F.array("u", "v")).alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        pairs = materialise(small.coalesce(tasks))
    roots = pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _groups(docs: DataFrame, width: int, shard_limit: int) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of all rows, and (fp, root, lowest) of the distinct ones."""
    rows = stored(fingerprints(docs, width), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("lowest"))
    roots = components(links(nodes.select("fp"), shard_limit))
    named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return rows, named.withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, *, width: int = 3, shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs`` (doc_id, text).

    Null and empty texts and texts of blanks have fingerprint zero and are linked like any others. component_id is the
    smallest id of the rows reachable over links, null only if none of them has an id. Repeated rows share their
    component. An empty table gives no rows; other columns are ignored.
    """
    rows, named = _groups(docs, width, shard_limit)
    ids = named.groupBy("root").agg(F.min("lowest").alias("component_id"))
    by_fp = named.join(ids, "root").select("fp", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return rows.join(by_fp, "fp").select("doc_id", hexed, "component_id")


@query()
def op5_simhash_components(spark: SparkSession, d: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return near_duplicates(table(spark, d, "documents"))
