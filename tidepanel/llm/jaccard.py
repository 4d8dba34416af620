"""Near duplicates by word shingles: documents whose sets of five-word runs have a Jaccard similarity of 0.8 or more.

First come the SimHash fingerprints of the sets, linked through BK-trees in shards (``simhash``): each set is compared with one hub of
its component. Two bits of 64 find the closest copies only, so what they leave apart goes on.

No pair is missed, because the other candidates come from a prefix filter instead of a sketch: in one order of all shingles, two
sets that are similar enough share a shingle among the first fifth of each. The order puts shingles that are common in a slice
of the documents last, so that passages and license lines seldom select candidates; any order gives the same pairs.

Sets that meet at a shingle are first paired with their neighbour in size and with the first one of similar size, which is linear and
joins most of a large group of copies: each set is compared with one hub of all it is paired with. Then only shingles count whose sets are
still in different components, and pairs of these that can be similar by size and by their places in the order. In some rounds a set picks
a few partners, so that groups without one good hub grow together; at last all pairs that are left go on. A shingle of
very many sets is cut into cells. A large cell holds a bitmap of each set, which bounds what two sets can share: pairs beyond the bound
never leave the cell, and a set picks the partners of the highest bound. Pairs are then bounded by histograms of the shingles, and only
after that compared as texts, each sent once to its hub.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import remove, stored, texts
from tidepanel.llm.simhash import SEED, components, fingerprint
from tidepanel.llm.simhash import links as tree_links

WIDTH = 5
LEAST = (4, 5)  # similarity of 0.8, as a fraction
COMMON_IN_SLICE = 3
COMMON = 200_000
CELL_ROWS = 4_000  # sets of a shingle that are compared in one piece
SMALL_CELL = 32  # rows of a cell whose pairs are all compared at once
BITMAP = 2048  # bits that bound what two sets of a large cell share; larger sets are bounded less closely
HUB_ROWS = 1_000  # texts that go to one copy of a hub
ROUNDS, PICKS = 2, 4  # rounds before all pairs are compared, and partners that a set picks in one
BROADCAST_ROWS = 500_000  # keys are counted; up to so many they are broadcast, beyond that the same join shuffles
_SLICE = 2_000_000
_FACTOR = 0x9E3779B97F4A7C15  # odd, so it can be inverted modulo 2^64
_MIX = np.uint64(0xD6E8FEB86659FD93)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_CODE = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * _MIX
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


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


def shingles(text: str, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; of the whole sequence if there are fewer words."""
    raw = np.frombuffer(text.encode().lower(), np.uint8)  # of bytes, lower() changes A-Z only
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~_BLANK[raw]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = _powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_CODE[raw] * up[: len(raw)], out=total[1:])
    words = _mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    n = min(width, len(words))
    out = np.full(len(words) - n + 1, n, np.uint64)  # shorter sequences differ from longer ones
    for i in range(n):
        out = _mixed(out + words[i : len(words) - n + 1 + i])
    return np.unique(out)


def signature(held: np.ndarray) -> int:
    """Signed 64-bit number of a set of shingles."""
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(held.tobytes(), SEED)).astype(np.int64))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets reach the similarity; two empty ones do."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return LEAST[1] * both >= LEAST[0] * (len(a) + len(b) - both)


def histogram(held: np.ndarray) -> bytes:
    """Counts of shingles by the first bits of their hash, about four in each."""
    bits = max(4, (len(held) // 4).bit_length())
    return np.minimum(np.bincount((held >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8).tobytes()


def may_be_similar(a: bytes, n_a: int, b: bytes, n_b: int) -> bool:
    """False only for sets that cannot reach the similarity: they share no more of a part of the hashes than the smaller count."""
    x, y = (np.frombuffer(h, np.uint8).astype(np.int64) for h in (a, b))
    if x.max() == 255 or y.max() == 255:  # not counted further
        return True
    n = min(len(x), len(y))
    both = int(np.minimum(x.reshape(n, -1).sum(axis=1), y.reshape(n, -1).sum(axis=1)).sum())
    return sum(LEAST) * both >= LEAST[0] * (n_a + n_b)


def bitmap(held: np.ndarray) -> bytes:
    """The bits that the shingles' first bits name."""
    out = np.zeros(BITMAP, np.uint8)
    out[(held >> np.uint64(64 - (BITMAP.bit_length() - 1))).astype(np.int64)] = 1
    return np.packbits(out).tobytes()


def _share_at_most(size_a: int, bits_a: np.ndarray, size_b: np.ndarray, bits_b: np.ndarray) -> np.ndarray:
    """Upper bounds of what a set shares with others: a bit that one has and the other has not is a shingle that they do not share."""
    only_a = np.bitwise_count(bits_a & ~bits_b).sum(axis=1, dtype=np.int64)
    only_b = np.bitwise_count(~bits_a & bits_b).sum(axis=1, dtype=np.int64)
    return np.minimum(size_a - only_a, size_b - only_b)


def common_shingles(docs: DataFrame, width: int = WIDTH) -> np.ndarray:
    """Shingles that come up often within slices of the documents, rarest first; at most ``COMMON``."""

    def often(held: list[np.ndarray]) -> pa.RecordBatch:
        values, n = np.unique(np.concatenate(held), return_counts=True)
        chosen = n >= COMMON_IN_SLICE
        return pa.RecordBatch.from_arrays([pa.array(values[chosen].view(np.int64)), pa.array(n[chosen])], ["token", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, rows in texts(batches, "text"):
            for text in rows:
                held.append(shingles(text, width))
                size += len(held[-1])
                if size > _SLICE:
                    yield often(held)
                    held, size = [], 0
        if held:
            yield often(held)

    counted = docs.select("text").mapInArrow(count, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "token").limit(COMMON).collect()  # COMMON rows
    return np.array([r.token for r in reversed(top)], np.int64).view(np.uint64)


def prefix(held: np.ndarray, common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first shingles of a set, so many that a similar set shares one of them. ``common`` is sorted, ``rank`` its order."""
    n = len(held) - -(-LEAST[0] * len(held) // LEAST[1]) + 1
    if not len(held) or not len(common):
        return held[: n if len(held) else 0]
    at = np.searchsorted(common, held)
    at[at == len(common)] = 0
    known = common[at] == held
    rare = held[~known]
    if len(rare) >= n:
        return rare[:n]
    often = held[known]
    return np.concatenate([rare, often[np.argsort(rank[at[known]])]])[:n]


# Size of a set and place of a shingle in its order, as one number that sorts by size.
def _pack(size: int, places: np.ndarray) -> np.ndarray:
    return (size << 32) + places.astype(np.int64)


def _fits(at_a: np.ndarray, at_b: np.ndarray) -> np.ndarray:
    """Whether sets that meet at these places can be similar: in size, and in what they have from here on.

    At the first shingle that two sets share, those from it on are all that they can share.
    """
    size_a, size_b = at_a >> 32, at_b >> 32
    rest = np.minimum(size_a - (at_a & 0xFFFFFFFF), size_b - (at_b & 0xFFFFFFFF))
    near = LEAST[1] * np.minimum(size_a, size_b) >= LEAST[0] * np.maximum(size_a, size_b)
    return near & (sum(LEAST) * rest >= LEAST[0] * (size_a + size_b))


def _prefixes(width: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, part in texts(batches, "text"):
            tokens, ats, sigs = [], [], []
            for text in part:
                held = shingles(text, width)
                sig = signature(held)
                if sig in seen:  # a copy
                    continue
                seen.add(sig)
                first = prefix(held, *shared.value)
                tokens.append(first.view(np.int64))
                ats.append(_pack(len(held), np.arange(len(first))))
                sigs.append(np.full(len(first), sig))
            if tokens:
                columns = [np.concatenate(c).astype(np.int64) for c in (tokens, ats, sigs)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "at", "sig"])

    return run


MET = "token bigint, at bigint, sig bigint, before bigint, first bigint"


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of shingles that have one of similar size, with the set before and the first of a run of similar sizes, if those can be similar.

    Rows come sorted by shingle, size and signature; only the last row and the first of its run are held between batches.
    """
    held = [np.empty(0, np.int64)] * 3
    run_first, joined = None, False  # (at, sig) of the held row's run; whether the held row fits the one before it
    before_held = None

    def out(cols: list[np.ndarray], kept: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c[kept]) for c in cols], ["token", "at", "sig", "before", "first"])

    for batch in batches:
        token, at, sig = (np.concatenate([h, c.to_numpy(zero_copy_only=False)]) for h, c in zip(held, batch.columns))
        new = np.r_[True, (token[1:] != token[:-1]) | (sig[1:] != sig[:-1])]  # copies of a set in several tasks
        token, at, sig = token[new], at[new], sig[new]
        if not len(token):
            continue
        size = at >> 32
        fits = (token[1:] == token[:-1]) & (LEAST[1] * size[:-1] >= LEAST[0] * size[1:])
        run = np.maximum.accumulate(np.where(np.r_[True, ~fits], np.arange(len(token)), 0))
        first_at, first_sig = at[run], sig[run]
        if run_first is not None:
            first_at, first_sig = np.where(run == 0, run_first[0], first_at), np.where(run == 0, run_first[1], first_sig)
        before = np.where(np.r_[False, fits & _fits(at[:-1], at[1:])], np.r_[sig[:1], sig[:-1]], sig)
        if before_held is not None:
            before[0] = before_held
        first = np.where(_fits(first_at, at), first_sig, sig)
        after_first = np.r_[joined, fits]
        kept = after_first | np.r_[fits, False]
        kept[-1] = False  # held back: the next row decides
        yield out([token, at, sig, before, first], kept)
        held, joined, before_held = [token[-1:], at[-1:], sig[-1:]], bool(after_first[-1]), int(before[-1])
        run_first = (int(first_at[-1]), int(first_sig[-1]))
    if len(held[0]) and joined:
        near = _fits(np.array([run_first[0]]), held[1])[0]
        last = [*held, np.array([before_held]), np.array([run_first[1]]) if near else held[2]]
        yield out(last, np.array([True]))


def _across(picks: int, seed: int):
    """Pairs of each cell that can be similar and are in different components; with ``picks``, so many partners a set at most.

    Cells come whole and sorted, each a bounded number of rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        last = False
        batches = iter(batches)
        while not last:
            batch = next(batches, None)
            last = batch is None
            if batch is not None:
                columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
                kept = [np.concatenate(x) for x in zip(kept, columns)] if kept else columns
            if not kept or not len(kept[0]):
                continue
            token, cell = kept[0], kept[1]
            cuts = np.flatnonzero((token[1:] != token[:-1]) | (cell[1:] != cell[:-1])) + 1
            cuts = np.r_[0, cuts, *([len(token)] if last else [])].astype(np.int64)
            sizes = np.diff(cuts)
            large = [(a, b) for a, b in zip(cuts[:-1][sizes > SMALL_CELL].tolist(), cuts[1:][sizes > SMALL_CELL].tolist())]
            found = [_pairs(*[c[a:b] for c in kept[2:6]], picks, seed, _matrix(kept[6][a:b])) for a, b in large]
            # A small cell has the same rows in every round, so its pairs go in the first one only: later, components have only grown.
            chosen = np.repeat((sizes <= SMALL_CELL) & (seed == 0), sizes)
            if chosen.any():
                number = np.repeat(np.arange(len(sizes)), sizes)[chosen]
                found.append(_small_pairs(number, *[c[: cuts[-1]][chosen] for c in kept[3:6]]))
            kept = [c[cuts[-1] :] for c in kept]
            pairs = np.unique(np.concatenate([np.empty((0, 2), np.int64), *found]), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return run


def _matrix(bitmaps: np.ndarray) -> np.ndarray:
    return np.frombuffer(b"".join(bitmaps), np.uint64).reshape(len(bitmaps), -1)


def _small_pairs(cell: np.ndarray, at: np.ndarray, sig: np.ndarray, root: np.ndarray) -> np.ndarray:
    """(a, b) of all small cells at once: every row with the one after it, then with the one after that, and so on."""
    out = [np.empty((0, 2), np.int64)]
    for step in range(1, SMALL_CELL):
        same = cell[step:] == cell[:-step]
        if not same.any():
            break
        good = np.flatnonzero(same & (root[step:] != root[:-step]))
        good = good[_fits(at[good], at[good + step])]
        a, b = sig[good], sig[good + step]
        out.append(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1))
    return np.concatenate(out)


def _pairs(block: np.ndarray, at: np.ndarray, sig: np.ndarray, root: np.ndarray, picks: int, seed: int, bits: np.ndarray | None = None) -> np.ndarray:
    """(a, b) of a large cell; rows of two blocks are paired across the blocks only. With the sets' bitmaps, pairs that these rule out are left out.

    Picked partners are those of the highest bounds, the next ones in a later round; without bitmaps those of the smallest hashes, so that
    a set picks the same ones at all its shingles.
    """
    _, of, n = np.unique(root, return_inverse=True, return_counts=True)
    if len(n) < 2:
        return np.empty((0, 2), np.int64)
    largest, two = int(n.argmax()), len(np.unique(block)) > 1
    chance = [_mixed(sig.view(np.uint64) + np.uint64(seed * picks + i)) for i in range(picks)]
    # Rows are sorted by size: only those from four fifths to five fourths of it can be partners.
    size = at >> 32
    begin = np.searchsorted(size, -(-LEAST[0] * size // LEAST[1]), "left")
    end = np.searchsorted(size, LEAST[1] * size // LEAST[0], "right")
    out = [np.empty((0, 2), np.int64)]
    for i in np.flatnonzero(of != largest).tolist():
        a, b = int(begin[i]), int(end[i])
        # Each pair once: with the largest component, and with earlier rows of the others.
        other = (of[a:b] != of[i]) & _fits(at[i], at[a:b])
        if not picks:
            other &= (of[a:b] == largest) | (np.arange(a, b) < i)
        if two:
            other &= block[a:b] != block[i]
        places = np.flatnonzero(other) + a
        if bits is not None and len(places):
            both, sizes = _share_at_most(size[i], bits[i], size[places], bits[places]), size[i] + size[places]
            good = sum(LEAST) * both >= LEAST[0] * sizes
            places, bound = places[good], (both / sizes)[good]
            if picks and len(places) > picks:
                order = np.lexsort((chance[0][places], -bound))
                at_least = min(seed * picks, len(order) - picks)
                places = places[order[at_least : at_least + picks]]
        elif picks and len(places) > picks:
            places = np.unique([places[c[places].argmin()] for c in chance])
        held = sig[places]
        out.append(np.stack([np.minimum(held, sig[i]), np.maximum(held, sig[i])], axis=1))
    return np.concatenate(out)


def _open(met: DataFrame, roots: DataFrame, made: list[str]) -> DataFrame:
    """(token, at, sig, root) of shingles whose sets are in different components, with the number of blocks each is cut into."""
    placed = met.select("token", "at", "sig").join(roots.withColumnRenamed("node", "sig"), "sig", "left")
    placed = placed.select("token", "at", "sig", F.coalesce("root", "sig").alias("root"))
    counts = placed.groupBy(F.col("token").alias("_token")).agg(
        F.count(F.lit(1)).alias("_n"), F.ceil(F.count(F.lit(1)) / CELL_ROWS).alias("_blocks"), F.min("root").alias("_low"), F.max("root").alias("_high")
    )
    apart = placed.join(counts.where("_low < _high").select("_token", "_n", "_blocks"), F.col("token") == F.col("_token"))
    return stored(apart.drop("_token"), "open_shingles", made)


def _in_cells(open_rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(token, cell, block, at, sig, root, bits), with bitmaps where cells may be large: a shingle of more than ``CELL_ROWS`` sets is cut into blocks, each pair of which is a cell."""
    large = open_rows.where(F.col("_n") > SMALL_CELL).join(sets.select("sig", "bits"), "sig")
    small = open_rows.where(F.col("_n") <= SMALL_CELL).withColumn("bits", F.lit(None).cast("binary"))
    placed = large.unionByName(small).withColumn("block", F.pmod(F.xxhash64("sig"), F.col("_blocks")))
    others = F.explode(F.expr("sequence(0L, _blocks - 1)")).alias("_other")
    cells = placed.select("token", "block", "at", "sig", "root", "bits", "_blocks", others)
    cell = F.least("block", "_other") * F.col("_blocks") + F.greatest("block", "_other")
    cells = cells.select("token", cell.alias("cell"), "block", "at", "sig", "root", "bits")
    return cells.repartition("token", "cell").sortWithinPartitions("token", "cell", "at", "sig")


def _may_be(pairs: DataFrame, sets: DataFrame, made: list[str]) -> DataFrame:
    """(a, b, rep_a, rep_b): pairs that their histograms do not rule out, with the row that stands for each set."""

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = zip(*[batch.column(c).to_pylist() for c in ("histogram_a", "size_a", "histogram_b", "size_b")])
            good = pa.array([may_be_similar(*v) for v in values], pa.bool_())
            yield batch.select(["a", "b", "rep_a", "rep_b"]).filter(good)

    for end in ("a", "b"):
        named = sets.select(F.col("sig").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in ("rep", "size", "histogram")])
        pairs = pairs.join(named, end)
    rep = sets.schema["rep"].dataType.simpleString()
    return stored(pairs.mapInArrow(bound, f"a bigint, b bigint, rep_a {rep}, rep_b {rep}"), "candidate_pairs", made)


def _confirmed(keyed: DataFrame, sets: DataFrame, pairs: DataFrame, width: int, made: list[str]) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity. The text of each b goes to its a, the hub."""
    pairs = _may_be(pairs, sets, made)
    load = pairs.groupBy(F.col("a").alias("_hub")).agg(F.floor(F.count(F.lit(1)) / HUB_ROWS + 1).alias("_copies"))
    loaded = pairs.join(load, F.col("a") == F.col("_hub"))
    members = loaded.select(F.col("a").alias("hub"), F.pmod(F.xxhash64("b"), F.col("_copies")).alias("copy"), F.lit(1).alias("kind"), F.col("b").alias("sig"), F.col("rep_b").alias("rep"))
    hubs = loaded.select("a", "_copies", "rep_a").distinct()
    hubs = hubs.select(F.col("a").alias("hub"), F.explode(F.expr("sequence(0L, _copies - 1)")).alias("copy"), F.lit(0).alias("kind"), F.col("a").alias("sig"), F.col("rep_a").alias("rep"))
    wanted = stored(members.unionByName(hubs), "wanted_texts", made)
    sent = _with_key(keyed, wanted.select("hub", "copy", "kind", "sig", "rep.*"), "inner").select("hub", "copy", "kind", "sig", "text")
    dealt = sent.repartition("hub", "copy").sortWithinPartitions("hub", "copy", "kind", "sig")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own, last = None, np.empty(0, np.uint64), None
        for part, held in texts(batches, "text"):
            found = []
            for hub, copy, kind, sig, text in zip(*[part.column(c).to_pylist() for c in ("hub", "copy", "kind", "sig")], held):
                if (hub, copy, kind, sig) == last:  # a repeated row
                    continue
                last = (hub, copy, kind, sig)
                if kind == 0:
                    at, own = (hub, copy), shingles(text, width)
                elif at == (hub, copy) and similar(own, shingles(text, width)):
                    found.append((hub, sig))
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    return stored(dealt.mapInArrow(confirm, "a bigint, b bigint"), "links", made)


_KEY = ("none", "id", "tie")


def _with_key(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows joined to a table by (none, id, tie); broadcast where the table was counted to be small."""
    small = keys.count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(keys) if small else keys, list(_KEY), how)


def _tree_hubs(sets: DataFrame) -> DataFrame:
    """(a, b): each set whose fingerprint a BK-tree links to others, with the first set of its component."""
    roots = components(tree_links(sets.select("fp").distinct()))
    named = sets.select("sig", "fp").join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    named = named.select("sig", F.coalesce("root", "fp").alias("root"))
    hubs = named.groupBy("root").agg(F.min("sig").alias("a"))
    return named.join(hubs, "root").where("sig != a").select("a", F.col("sig").alias("b"))


def similar_sets(keyed: DataFrame, sets: DataFrame, width: int, made: list[str]) -> DataFrame:
    """(a, b): links that connect all similar sets; ``sets`` has sig, rep, size, histogram, fp and bits of each, ``keyed`` the texts by key."""
    common = common_shingles(keyed, width)
    order = np.argsort(common)
    shared = keyed.sparkSession.sparkContext.broadcast((common[order], order))
    tokens = keyed.select("text").mapInArrow(_prefixes(width, shared), "token bigint, at bigint, sig bigint")
    dealt = tokens.repartition("token").sortWithinPartitions("token", "at", "sig")
    met = stored(dealt.mapInArrow(_met, MET), "shingles_met", made)

    # Each set against one hub of all that it is paired with, and against one of those that its fingerprint is linked to.
    near = met.select("sig", F.explode(F.array("before", "first")).alias("other")).where("sig != other")
    hubs = components(near.select(F.col("sig").alias("a"), F.col("other").alias("b")))
    hubs = hubs.where("node != root").select(F.col("root").alias("a"), F.col("node").alias("b"))
    links = _confirmed(keyed, sets, _tree_hubs(sets).unionByName(hubs).distinct(), width, made)

    rows = met
    for n in range(ROUNDS + 1):
        rows = _open(rows, components(links), made)
        picks = PICKS if n < ROUNDS else 0  # at last all pairs
        apart = _in_cells(rows, sets).mapInArrow(_across(picks, n), "a bigint, b bigint").distinct()
        links = stored(links.unionByName(_confirmed(keyed, sets, apart, width, made)), "links", made)
    return links


def keep_one(docs: DataFrame, *, width: int = WIDTH) -> DataFrame:
    """One row of ``docs`` for each component of similar documents: the one of smallest id (null last), then of smallest text hash.

    Words are cut at blanks and A-Z lowered; a text of fewer words than ``width`` is one shingle. Null and empty texts and texts without
    a word are copies of each other. Texts are read whole, however long. All columns stay as they are; a repeated row stays once; an empty
    table gives no rows. Intermediate files are removed, but for the list of rows to drop that the result reads.
    """
    spark = docs.sparkSession
    names = [f"c{i}" for i in range(len(docs.columns))]
    renamed = docs.toDF(*names)
    doc_id, text = (F.col(names[docs.columns.index(c)]) for c in ("doc_id", "text"))
    key = _key_columns(doc_id, text)
    keyed = renamed.select(*key, text.alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in texts(batches, "text"):
            held = [shingles(t, width) for t in rows]
            added = [pa.array([signature(h) for h in held], pa.int64()), pa.array([len(h) for h in held], pa.int64()), *[pa.array([f(h) for h in held], pa.binary()) for f in (histogram, bitmap)], pa.array([fingerprint(h) for h in held], pa.int64())]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in _KEY], *added], [*_KEY, "sig", "size", "histogram", "bits", "fp"])

    made: list[str] = []
    signed = keyed.mapInArrow(sign, "none boolean, id bigint, tie bigint, sig bigint, size bigint, histogram binary, bits binary, fp bigint")
    rows = stored(signed, "shingle_signatures", made)
    rep = F.min(F.struct(*_KEY)).alias("rep")
    facts = [F.first(c).alias(c) for c in ("size", "histogram", "bits", "fp")]
    sets = stored(rows.groupBy("sig").agg(rep, *facts), "shingle_sets", made)
    roots = components(similar_sets(keyed, sets, width, made))
    # Per set first, so that a component with very many rows arrives as few.
    named = sets.select("sig", "rep").join(roots.withColumnRenamed("node", "sig"), "sig", "left")
    named = named.withColumn("root", F.coalesce("root", "sig"))
    best = named.groupBy(F.col("root").alias("_root")).agg(F.min("rep").alias("best"))
    kept = named.join(best, F.col("root") == F.col("_root")).select("sig", "best")
    times = rows.groupBy(*_KEY, "sig").agg(F.count(F.lit(1)).alias("times"))
    judged = times.join(kept, "sig").select(*_KEY, "times", (F.struct(*_KEY) == F.col("best")).alias("keep"))
    odd = stored(judged.where("NOT keep OR times > 1").select(*_KEY, "keep"), "rows_to_drop")
    remove(spark, made)

    whole = renamed.select("*", *key)
    single = _with_key(whole, odd.select(*_KEY), "left_anti")
    # Rows that are there several times and stay: one of each.
    again = _with_key(whole, odd.where("keep").select(*_KEY), "left_semi").dropDuplicates(list(_KEY))
    return single.unionByName(again).select(names).toDF(*docs.columns)


def _key_columns(doc_id: Column, text: Column) -> list[Column]:
    return [doc_id.isNull().alias("none"), F.coalesce(doc_id.cast("bigint"), F.lit(0)).alias("id"), F.xxhash64(text).alias("tie")]
