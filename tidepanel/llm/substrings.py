"""Removal of repeated substrings by sharded suffix arrays.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts earlier, in a smaller document or before in the same one.
Every such string has an anchor: the rightmost of its ``GRAM``-byte pieces with the smallest hash. Equal strings have
equal anchors at the same place, so

1. every slice of documents reports the hashes of its anchors, packed, and is told which of them other slices have as well; only
   strings whose anchor occurs more than once go on;
2. of each anchor's context (the union of the strings it stands for) the slice sends a digest and hears whether it is a copy of an earlier
   one, as within exact copies, or one of several different ones. The bytes of these, one holder each, are dealt out by anchor hash.
   A shard sorts the suffixes of its contexts by Larsson-Sadakane refinement, Kasai's method gives the common prefixes of neighbours, and suffixes
   with ``LENGTH`` common bytes form a class, whose first member stays;
3. an anchor with more different contexts than a shard should hold is spread: each of its strings is dealt out by its own digest.

Suffix arrays over everything would compare every shard with every other; dealt by anchor, equal strings meet in one shard.
Documents are shuffled once, by slice; the steps that read their bytes share that exchange.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.llm.common import n_bytes, query, table

LENGTH = 100
GRAM = 50  # long enough that texts do not share one by chance, which would grow faster than the input
SPREAD_FROM = 2**17  # different contexts of an anchor that one shard holds, about 20 MB; beyond that its strings are dealt out one by one
SLICE_BYTES = 2**20
SHARD_BYTES = 2**20
BYTES_PER_BUCKET = 32 * 2**20  # of text for each bucket of anchor hashes, about a million of them
HASH_BYTES = 5  # of an anchor hash; a chance collision costs work, not correctness
_FACTOR = 0x9E3779B97F4A7C15
_CODE = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
_CODE ^= _CODE >> np.uint64(31)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        for name, x in (("up", _FACTOR), ("down", pow(_FACTOR, -1, 2**64))):
            out = np.full(n, x, np.uint64)
            out[0] = 1
            _POWERS[name] = np.cumprod(out)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def anchors(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per anchor: document, place, first and last start of the strings it stands for (places in the document), hash."""
    sizes = np.array([len(d) for d in docs], np.int64)
    begins = np.r_[0, np.cumsum(sizes)]
    raw = np.frombuffer(b"".join(docs), np.uint8)
    n = len(raw)
    none = np.empty(0, np.int64)
    if n < LENGTH:
        return none, none, none, none, none
    up, down = _powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODE[raw] * up[:n], out=total[1:])
    grams = (total[GRAM:] - total[:-GRAM]) * down[: n - GRAM + 1]
    grams ^= grams >> np.uint64(32)
    grams *= np.uint64(0xD6E8FEB86659FD93)
    # Smallest hash of each run of grams; the low half makes the rightmost of equal ones the smallest.
    low = np.uint64(0xFFFFFFFF)
    least = grams & ~low | (low - np.arange(len(grams), dtype=np.uint64))
    reach, width = 1, LENGTH - GRAM + 1
    while reach < width:
        step = min(reach, width - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    owner = np.repeat(np.arange(len(docs)), np.maximum(sizes - LENGTH + 1, 0))
    starts = np.arange(len(owner)) + np.repeat(begins[:-1] - np.r_[0, np.cumsum(np.maximum(sizes - LENGTH + 1, 0))][:-1], np.maximum(sizes - LENGTH + 1, 0))
    place = (low - (least[starts] & low)).astype(np.int64)
    if not len(place):
        return none, none, none, none, none
    first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])])
    last = np.r_[first[1:], len(place)] - 1
    doc, at = owner[first], place[first]
    h = (grams[at] >> np.uint64(64 - 8 * HASH_BYTES)).astype(np.int64)
    return doc, at - begins[doc], starts[first] - begins[doc], starts[last] - begins[doc], h


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the place of each in that order.

    Larsson-Sadakane: sorted to h bytes, a suffix's rank h places on sorts it to 2h; only groups that are still
    tied are sorted again.
    """
    n = len(text)
    key = np.zeros(n + 8, np.uint64)
    key[:n] = text
    for step, bits in ((1, 8), (2, 16), (4, 32)):
        key = key[:-step] << np.uint64(bits) | key[step:]
    key = key[:n]
    order = np.argsort(key, kind="stable")
    first = np.r_[True, key[order][1:] != key[order][:-1]] if n else np.empty(0, bool)
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    group = np.maximum.accumulate(np.where(first, np.arange(n), 0)) if n else np.empty(0, np.int64)
    rank[order] = group
    h = 8
    while h < n:
        tied = ~first
        tied[:-1] |= ~first[1:]
        places = np.flatnonzero(tied)
        if not len(places):
            break
        some = order[places]
        key = rank[some] * (n + 2) + rank[np.minimum(some + h, n)] + 1
        again = np.argsort(key, kind="stable")
        some, key = some[again], key[again]
        order[places] = some
        new = np.r_[True, key[1:] != key[:-1]]
        first[places] = new
        rank[some] = places[np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))]
        h *= 2
    at = np.empty(n, np.int64)
    at[order] = np.arange(n)
    return order, at


def common_prefixes(text: np.ndarray, order: np.ndarray, at: np.ndarray, begins: np.ndarray, sizes: np.ndarray, most: int) -> np.ndarray:
    """Bytes each suffix shares with the one before it in the order, up to ``most``.

    Kasai: the next place shares at least one byte less. All pieces of the text go forward together.
    """
    n = len(text)
    padded = np.r_[text.astype(np.int16), -1 - np.zeros(most + 1, np.int16)]
    by_size = np.argsort(-sizes, kind="stable")
    begins, sizes = begins[by_size], sizes[by_size]
    out, shared = np.zeros(n, np.int64), np.zeros(len(begins), np.int64)
    for o in range(int(sizes[0]) if len(sizes) else 0):
        live = int(np.searchsorted(-sizes, -o, "left"))
        here = begins[:live] + o
        rank = at[here]
        before = order[np.maximum(rank - 1, 0)]
        found = np.maximum(shared[:live] - 1, 0)
        found[rank == 0] = 0
        todo = np.flatnonzero((rank > 0) & (found < most))
        while len(todo):
            same = padded[here[todo] + found[todo]] == padded[np.minimum(before[todo] + found[todo], n + most)]
            todo = todo[same]
            found[todo] += 1
            todo = todo[found[todo] < most]
        out[rank] = found
        shared[:live] = found
    return out


def later_copies(contexts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For contexts in their order: strings (context, start) that occur earlier, and a flag for first members of a class.

    Returns context, start and whether the string is the first of its class, for every string of ``LENGTH`` bytes.
    """
    sizes = np.array([len(c) for c in contexts], np.int64)
    begins = np.r_[0, np.cumsum(sizes)][:-1]
    text = np.frombuffer(b"".join(contexts), np.uint8)
    order, at = suffix_array(text)
    shared = common_prefixes(text, order, at, begins, sizes, LENGTH)
    classes = np.cumsum(shared < LENGTH) - 1
    which = np.repeat(np.arange(len(contexts)), sizes - LENGTH + 1)
    starts = np.arange(len(which)) - np.repeat(np.r_[0, np.cumsum(sizes - LENGTH + 1)][:-1], sizes - LENGTH + 1)
    spots = begins[which] + starts
    own = classes[at[spots]]
    lowest = np.full(int(classes[-1]) + 1, len(text), np.int64)
    np.minimum.at(lowest, own, spots)
    return which, starts, lowest[own] == spots


def _runs(starts: np.ndarray) -> list[tuple[int, int]]:
    """Sorted starts of strings as byte ranges."""
    if not len(starts):
        return []
    cuts = np.flatnonzero(np.diff(starts) > 1)
    return list(zip(starts[np.r_[0, cuts + 1]].tolist(), (starts[np.r_[cuts, len(starts) - 1]] + LENGTH).tolist()))


def _packed(h: np.ndarray) -> bytes:
    return h.astype(">i8").view(np.uint8).reshape(-1, 8)[:, 8 - HASH_BYTES :].tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    wide = np.zeros((len(packed) // HASH_BYTES, 8), np.uint8)
    wide[:, 8 - HASH_BYTES :] = np.frombuffer(packed, np.uint8).reshape(-1, HASH_BYTES)
    return wide.view(">i8").ravel().astype(np.int64)


def _documents(table: pa.Table) -> tuple[list[tuple[int, int]], list[bytes]]:
    ids = list(zip(table.column("doc").to_pylist(), table.column("tie").to_pylist()))
    return ids, [(t or "").encode() for t in table.column("text").to_pylist()]


REPORTS = "bucket bigint, slice bigint, hashes binary, several binary"


def _reports(buckets: int):
    def report(docs: pa.Table) -> pa.Table:
        """A slice's anchor hashes by bucket, each once, and whether it has them several times."""
        h, times = np.unique(anchors(_documents(docs)[1])[4], return_counts=True)
        slice_ = docs.column("slice")[0].as_py()
        rows = [(int(b), h[h % buckets == b], times[h % buckets == b] > 1) for b in np.unique(h % buckets)]
        columns = [[b for b, *_ in rows], [slice_] * len(rows), [_packed(x) for _, x, _ in rows], [t.tobytes() for *_, t in rows]]
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["bucket", "slice", "hashes", "several"])

    return report


REPLIES = "slice bigint, usual binary"


def _replies(reports: pa.Table) -> pa.Table:
    """For each slice, which of its hashes are repeated anywhere."""
    slices = reports.column("slice").to_pylist()
    own = [_unpacked(x) for x in reports.column("hashes").to_pylist()]
    several = np.concatenate([np.frombuffer(x, bool) for x in reports.column("several").to_pylist()])
    h, place, times = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
    twice = times > 1
    twice[place[several]] = True
    ends = np.cumsum([len(x) for x in own])
    found = [place[a:b] for a, b in zip(np.r_[0, ends[:-1]], ends)]
    usual = [_packed(h[f[twice[f]]]) for f in found]
    return pa.Table.from_arrays([pa.array(slices, pa.int64()), pa.array(usual, pa.binary())], names=["slice", "usual"])


def _repeated(docs: pa.Table, replies: pa.Table) -> Iterator[tuple[int, tuple[int, int], int, int, bytes]]:
    """A slice's repeated anchors in document order: hash, owner, byte range, context."""
    ids, texts = _documents(docs)
    usual = _unpacked(b"".join(x or b"" for x in replies.column("usual").to_pylist()))
    doc, at, low, high, h = anchors(texts)
    edges = np.searchsorted(doc, np.arange(len(texts) + 1))
    repeated = np.isin(h, usual)
    for d in sorted(range(len(texts)), key=ids.__getitem__):
        mine = np.arange(edges[d], edges[d + 1])
        for i in mine[repeated[mine]].tolist():
            a, b = int(low[i]), int(high[i]) + LENGTH
            yield int(h[i]), ids[d], a, b, texts[d][a:b]


CLAIMS = "bucket bigint, slice bigint, claims binary"
_CLAIM = np.dtype([("h", "<i8"), ("context", "<i8"), ("doc", "<i8"), ("tie", "<i8"), ("a", "<i8")])


def _claims(buckets: int):
    def claim(docs: pa.Table, replies: pa.Table) -> pa.Table:
        """By bucket of anchor hashes: the first holder in the slice of every context, known by its digest."""
        first, rows = set(), {}
        for h, owner, a, _, context in _repeated(docs, replies):
            if (h, context) not in first:
                first.add((h, context))
                digest = hashlib.blake2b(context, digest_size=8).digest()
                rows.setdefault(h % buckets, []).append((h, int.from_bytes(digest, "big", signed=True), *owner, a))
        slice_ = docs.column("slice")[0].as_py() if docs.num_rows else 0
        packed = [np.array(r, _CLAIM).tobytes() for r in rows.values()]
        columns = [pa.array(list(rows), pa.int64()), pa.array([slice_] * len(rows), pa.int64()), pa.array(packed, pa.binary())]
        return pa.Table.from_arrays(columns, names=["bucket", "slice", "claims"])

    return claim


ANSWERS = "slice bigint, usual binary, bucket bigint, answers binary"
_ALONE, _COPY, _SEVERAL, _SPREAD = 0, 1, 2, 3


def _answering(spread_from: int):
    def answer(claims: pa.Table) -> pa.Table:
        """For each claim: a copy of an earlier context, the first of one of several (or very many) contexts of its anchor, or of the only one."""
        parts = [np.frombuffer(x, _CLAIM) for x in claims.column("claims").to_pylist()]
        every = np.concatenate(parts)
        order = np.lexsort([every[c] for c in ("a", "tie", "doc", "context", "h")])
        h, context = every["h"][order], every["context"][order]
        new_h = np.r_[True, h[1:] != h[:-1]]
        new = new_h | np.r_[True, context[1:] != context[:-1]]
        group = np.cumsum(new_h) - 1
        contexts = np.bincount(group, weights=new)[group]
        found = np.empty(len(every), np.uint8)
        several = np.where(contexts > max(spread_from, 1), _SPREAD, np.where(contexts > 1, _SEVERAL, _ALONE))
        found[order] = np.where(~new, _COPY, several)
        ends = np.cumsum([len(x) for x in parts])
        packed = [found[a:b].tobytes() for a, b in zip(np.r_[0, ends[:-1]], ends)]
        columns = [claims.column("slice"), pa.nulls(len(packed), pa.binary()), claims.column("bucket"), pa.array(packed, pa.binary())]
        return pa.Table.from_arrays(columns, names=["slice", "usual", "bucket", "answers"])

    return answer


_answers = _answering(SPREAD_FROM)


CONTEXTS = "h bigint, doc bigint, tie bigint, a bigint, b bigint, context binary"


def _contexts(buckets: int):
    def send(docs: pa.Table, answers: pa.Table) -> pa.Table:
        """Contexts that have to be compared, strings of spread anchors as digests, and copies without their bytes.

        What equals something earlier is known to be a copy: such ranges go on under any key, joined where they touch.
        """
        told = {b: iter(x) for b, x in zip(*[answers.column(c).to_pylist() for c in ("bucket", "answers")]) if x is not None}
        first, strings, rows, copies = {}, {}, [], []

        def copy(owner: tuple[int, int], a: int, b: int) -> None:
            if copies and copies[-1][:2] == owner and a <= copies[-1][3]:
                copies[-1] = (*owner, copies[-1][2], max(b, copies[-1][3]))
            else:
                copies.append((*owner, a, b))

        for h, owner, a, b, context in _repeated(docs, answers):
            answer, holder = _COPY, first.get((h, context))
            if holder is None:
                first[h, context] = (*owner, a)
                answer = next(told[h % buckets])
            elif holder == (*owner, a):
                continue  # a repeated row
            if answer == _COPY:
                copy(owner, a, b)
            elif answer == _SEVERAL:
                rows.append((h, *owner, a, b, context))
            elif answer == _SPREAD:
                for p in range(a, b - LENGTH + 1):
                    digest = hashlib.blake2b(context[p - a : p - a + LENGTH], digest_size=16).digest()
                    if strings.setdefault(digest, (*owner, p)) == (*owner, p):
                        rows.append((int.from_bytes(digest[:8], "big", signed=True), *owner, p, p + LENGTH, digest))
                    else:
                        copy(owner, p, p + LENGTH)
        rows += [(hash(c), *c, None) for c in copies]
        columns = list(zip(*rows)) or [()] * 6
        kinds = [*[pa.int64()] * 5, pa.binary()]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in CONTEXTS.split(", ")])

    return send


def _by_hash(batches: Iterator[pa.RecordBatch], copies: list[tuple]) -> Iterator[list[tuple]]:
    """Rows (h, doc, tie, a, b, bytes) in pieces of whole hashes of about SHARD_BYTES of context, the first holder of each context only.

    Rows come sorted by all but b. Ranges of known copies and of later holders are put aside, so that a context of any number of
    documents is held once.
    """
    held: list[tuple] = []
    size, last = 0, None
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if row[5] is None:
                copies.append(row[1:5])
            elif last is not None and (row[0], row[5]) == (last[0], last[5]):
                if row[1:4] != last[1:4]:
                    copies.append(row[1:5])
            else:
                if size >= SHARD_BYTES and row[0] != held[-1][0]:
                    yield held
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
                last = row
        if len(copies) > 100_000:
            yield []
    if held:
        yield held


def _ranges(found: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*found)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc", "tie", "a", "b"])


def _search_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Byte ranges (doc, tie, a, b) of strings that occur earlier."""
    copies: list[tuple] = []
    for rows in _by_hash(batches, copies):
        found = list(copies)
        copies.clear()
        several = Counter(r[0] for r in rows)
        kept = sorted((r for r in rows if several[r[0]] > 1 and len(r[5]) >= LENGTH), key=lambda r: r[1:4])
        if kept:
            which, starts, first = later_copies([r[5] for r in kept])
            edges = np.searchsorted(which, np.arange(len(kept) + 1))
            for i, r in enumerate(kept):
                mine = slice(edges[i], edges[i + 1])
                found += [(r[1], r[2], r[3] + a, r[3] + b) for a, b in _runs(starts[mine][~first[mine]])]
        yield _ranges(found)
    yield _ranges(copies)


CUT = "doc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def _cut(keep: bool):
    def cut(docs: pa.Table, ranges: pa.Table) -> pa.Table:
        """What stays of each document of a slice after its ranges are removed."""
        own: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for doc, tie, a, b in zip(*[ranges.column(c).to_pylist() for c in ("doc", "tie", "a", "b")]):
            own.setdefault((doc, tie), []).append((a, b))
        rows = []
        for (doc, tie), data in zip(*_documents(docs)):
            union: list[list[int]] = []
            for a, b in sorted(own.get((doc, tie), ())):
                if union and a <= union[-1][1]:
                    union[-1][1] = max(union[-1][1], b)
                else:
                    union.append([a, b])
            edges = [0, *[x for ab in union for x in ab], len(data)]
            rest = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
            digest = hashlib.sha256(rest).hexdigest()
            rows.append((doc, len(data), len(data) - len(rest), len(union), digest, rest if keep else None))
        columns = list(zip(*rows)) or [()] * 6
        kinds = [*[pa.int64()] * 4, pa.string(), pa.binary()]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in CUT.split(", ")])

    return cut


def remove_repeats(docs: DataFrame, spread_from: int = SPREAD_FROM, *, keep: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every row of ``docs`` (doc_id, text).

    Texts are UTF-8 bytes, so what is kept is bytes as well (null unless ``keep``). A null text is empty; a null id comes before all others.
    Rows of one id and text are one document; different texts of one id are ordered by hash. An empty table gives no rows,
    other columns are ignored.
    """
    total = docs.agg(F.sum(n_bytes())).first()[0] or 0
    slices, buckets = total // SLICE_BYTES + 1, total // BYTES_PER_BUCKET + 1
    of = F.pmod(F.xxhash64("doc"), F.lit(slices)).alias("slice")
    none = F.lit("-9223372036854775808").cast("bigint")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), none).alias("doc"), F.xxhash64("text").alias("tie"), "text")
    rows = rows.select(of, "doc", "tie", "text")
    by_slice = rows.groupBy("slice")
    reports = by_slice.applyInArrow(_reports(buckets), REPORTS)
    replies = reports.groupBy("bucket").applyInArrow(_replies, REPLIES)
    claims = by_slice.cogroup(replies.groupBy("slice")).applyInArrow(_claims(buckets), CLAIMS)
    answers = claims.groupBy("bucket").applyInArrow(_answering(spread_from), ANSWERS)
    answers = answers.unionByName(replies, allowMissingColumns=True)
    contexts = by_slice.cogroup(answers.groupBy("slice")).applyInArrow(_contexts(buckets), CONTEXTS)
    dealt = contexts.repartition("h").sortWithinPartitions("h", "context", "doc", "tie", "a")
    ranges = dealt.mapInArrow(_search_shards, "doc bigint, tie bigint, a bigint, b bigint")
    found = by_slice.cogroup(ranges.select(of, "doc", "tie", "a", "b").groupBy("slice")).applyInArrow(_cut(keep), CUT)
    doc_id = F.when(F.col("doc") != none, F.col("doc")).alias("doc_id")
    return found.select(doc_id, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")


@query()
def op7_repeated_substrings(spark: SparkSession, d: str) -> DataFrame:
    """What removing all repeated 100-byte strings leaves of every document."""
    return remove_repeats(table(spark, d, "documents"), keep=False).drop("kept")
