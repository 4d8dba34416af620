"""Conversation structure repair: generalised LR parsing of roles with weighted edits.

Roles must read as an optional system turn and then pairs of user and assistant, or nothing: ``(s?(ua)+)?``, here a grammar from which
the LR tables are built. All readings of a conversation advance together on a graph of stack nodes: a node is a state on the node below
it and exists once, so that stacks share what they have in common and equal stack tops are the same node. Each row may be kept, given
another role or deleted, and turns may be inserted before it; what reaches the same top is merged by the least (cost, audit). The
grammar is left-recursive, so there are few nodes, however long the conversation is.

A conversation may hold any share of all rows: rows are range-partitioned in conversation order, and a task that does not see the
beginning of a conversation parses its piece from every possible stack top. Pieces join by the same minimum.
"""

from __future__ import annotations

import functools
import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepanel.llm.common import query, stored, table

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
LEGAL = ("su", "ua", "au")
_END = "$"
GRAMMAR = [("start", ("turns",)), ("turns", ()), ("turns", ("pairs",)), ("turns", ("s", "pairs")), ("pairs", ("u", "a")), ("pairs", ("pairs", "u", "a"))]
_FLUSH = 1024

State = frozenset
Node = tuple  # (state, node below it or None)
Front = dict  # stack top: (cost, audit)


def _closure(items: set) -> State:
    """LR(0) items (rule, dot) with those of the symbols behind the dots."""
    out, todo = set(items), list(items)
    while todo:
        rule, dot = todo.pop()
        body = GRAMMAR[rule][1]
        if dot < len(body):
            for new in ((i, 0) for i, (head, _) in enumerate(GRAMMAR) if head == body[dot]):
                if new not in out:
                    out.add(new)
                    todo.append(new)
    return frozenset(out)


@functools.cache
def _goto(state: State, symbol: str) -> State:
    return _closure({(r, d + 1) for r, d in state if d < len(GRAMMAR[r][1]) and GRAMMAR[r][1][d] == symbol})


@functools.cache
def _follow(head: str) -> frozenset:
    """Terminals that can come after a symbol; no symbol of this grammar but the first vanishes."""
    out = {_END} if head in ("start", "turns") else set()
    for other, body in GRAMMAR:
        for i, symbol in enumerate(body):
            if symbol == head:
                out |= {body[i + 1]} if i + 1 < len(body) else (_follow(other) if other != head else set())
    return frozenset(out)


BOTTOM: Node = (_closure({(0, 0)}), None)


def _below(node: Node, depth: int) -> Node:
    for _ in range(depth):
        node = node[1]
    return node


@functools.cache
def _reduced(node: Node, ahead: str) -> tuple[Node, ...]:
    """The node and all that reductions with this terminal ahead make of it."""
    out, todo = {node}, [node]
    while todo:
        top = todo.pop()
        for rule, dot in top[0]:
            head, body = GRAMMAR[rule]
            if rule and dot == len(body) and ahead in _follow(head):
                under = _below(top, len(body))
                new = (_goto(under[0], head), under)
                if new not in out:
                    out.add(new)
                    todo.append(new)
    return tuple(out)


@functools.cache
def shift(node: Node, terminal: str) -> tuple[Node, ...]:
    """Stack tops after reading a terminal."""
    return tuple({(after, n) for n in _reduced(node, terminal) if (after := _goto(n[0], terminal))})


@functools.cache
def accepts(node: Node) -> bool:
    return any((0, 1) in n[0] for n in _reduced(node, _END))


def _all_tops() -> list[Node]:
    found, todo = [BOTTOM], [BOTTOM]
    while todo:
        node = todo.pop(0)
        for new in (n for t in "sua" for n in shift(node, t)):
            if new not in found:
                found.append(new)
                todo.append(new)
    return found


def _merge(front: Front, top: Node, cost: int, audit: str) -> bool:
    old = front.get(top)
    if old is None or (cost, audit) < old:
        front[top] = (cost, audit)
        return True
    return False


def _with_inserts(front: Front) -> Front:
    """All tops that inserted turns lead to."""
    out, todo = dict(front), list(front)
    while todo:
        top = todo.pop()
        cost, audit = out[top]
        for terminal in "ua":
            todo += [n for n in shift(top, terminal) if _merge(out, n, cost + INSERT, audit + "I")]
    return out


def _read(front: Front, token: str) -> Front:
    """One row: its role's initial (o for any other), as a capital if truncated; x if it must go."""
    out: Front = {}
    initial, extra = token.lower(), TRUNCATED * token.isupper()
    for top, (cost, audit) in _with_inserts(front).items():
        _merge(out, top, cost + DELETE, audit + "D")
        if token == "x":
            continue
        for terminal in "sua":
            if initial == terminal:
                for n in shift(top, terminal):
                    _merge(out, n, cost + extra, audit + "K")
            if terminal != "s":
                for n in shift(top, terminal):
                    _merge(out, n, cost + extra + REROLE, audit + "R")
    return out


def _parse(entry: Node, tokens: str) -> Front:
    """Cheapest edits from a stack top to every other over a piece of rows."""
    front, sure = {entry: (0, "")}, []
    for i, token in enumerate(tokens, 1):
        front = _read(front, token)
        if i % _FLUSH == 0:  # what all readings have in common is decided
            common = os.path.commonprefix([audit for _, audit in front.values()])
            sure.append(common)
            front = {top: (cost, audit[len(common) :]) for top, (cost, audit) in front.items()}
    start = "".join(sure)
    return {top: (cost, start + audit) for top, (cost, audit) in front.items()}


@functools.lru_cache(maxsize=50_000)
def _parse_short(entry: Node, tokens: str) -> Front:
    return _parse(entry, tokens)


TOPS = _all_tops()
_PLACE = {top: i for i, top in enumerate(TOPS)}


def parse(entry: int, tokens: str) -> list[tuple[int, int, int, str]]:
    """(entry, exit, cost, audit) for the tops that a piece of rows leads to from one."""
    front = (_parse_short if len(tokens) <= 32 else _parse)(TOPS[entry], tokens)
    return [(entry, _PLACE[top], cost, audit) for top, (cost, audit) in front.items()]


def finish(front: dict[int, tuple[int, str]]) -> tuple[int, str]:
    """The least (cost, audit) that ends in a whole conversation."""
    ends = _with_inserts({TOPS[i]: v for i, v in front.items()})
    return min(v for top, v in ends.items() if accepts(top))


def edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str | None, str | None]]:
    """(edit, role, text) of every edit; rows are the conversation's (role, text) in order. Deleted rows have no role and text."""
    due = "user"
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            yield edit, None, None
            continue
        if edit != "K":
            role = due
        due = "assistant" if role[:1] == "u" else "user"
        yield edit, role, text


_FAULTS = {"blank": "x", "duplicate": "x"}
_PIECE = T.StructType(
    [
        *[T.StructField(c, T.LongType()) for c in ("piece", "blank", "duplicate", "truncated", "illegal", "least", "most", "turns")],
        T.StructField("first", T.StringType()),
        T.StructField("last", T.StringType()),
        T.StructField("parses", T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("entry", "exit", "cost")] + [T.StructField("audit", T.StringType())]))),
    ]
)
_COUNTS = ("blank", "duplicate", "truncated", "illegal", "gaps", "cost")
_PLAN = T.StructType([*[T.StructField(c, T.LongType()) for c in _COUNTS], T.StructField("audit", T.StringType())])
_EDIT = [T.StructField("place", T.LongType()), *[T.StructField(c, T.StringType()) for c in ("edit", "role", "text")]]


def _order(conv: str = "conv_id") -> list[Column]:
    return [F.asc_nulls_first(conv), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("digest").asc()]


def _rows_of(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with nulls of the texts as one space, and the digest that orders equal turns and roles."""
    text = F.coalesce(F.col("text"), F.lit(" "))
    out = conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), F.coalesce(F.col("role"), F.lit(" ")).alias("role"), text.alias("text"))
    return out.withColumn("digest", F.unhex(F.sha2("text", 256)))


def _by_conversation(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[bool, object, tuple]]:
    """(first row of its conversation in this task, conversation, columns) of rows that come sorted by it."""
    last: object = _by_conversation  # equals no id
    for batch in batches:
        for conv, *rest in zip(batch.column("conv_id").to_pylist(), *[batch.column(c).to_pylist() for c in columns]):
            yield conv != last, conv, tuple(rest)
            last = conv


class _Piece:
    """What a task sees of a conversation: faults, turns and tokens."""

    def __init__(self, conv: object, piece: int, whole: bool):
        self.conv, self.whole, self.tokens = conv, whole, []
        self.out = {"piece": piece, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "least": None, "most": None, "turns": 0}
        self.out |= {"first": None, "last": None}

    def add(self, turn: int | None, initial: str, fault: str, n: int, repeated: bool) -> None:
        out = self.out
        if turn is not None and turn != out["most"]:
            out |= {"least": turn if out["least"] is None else out["least"], "most": turn, "turns": out["turns"] + 1}
        token = initial if initial in ("s", "u", "a") else "o"
        kept = n if fault == "blank" else (0 if repeated else 1)  # rows that have their own fault
        if fault:
            out[fault] += kept
        if fault != "blank":
            out["duplicate"] += n - kept
        own = _FAULTS.get(fault) or (token.upper() if fault else token)
        self.tokens.append(own * kept + "x" * (n - kept))
        pairs = (n - 1) * (initial * 2 not in LEGAL)
        if out["last"] is not None:
            pairs += out["last"] + initial not in LEGAL
        out |= {"illegal": out["illegal"] + pairs, "first": initial if out["first"] is None else out["first"], "last": initial}

    def row(self) -> dict:
        tokens = "".join(self.tokens)
        entries = [0] if self.whole else range(len(TOPS))
        parses = [dict(zip(("entry", "exit", "cost", "audit"), p)) for e in entries for p in parse(e, tokens)]
        return self.out | {"parses": parses}


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each conversation of a task; the first may have begun in the task before."""
    from pyspark import TaskContext
    from pyspark.sql.pandas.types import to_arrow_type

    kind, task = to_arrow_type(_PIECE), TaskContext.get().partitionId()
    id_kind: pa.DataType | None = None
    held: list[_Piece] = []

    def out(done: list[_Piece]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([p.conv for p in done], id_kind), pa.array([p.row() for p in done], kind)], ["conv_id", "p"])

    def typed() -> Iterator[pa.RecordBatch]:
        nonlocal id_kind
        for batch in batches:
            id_kind = batch.schema.field("conv_id").type
            yield batch

    begun = False
    for new, conv, (turn, initial, fault, n, repeated) in _by_conversation(typed(), ["turn", "initial", "fault", "n", "repeated"]):
        if new:
            if len(held) >= 1000:
                yield out(held)
                held = []
            held.append(_Piece(conv, task, begun))
            begun = True
        held[-1].add(turn, initial, fault, n, repeated)
    if held:
        yield out(held)


class _Joined:
    """Pieces of a conversation, added in their order."""

    def __init__(self) -> None:
        self.sums, self.front = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0), {0: (0, "")}
        self.least = self.most = self.last = None

    def add(self, p: dict) -> None:
        for name in self.sums:
            self.sums[name] += p[name]
        if self.last is not None:
            self.sums["illegal"] += self.last + p["first"] not in LEGAL
        if p["least"] is not None:
            self.sums["turns"] -= p["least"] == self.most
            self.least, self.most = p["least"] if self.least is None else self.least, p["most"]
        self.last = p["last"]
        front: dict[int, tuple[int, str]] = {}
        for q in p["parses"]:
            if q["entry"] in self.front:
                cost, audit = self.front[q["entry"]]
                _merge(front, q["exit"], cost + q["cost"], audit + q["audit"])
        self.front = front

    def row(self) -> dict:
        cost, audit = finish(self.front)
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.sums["turns"]
        return {k: v for k, v in self.sums.items() if k != "turns"} | {"gaps": gaps, "cost": cost, "audit": audit}


def _plans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(_PLAN)
    ids, joined, id_kind = [], [], None

    def out(a: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(ids[:a], id_kind), pa.array([j.row() for j in joined[:a]], kind)], ["conv_id", "p"])

    for batch in batches:
        id_kind = batch.schema.field("conv_id").type
        for conv, piece in zip(batch.column("conv_id").to_pylist(), batch.column("p").to_pylist()):
            if not ids or conv != ids[-1]:
                ids.append(conv)
                joined.append(_Joined())
            joined[-1].add(piece)
        if len(ids) > 1000:  # the last conversation may go on
            yield out(len(ids) - 1)
            ids, joined = ids[-1:], joined[-1:]
    if ids:
        yield out(len(ids))


def repair_plans(conversations: DataFrame) -> DataFrame:
    """Per conv_id with rows: counts of blank, duplicate and truncated rows, illegal neighbours and gaps; cost and audit of the repair.

    ``conversations`` has conv_id, turn, role, text. Rows go by turn, nulls first; equal turns by role, then by the text's digest. A row's
    first fault counts: blank (no character but white space), duplicate (role and text seen earlier), truncated (no [.!?] at the end).
    ``audit`` has an initial for every edit (Keep, Rerole, Delete, Insert), the least of equal cost. Null roles and texts are one space,
    a null conv_id is a conversation, repeated rows are duplicates, an empty table has no plans. Texts of any length leave only a digest
    behind, and a conversation of any length is parsed in pieces. Other columns are not read.
    """
    end = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\f\r"))
    closed = F.substring(end, -1, 1).isin(".", "!", "?")
    fault = F.when(end == "", "blank").when(~closed, "truncated").otherwise("")
    light = _rows_of(conversations).select("conv_id", "turn", "role", "digest", fault.alias("fault"))
    light = light.groupBy("conv_id", "turn", "role", "digest", "fault").agg(F.count(F.lit(1)).alias("n"))
    seen = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = light.groupBy(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest")).agg(F.min(seen).alias("_first"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    marked = light.join(firsts, same).select(
        "conv_id", "turn", "role", "digest", F.substring("role", 1, 1).alias("initial"), "fault", "n", (~F.col("_first.turn").eqNullSafe(F.col("turn"))).alias("repeated")
    )
    conv = conversations.schema["conv_id"]
    dealt = marked.repartitionByRange(*_order()).sortWithinPartitions(*_order())
    pieces = dealt.mapInArrow(_pieces, T.StructType([conv, T.StructField("p", _PIECE)]))
    gathered = pieces.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "p.piece")
    return gathered.mapInArrow(_plans, T.StructType([conv, T.StructField("p", _PLAN)])).select("conv_id", "p.*")


def repaired(conversations: DataFrame, plans: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): every edit of every conversation, deleted rows without role and text.

    The rows of a conversation come one after another in one task; it holds a row at a time.
    """
    rows = _rows_of(conversations).withColumns({"kind": F.lit(1), "audit": F.lit(None).cast("string")})
    nothing = {"turn": F.lit(None).cast("bigint"), "role": F.lit(""), "text": F.lit(""), "digest": F.lit(None).cast("binary"), "kind": F.lit(0)}
    led = plans.select("conv_id", "audit").withColumns(nothing).select(rows.columns).unionByName(rows)
    dealt = led.repartition("conv_id").sortWithinPartitions(_order()[0], "kind", *_order()[1:])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field("conv_id").type
                for at in range(0, batch.num_rows, 256):
                    yield batch.slice(at, 256)

        rows = _by_conversation(typed(), ["audit", "role", "text"])
        held: list[tuple] = []
        for _, conv, (audit, _, _) in rows:  # the leading row; its conversation's rows are taken below
            own = ((role, text) for _, _, (_, role, text) in rows)
            for place, (edit, role, text) in enumerate(edited(audit, own)):
                held.append((conv, place, edit, role, text))
                if len(held) == 256:
                    yield _batch(held, kind)
                    held = []
        if held:
            yield _batch(held, kind)

    conv = conversations.schema["conv_id"]
    return dealt.mapInArrow(apply, T.StructType([conv, *_EDIT]))


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    kinds = [kind, pa.int64(), pa.string(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["conv_id", "place", "edit", "role", "text"])


def digests(rows: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of what ``repaired`` returns, one row at a time: ``role:text`` joined by newlines."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, state, begun, last = None, None, False, None
        done: list[tuple] = []

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field("conv_id").type
                yield batch

        for new, conv, (edit, role, text) in _by_conversation(typed(), ["edit", "role", "text"]):
            if new:
                if state is not None:
                    done.append((last, state.hexdigest()))
                state, begun, last = hashlib.sha256(), False, conv
            if edit != "D":
                state.update(b"\n" * begun + f"{role}:{text}".encode())
                begun = True
        if state is not None:
            done.append((last, state.hexdigest()))
            ids, found = zip(*done)
            yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(found)], ["conv_id", "repaired_sha256"])

    return rows.mapInArrow(add, T.StructType([rows.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())]))


def damaged(conversations: DataFrame) -> DataFrame:
    """The registered query's damage, by a checksum of conversation and turn."""

    def known(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(known("text"), ".!?", "")).otherwise(known("text"))
    role = F.when(fault == 4, "user").otherwise(known("role"))
    times = F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.array_repeat(F.lit(0), times).alias("_times"))
    return rows.withColumn("_times", F.explode("_times")).drop("_times")


@query()
def op13_conversation_repair(spark: SparkSession, d: str) -> DataFrame:
    """Every conversation after damage: its faults and its cheapest repair."""
    conversations = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    rows = damaged(conversations)
    plans = stored(repair_plans(rows), "repair_plans")
    found = digests(repaired(rows, plans))
    every = conversations.select(F.col("conv_id").alias("_every")).distinct()
    out = every.join(plans, F.col("_every").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    out = out.join(found, F.col("_every").eqNullSafe(F.col("conv_id")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    sha = F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256")
    return out.select(F.col("_every").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), sha)
