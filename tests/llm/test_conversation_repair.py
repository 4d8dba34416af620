"""Repairs against a recursion over all edits, right to left."""

import functools
import hashlib
import itertools
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidepanel.llm import conversation_repair as repair
from tidepanel.llm.common import table

STEPS = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def brute_repair(tokens):
    """Tokens: (initial, must go, truncated)."""

    @functools.cache
    def best(i, state, inserts):
        out = [(0, "")] if i == len(tokens) and state in ("", "a") else []
        if inserts < 3:
            for t in "ua":
                if (state, t) in STEPS:
                    cost, audit = best(i, STEPS[state, t], inserts + 1)
                    out.append((cost + 2, "I" + audit))
        if i < len(tokens):
            initial, must_go, truncated = tokens[i]
            cost, audit = best(i + 1, state, 0)
            out.append((cost + 3, "D" + audit))
            for t in "" if must_go else "sua":
                if (state, t) in STEPS:
                    cost, audit = best(i + 1, STEPS[state, t], 0)
                    if t == initial:
                        out.append((cost + truncated, "K" + audit))
                    if t != "s":
                        out.append((cost + truncated + 2, "R" + audit))
        return min(out, default=(10**9, ""))

    for i in reversed(range(len(tokens) + 1)):  # keeps the recursion shallow
        for state in ("", "s", "u", "a"):
            best(i, state, 0)
    return best(0, "", 0)


SPACE = " \t\n\x0b\x0c\r"


def brute(rows, damage=True):
    """Rows (conv_id, turn, role, text) -> conv_id: every column of the query."""
    out = {}
    for conv in {r[0] for r in rows}:
        kept, first = [], lambda x: " " if x is None else str(x)
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            fault = zlib.crc32(f"{first(conv)}:{first(turn)}".encode()) % 20 if damage else 99
            text = {1: "", 2: re.sub("[.!?]", "", first(text))}.get(fault, first(text))
            kept += [(turn, "user" if fault == 4 else first(role), text)] * {0: 0, 3: 2}.get(fault, 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, faults = set(), []
        for _, role, text in kept:
            end = text.rstrip(SPACE)
            faults.append("blank" if not end else "duplicate" if (role, text) in seen else "" if end[-1] in ".!?" else "truncated")
            seen.add((role, text))
        initials = [r[1][:1] for r in kept]
        cost, audit = brute_repair([(i, f in ("blank", "duplicate"), f == "truncated") for i, f in zip(initials, faults)])
        lines, left, state = [], list(kept), ""
        for edit in audit:
            _, role, text = (0, "", "") if edit == "I" else left.pop(0)
            if edit in "RI":
                role = "assistant" if state == "u" else "user"
            if edit != "D":
                state = role[:1]
                lines.append(f"{role}:{text}")
        turns = {r[0] for r in kept} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def found_by(df):
    rows = df.select("conv_id", *COLUMNS).collect()
    out = {r[0]: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("n", range(5))
def test_every_short_conversation(n):
    for tokens in itertools.product("suaoSUAOx", repeat=n):
        plain = [(t.lower(), t == "x", t.isupper()) for t in tokens]
        front = {x: (cost, audit) for _, x, cost, audit in repair.parse(0, "".join(tokens))}
        assert repair.finish(front) == brute_repair(plain)


def test_pieces_join_to_the_whole():
    import random

    pick = random.Random(5)
    for _ in range(60):
        tokens = "".join(pick.choices("suauauaUAoxx", k=pick.randrange(1, 60)))
        joined = repair._Joined()
        at = sorted(pick.sample(range(len(tokens) + 1), min(3, len(tokens))))
        for a, b in zip([0, *at], [*at, len(tokens)]):
            p = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0) | {"first": "u", "last": "a", "least": None}
            parses = [dict(zip(("entry", "exit", "cost", "audit"), q)) for e in range(len(repair.TOPS)) for q in repair.parse(e, tokens[a:b])]
            joined.add(p | {"parses": parses})
        assert repair.finish(joined.front) == brute_repair([(t.lower(), t == "x", t.isupper()) for t in tokens])


def test_long_conversation_in_little_time():
    tokens = "ua" * 50_000 + "aUuxS" * 2_000
    front = {x: (cost, audit) for _, x, cost, audit in repair.parse(0, tokens)}
    cost, audit = repair.finish(front)
    assert len(audit.replace("I", "")) == len(tokens) and audit.startswith("KK" * 49_000) and cost > 0


def test_registered_query(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in table(spark, d, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert found_by(repair.op13_conversation_repair(spark, d)) == brute(rows)


ROWS = [
    *[(1, t, r, x) for t, r, x in [(None, "user", "Late?"), (0, "user", "Hi."), (0, "user", "Hi."), (1, "assistant", "Yes"), (5, None, None), (7, "tool", "x!")]],
    (2, 0, "", " \t\n"),
    (2, 1, "user", " "),
    (None, None, None, None),
    (None, 3, "system", "Be kind. \r\n"),
    (None, 4, "user", "long word " * 20_000 + "?"),
    *[(3, t, "user" if t % 2 else "assistant", f"Turn {t % 50}.") for t in range(300)],
    *[(4, 2, "user", "Copy.")] * 30,
    *[(4, 2, "assistant", f"Tie {i}!") for i in range(4)],
]


def test_edge_cases_and_a_conversation_over_many_pieces(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "conv_id long, turn int, role string, text string")
    df = df.withColumns({"audit": F.lit("x"), "place": F.lit(1), "n": F.lit(2), "p": F.lit(0), "kind": F.lit(5)})
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keeps all of the partitions
    try:
        plans = repair.repair_plans(df).persist()
        sha = repair.digests(repair.repaired(df, plans))
        found = found_by(plans.join(sha.withColumnRenamed("conv_id", "c"), F.col("c").eqNullSafe(F.col("conv_id"))))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert found == brute(ROWS, damage=False)
    # All that the damage leaves is repaired, and a conversation of which nothing is left has its row.
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    gone = next(i for i in range(10**6) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    spark.createDataFrame([(gone, 0, "user", "A.")], "conv_id long, turn int, role string, text string").select("*", *[F.lit(1).alias(c) for c in ("audit", "place", "n", "p", "kind")]).withColumn("audit", F.lit("x")).write.mode("append").parquet(f"{tmp_path}/conversations.parquet")
    assert found_by(repair.op13_conversation_repair(spark, str(tmp_path))) == brute([*ROWS, (gone, 0, "user", "A.")])
    rows = repair.repaired(df, plans).where("edit != 'D'").orderBy("conv_id", "place").collect()
    for conv in {r[0] for r in ROWS}:
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[:1] for r in rows if r.conv_id == conv))


def test_empty_table(spark):
    empty = spark.createDataFrame(ROWS, "conv_id long, turn int, role string, text string").limit(0)
    plans = repair.repair_plans(empty)
    assert plans.collect() == [] and repair.digests(repair.repaired(empty, plans)).collect() == []
