"""Operator 11 against a plain reading of its rules and against all edit sequences."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

from skillweave.llm import repair as R

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        role = "user" if code == 4 else role
        out += [(conv, turn, role, text)] * (2 if code == 3 else 1)
    return out


def all_sequences(rows, spare=3):
    """The cheapest (cost, audit) over every edit string with up to ``spare`` inserts beyond the rows."""
    seen = set()
    faults = [R.first_fault(r, t, seen) for r, t in rows]
    best = None
    for size in range(len(rows), len(rows) + spare + 1):
        for edits in itertools.product("DIKR", repeat=size):
            if sum(c != "I" for c in edits) != len(rows):
                continue
            state, at, cost = R.START, 0, 0
            for c in edits:
                if c == "I":
                    state, cost = R._moved(state), cost + 3
                    continue
                (role, _), fault = rows[at], faults[at]
                at += 1
                if c == "D":
                    cost += 4
                    continue
                if fault in ("blank", "duplicate"):
                    break
                cost += 3 if fault == "truncated" else 0
                if c == "K":
                    state = R._kept(state, role[:1])
                    if state is None:
                        break
                else:
                    state, cost = R._moved(state), cost + 3
            else:
                if state in R._ACCEPT and (best is None or (cost, "".join(edits)) < best):
                    best = (cost, "".join(edits))
    return best


def test_dp_equals_all_sequences():
    rng = random.Random(7)
    roles, texts = ["system", "user", "assistant", " ", "tool", ""], ["hi.", "hi", "", " ", "ok!", "why?\n"]
    for _ in range(250):
        rows = [(rng.choice(roles), rng.choice(texts)) for _ in range(rng.randint(0, 4))]
        cost, edits, _ = R.audit(rows)
        assert (cost, edits) == all_sequences(rows), rows


def test_long_conversation_is_linear():
    rows = [("user" if i % 3 else "assistant", f"text {i % 50}") for i in range(30_000)]
    cost, edits, faults = R.audit(rows)
    assert len(edits) >= len(rows) and faults.count("duplicate") == 30_000 - len(set(rows))


def test_query_rows_equal_plain_reading(spark):
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None]), rng.choice(["a.", "b", None, "", "a."]))
            for c in [1, 2, 3, None] for t in [*range(rng.randint(1, 6)), None]]
    rows += [(9, 4, "user", "x.")]  # 9:4 is dropped by damage: the conversation keeps its row
    rows += [(c, 1, "user", "extra") for c in range(10, 40)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("role2", R.F.lit(1))
    got = {r.conv_id: tuple(r)[1:] for r in R.repair(frame).collect()}
    damaged = plain_damage(rows)
    assert set(got) == {r[0] for r in rows}
    for conv in got:
        mine = sorted([r for r in damaged if r[0] == conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        body = [(r[2], r[3]) for r in mine]
        if not mine:
            assert got[conv] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
            continue
        assert got[conv] == R.summary(conv, [r[1] for r in mine], body)[1:]
        assert got[conv][5:7] == all_sequences(body, 2) or len(body) > 5


def test_empty_table(spark):
    assert R.repair(spark.createDataFrame([], SCHEMA)).count() == 0
