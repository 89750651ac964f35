"""Conversation structure repair by a persistent audit DP (operator 11).

A repaired conversation has role initials ``(s?(ua)+)?``. Each row is kept, given the role user or assistant, or deleted, and
empty user or assistant turns may be inserted anywhere; the cheapest edit sequence wins, ties to the ASCII-least audit string.

The DP walks the rows of one conversation once, with one cell per state of the pattern. A cell holds a cost and its audit string
as a node of a persistent trie: a string and all its prefixes share nodes, and equal strings are the same node, since a node is
only ever made as the child of its parent. Each node keeps its ancestors at distances 1, 2, 4, ... and a rolling hash of its
prefix. Two candidates of equal cost are compared by the longest common prefix of their strings, found by binary lifting over the
ancestors' hashes; a hash that agrees is verified by identity of the nodes, so a collision cannot decide a tie. A comparison costs
the logarithm of the conversation's length, and a row costs a bounded number of them.

Spark damages the rows, deals them by conversation and sorts them; the DP streams each conversation of a task. The digest of the
repaired conversation covers its whole text in order, so a conversation is read in one place: a very long conversation is one task,
linear in its rows.
"""

from __future__ import annotations

import hashlib
import weakref
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the contract: prices of the edits and the legal pairs of adjacent role initials.
KEEP, REROLE, DELETE, INSERT, TRUNCATED_EXTRA = 0, 3, 4, 3, 3
LEGAL_PAIRS = {"su", "ua", "au"}
_SPACE = " \t\n\x0b\x0c\r"
_ENDS = ".!?"
# States of the pattern (s?(ua)+)?: nothing yet, after s, after u, after a. Ends in nothing yet or after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
_ACCEPT = (START, AFTER_A)
_MOD, _BASE = (1 << 61) - 1, 131
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

SCHEMA = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class Node:
    """One audit string: its last letter, parent, length, rolling hash and ancestors at distances 2^k; a string has one node while it is held."""

    __slots__ = ("ch", "parent", "depth", "h", "up", "kids", "__weakref__")

    def __init__(self, ch: str, parent: Node | None):
        self.ch, self.parent, self.kids = ch, parent, None
        if parent is None:
            self.depth, self.h, self.up = 0, 0, []
        else:
            self.depth, self.h = parent.depth + 1, (parent.h * _BASE + ord(ch)) % _MOD
            up = [parent]
            while len(up[-1].up) >= len(up):
                up.append(up[-1].up[len(up) - 1])
            self.up = up

    def child(self, ch: str) -> Node:
        if self.kids is None:
            self.kids = weakref.WeakValueDictionary()  # a string nobody holds any more may go
        kid = self.kids.get(ch)
        if kid is None:
            kid = self.kids[ch] = Node(ch, self)
        return kid

    def ancestor(self, depth: int) -> Node:
        node, k, rise = self, 0, self.depth - depth
        while rise:
            if rise & 1:
                node = node.up[k]
            rise >>= 1
            k += 1
        return node

    def text(self) -> str:
        out, node = [], self
        while node.parent is not None:
            out.append(node.ch)
            node = node.parent
        return "".join(reversed(out))


class Trie:
    """The root of the audit strings and a count of hash collisions met while comparing."""

    def __init__(self):
        self.root, self.collisions = Node("", None), 0

    def same(self, a: Node, b: Node) -> bool:
        if a.h != b.h:
            return False
        if a is b:
            return True
        self.collisions += 1
        return False

    def lcp(self, a: Node, b: Node) -> int:
        """Length of the longest common prefix of two strings."""
        m = min(a.depth, b.depth)
        a, b = a.ancestor(m), b.ancestor(m)
        if self.same(a, b):
            return m
        for k in range(len(a.up) - 1, -1, -1):
            if k < len(a.up) and not self.same(a.up[k], b.up[k]):
                a, b = a.up[k], b.up[k]
        return a.depth - 1

    def compare(self, p1: Node, c1: str, p2: Node, c2: str) -> int:
        """Order of the strings p1 + c1 and p2 + c2: -1, 0 or 1."""
        if p1 is p2:
            return (c1 > c2) - (c1 < c2)
        at = self.lcp(p1, p2)

        def letter(p: Node, c: str, i: int) -> str:
            return p.ancestor(i + 1).ch if i < p.depth else c if i == p.depth else ""

        while True:
            x, y = letter(p1, c1, at), letter(p2, c2, at)
            if x != y or not x:
                return (x > y) - (x < y)
            at += 1


def first_fault(role: str, text: str, seen: set) -> str:
    """``blank``, ``duplicate``, ``truncated`` or ``""``; ``seen`` learns the row."""
    if not text.strip(_SPACE):
        return "blank"
    if (role, text) in seen:
        return "duplicate"
    seen.add((role, text))
    return "truncated" if text.rstrip(_SPACE)[-1] not in _ENDS else ""


def _kept(state: int, initial: str) -> int | None:
    if initial == "s" and state == START:
        return AFTER_S
    if initial == "u" and state != AFTER_U:
        return AFTER_U
    if initial == "a" and state == AFTER_U:
        return AFTER_A
    return None


def _moved(state: int) -> int:
    """Where a reroled or inserted turn leads: a user turn, unless an assistant turn is due."""
    return AFTER_A if state == AFTER_U else AFTER_U


def audit(rows: list[tuple[str, str]], trie: Trie | None = None) -> tuple[int, str, list[str]]:
    """Cost, audit string and faults of ``rows`` (role, text), in order."""
    trie = trie or Trie()
    cells: list[tuple[int, Node] | None] = [(0, trie.root), None, None, None]

    def offer(into: list, state: int, cost: int, parent: Node, ch: str) -> None:
        held = into[state]
        if held is not None:
            if cost > held[0]:
                return
            if cost == held[0] and trie.compare(parent, ch, held[1].parent, held[1].ch) >= 0:
                return
        into[state] = (cost, parent.child(ch))

    def inserts(into: list) -> None:
        changed = True
        while changed:
            changed = False
            for state in range(4):
                if into[state] is not None:
                    before = into[_moved(state)]
                    offer(into, _moved(state), into[state][0] + INSERT, into[state][1], "I")
                    changed |= into[_moved(state)] is not before

    inserts(cells)
    faults, seen = [], set()
    for role, text in rows:
        fault = first_fault(role, text, seen)
        faults.append(fault)
        extra = TRUNCATED_EXTRA if fault == "truncated" else 0
        new: list[tuple[int, Node] | None] = [None] * 4
        for state, cell in enumerate(cells):
            if cell is None:
                continue
            cost, node = cell
            offer(new, state, cost + DELETE, node, "D")
            if fault in ("blank", "duplicate"):
                continue
            to = _kept(state, role[:1])
            if to is not None:
                offer(new, to, cost + KEEP + extra, node, "K")
            offer(new, _moved(state), cost + REROLE + extra, node, "R")
        inserts(new)
        cells = new
    best = None
    for state in _ACCEPT:
        cell = cells[state]
        if cell is not None and (best is None or cell[0] < best[0] or (cell[0] == best[0] and trie.compare(cell[1].parent, cell[1].ch, best[1].parent, best[1].ch) < 0)):
            best = cell
    return best[0], best[1].text(), faults


def repaired(rows: list[tuple[str, str]], edits: str) -> list[str]:
    """``role:text`` of the repaired conversation: the audit replayed over the rows."""
    out, state, at = [], START, 0
    for ch in edits:
        if ch == "I":
            state = _moved(state)
            out.append(("user" if state == AFTER_U else "assistant") + ":")
            continue
        role, text = rows[at]
        at += 1
        if ch == "K":
            state = _kept(state, role[:1])
            out.append(f"{role}:{text}")
        elif ch == "R":
            state = _moved(state)
            out.append(("user" if state == AFTER_U else "assistant") + ":" + text)
    return out


def summary(conv_id: int | None, turns: list[int | None], rows: list[tuple[str, str]]) -> tuple:
    """One output row of a conversation whose rows (after damage) are in order."""
    known = [t for t in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    initials = [role[:1] for role, _ in rows]
    illegal = sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:]))
    cost, edits, faults = audit(rows)
    digest = hashlib.sha256("\n".join(repaired(rows, edits)).encode()).hexdigest()
    return (conv_id, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, edits, digest)


def damage(conversations: DataFrame) -> DataFrame:
    """The rows after damage: by crc32 of ``conv_id:turn`` mod 20 (a null written as one space), 0 drops a row, 1 empties its
    text, 2 removes its ``.!?``, 3 repeats it with the same turn, 4 makes it a user turn. Null roles and texts are one space."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    code = F.pmod(F.crc32(key), F.lit(20))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), code.alias("code"))
    rows = rows.where("code <> 0")
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("code") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("code") == 1, F.lit("")).when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def repair(conversations: DataFrame) -> DataFrame:
    """One row per conversation id of ``conversations`` (``conv_id, turn, role, text``; other columns are ignored), null ids
    forming one conversation: ``gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    Rows are damaged as ``damage`` says, then ordered by turn (nulls first), role and text; equal rows are interchangeable.
    A conversation without rows after damage has zeros, an empty audit and the SHA-256 of the empty string. An empty table
    gives an empty result. Role initials are the first character of the role, whatever its case.
    """
    rows = damage(conversations)
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        key, turns, held, started = None, [], [], False
        for batch in batches:
            for conv, turn, role, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if started and conv != key:
                    out.append(summary(key, turns, held))
                    turns, held = [], []
                    if len(out) >= 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
                        out = []
                key, started = conv, True
                turns.append(turn)
                held.append((role, text))
        if started:
            out.append(summary(key, turns, held))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    found = dealt.select("conv_id", "turn", "role", "text").mapInArrow(run, SCHEMA)
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    lost = ids.join(found.select("conv_id"), ids.conv_id.eqNullSafe(found.conv_id), "left_anti")
    zero = F.lit(0).cast("long")
    empty = lost.select("conv_id", *[zero.alias(n) for n in names[1:7]], F.lit("").alias("audit"), F.lit(EMPTY_SHA).alias("repaired_sha256"))
    return found.unionByName(empty)
