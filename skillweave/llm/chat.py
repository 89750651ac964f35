"""Conversations from reply trees, with a reversible chat template (operator 9).

Messages name the message they reply to. Iterative self-joins give every message its ancestors at distances one, two, four and so on, so
the rounds grow with the logarithm of the longest branch. Leaves are ranked by the score of their branch, and the
messages of the chosen branches are found from the same pointers, the largest distance first. No row ever holds a path before it is formatted.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skillweave.llm.common import map_batches
from skillweave.session import written

# The template: a turn is OPEN role SEP text CLOSE. Inside roles and texts these two letters of the markers are escaped.
OPEN, SEP, CLOSE = "<|turn|>", "<|text|>", "<|end|>"
_ESCAPES = {"&": "&amp;", "<": "&lt;", "[": "&lsqb;"}
_BACK = {v: k for k, v in _ESCAPES.items()}
_TURN = re.compile(re.escape(OPEN) + "(.*?)" + re.escape(SEP) + "(.*?)" + re.escape(CLOSE), re.S)


def escape(text: str) -> str:
    return re.sub("[&<\\[]", lambda m: _ESCAPES[m[0]], text)


def unescape(text: str) -> str:
    return re.sub("&amp;|&lt;|&lsqb;", lambda m: _BACK[m[0]], text)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the spans under the loss mask: the texts of the assistant, nothing of the template."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escape(role)}{SEP}", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def best_branches(messages: DataFrame, branches: int = 1) -> DataFrame:
    """``tree_id, branch, depth, role, text`` of the best ``branches`` root-to-leaf paths of every tree.

    ``messages``: ``tree_id, node_id, parent_id`` (null at a root), ``role, text, score``. The score of a branch is the sum of its messages' (null: 0);
    ties go to the smaller leaf. Node ids are unique within a tree; a parent that isn't there makes a root. Messages on a cycle hang on no root and are
    left out.
    """
    nodes = written(messages.select("tree_id", "node_id", "parent_id", "role", "text", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")), "messages")
    known = nodes.select(F.col("tree_id").alias("t"), F.col("node_id").alias("up"))
    same = F.col("tree_id").eqNullSafe(F.col("t"))
    # jump: the ancestor 2^k steps up, null beyond the root; steps and total: of the way that the jumps so far have gone.
    jump = nodes.join(known, same & (F.col("parent_id") == F.col("up")), "left").select("tree_id", "node_id", "up", F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("steps"), F.col("score").alias("total"))
    jump = written(jump, "jumps")
    rounds = [jump]
    limit = max(1, jump.where("up IS NOT NULL").count()).bit_length() + 1
    while len(rounds) <= limit and not jump.where("up IS NOT NULL").isEmpty():
        far = jump.select(F.col("tree_id").alias("t"), F.col("node_id").alias("n"), F.col("up").alias("further"), F.col("steps").alias("more"), F.col("total").alias("sum"))
        met = jump.where("up IS NOT NULL").join(far, same & (F.col("up") == F.col("n")), "left")
        moved = met.select("tree_id", "node_id", F.col("further").alias("up"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), (F.col("total") + F.coalesce("sum", F.lit(0.0))).alias("total"))
        jump = written(moved.unionByName(jump.where("up IS NULL")), "jumps")
        rounds.append(jump)
    rooted = rounds[-1].where("up IS NULL").select("tree_id", "node_id", F.col("steps").alias("depth"), "total")
    parents = rounds[0].where("up IS NOT NULL").select(F.col("tree_id").alias("t"), F.col("up").alias("n")).distinct()
    leaves = rooted.join(parents, same & (F.col("node_id") == F.col("n")), "left_anti")
    rank = F.row_number().over(Window.partitionBy("tree_id").orderBy(F.desc("total"), "node_id"))
    found = leaves.withColumn("branch", rank).where(F.col("branch") <= branches).select("tree_id", "branch", "node_id", "depth")
    found = written(found, "branches")
    for k in range(len(rounds) - 2, -1, -1):
        step = rounds[k].where("up IS NOT NULL").select(F.col("tree_id").alias("t"), F.col("node_id").alias("n"), "up")
        more = found.join(step, same & (F.col("node_id") == F.col("n"))).select("tree_id", "branch", F.col("up").alias("node_id"), (F.col("depth") - 2**k).alias("depth"))
        found = written(found.unionByName(more), "branches")
    body = nodes.select(F.col("tree_id").alias("t"), F.col("node_id").alias("n"), "role", "text")
    return found.join(body, same & (F.col("node_id") == F.col("n"))).select("tree_id", "branch", "depth", "role", "text")


def formatted(paths: DataFrame) -> DataFrame:
    """``tree_id, branch, formatted, loss_spans`` (start and end in code points), one row per path."""
    turn = F.struct("depth", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = paths.groupBy("tree_id", "branch").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def run(batch: pa.RecordBatch) -> dict:
        made = [format_turns([(t["role"], t["text"]) for t in turns]) for turns in batch.column(2).to_pylist()]
        spans = [[{"start": a, "end": b} for a, b in s] for _, s in made]
        return {"tree_id": batch.column(0), "branch": batch.column(1), "formatted": [f for f, _ in made], "loss_spans": spans}

    return map_batches(grouped, run, "tree_id long, branch int, formatted string, loss_spans array<struct<start:int,end:int>>")


def linear_trees(conversations: DataFrame) -> DataFrame:
    """A conversation as a tree without forks: each turn replies to the one before it. Equal turns go by role and text."""
    order = Window.partitionBy("tree_id").orderBy("turn", "role", "text")
    rows = conversations.select(F.col("conv_id").cast("long").alias("tree_id"), F.col("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    placed = rows.withColumn("node_id", F.row_number().over(order).cast("long"))
    return placed.select("tree_id", "node_id", F.when(F.col("node_id") > 1, F.col("node_id") - 1).alias("parent_id"), "role", "text", F.lit(0.0).alias("score"))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """``tree_id, branch, formatted, loss_spans`` of every conversation.

    Rows go by turn; null roles and texts are empty; null conversation ids are one conversation. Repeated rows are turns of their own. An
    empty table gives an empty result; other columns are ignored.
    """
    return formatted(best_branches(linear_trees(conversations)))


def read_back(made: DataFrame) -> DataFrame:
    """What the formatted text alone says: turns and the text under the loss mask, both unescaped."""

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            turns = read_turns(text)
            loss = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
            out["n_turns"].append(len(turns))
            out["turns_sha256"].append(hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest())
            out["loss_chars"].append(len(loss))
            out["loss_sha256"].append(hashlib.sha256(loss.encode()).hexdigest())
            out["formatted_chars"].append(len(text))
        return out | {"conv_id": batch.column(0)}

    return map_batches(made.select("tree_id", "formatted", "loss_spans"), run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
