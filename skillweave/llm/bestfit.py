"""Best-fit decreasing packing with a segment tree over remaining capacities (operator 12).

A document is its token ids and an end id. Documents longer than a sequence are cut into full pieces, the first piece taking the
rest, so only the first piece of a long document can be shorter than a sequence. Full pieces fill a sequence each. The other pieces
go in descending length to the open sequence whose remaining room is the smallest that still holds them. Open sequences are
kept by their remaining room in a segment tree over the room values 0 to ``capacity``: a leaf holds the sequences with that room, an
inner node counts the sequences below it, and the tightest room at least ``n`` is found by one walk down, in time logarithmic
in the capacity.

Each task tokenises and packs what it reads, a group of at most ``GROUP_PIECES`` pieces at a time; nothing is shuffled and a task
holds only (document, piece, length, checksum) of its group, never the token ids of more than one batch.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 1024
END = 2
GROUP_PIECES = 1 << 20
SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, doc_tokens long"


class Rooms:
    """Open sequences by remaining room, in a segment tree over the room values 0 to ``capacity``."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.held: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, sequence: int) -> None:
        self.held[room].append(sequence)
        at = room + self.size
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, sequence) of a sequence with the smallest room of at least ``need``, taken out of the tree; None if there is none."""
        count, size = self.count, self.size
        if need >= size or count[1] == 0:
            return None
        # climb from the leaf of ``need``; the first right sibling with sequences holds the answer, unless the leaf itself does
        at = need + size
        if count[at] == 0:
            while at > 1 and (at & 1 or count[at + 1] == 0):
                at >>= 1
            if at == 1:
                return None
            at += 1
            while at < size:
                at = 2 * at if count[2 * at] else 2 * at + 1
        room = at - size
        sequence = self.held[room].pop()
        while at:
            count[at] -= 1
            at >>= 1
        return room, sequence


def pieces_of(total: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document of ``total`` ids: whole if it fits, else the rest first and then full pieces."""
    if total <= capacity:
        return [(0, total)]
    first = total % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, total, capacity)]


def best_fit(lengths: list[int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int]], int]:
    """(sequence, offset) of each piece, and the number of sequences: best fit in descending length, ties in the given order."""
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    rooms, placed, made, fill = Rooms(capacity), [(0, 0)] * len(lengths), 0, []
    for i in order:
        n = lengths[i]
        found = rooms.take(n)
        if found is None:
            sequence, made = made, made + 1
            fill.append(0)
        else:
            sequence = found[1]
        placed[i] = (sequence, fill[sequence])
        fill[sequence] += n
        if fill[sequence] < capacity:
            rooms.add(capacity - fill[sequence], sequence)
    return placed, made


class Pieces(dict):
    """Ids of text pieces that start at a safe cut (see ``Encoder``); a missing piece is cut into pre-tokens by the pattern."""

    def __init__(self, coder: Encoder):
        super().__init__()
        self.coder = coder

    def __missing__(self, piece: str) -> bytes:
        coder = self.coder
        if len(self) >= coder.bound:
            kept = list(self.items())[coder.bound // 2 :]  # the older half is forgotten
            self.clear()
            self.update(kept)
        if piece.isalpha() or (piece[:1] == " " and piece[1:].isalpha()):  # letters, with a space or not, are one pre-token
            found = coder.word(piece)
        else:
            found = b"".join(map(coder.word, coder.pattern.findall(piece)))
        self[piece] = found
        return found


class Encoder:
    """Ids of the byte-level tokenizer with a cache per worker.

    The tokenizer cuts a text at its special token, then by its pattern into pre-tokens, and merges bytes inside each pre-token
    alone. A space between two characters that are not white space always begins a pre-token, and what follows it is cut the same
    way alone as in the text; so texts are cut there first (a cheap split), and the ids of each piece are kept, at most ``bound`` of
    them, like those of each pre-token. Beyond the bound the older half is forgotten.
    """

    def __init__(self, path: str, bound: int = 1_000_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        import json

        import regex
        from tokenizers import Tokenizer

        config = json.load(open(path, encoding="utf-8"))
        cut = config["pre_tokenizer"]
        if cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True) or config.get("normalizer"):
            raise ValueError("a byte-level tokenizer without normalizer or prefix space is expected")
        self.model = Tokenizer.from_file(path).model
        self.special = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in config["added_tokens"]}
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        # Fixed values of the byte-level format: its pre-token pattern, and the printable bytes that stand for themselves.
        self.pattern = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
        shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
        extra = [b for b in range(256) if b not in shown]
        self.byte_char = str.maketrans({chr(b): chr(b) for b in shown} | {chr(b): chr(256 + i) for i, b in enumerate(extra)})
        self.safe = re.compile(r"(?<=\S)(?= \S)")
        self.unsafe = re.compile(r"\s | \s")
        self.words: dict[str, bytes] = {}
        self.pieces = Pieces(self)
        self.bound = bound

    def word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            if len(self.words) >= self.bound:
                self.words = dict(list(self.words.items())[self.bound // 2 :])
            mapped = word.encode().decode("latin-1").translate(self.byte_char)
            found = self.words[word] = np.array([t.id for t in self.model.tokenize(mapped)], "<u4").tobytes()
        return found

    def encode(self, text: str) -> np.ndarray:
        """Ids of ``text`` and then the end id, as little-endian unsigned 32-bit."""
        parts = self.split.split(text) if self.split else [text]
        out = []
        for i, part in enumerate(parts):
            if i % 2:
                out.append(self.special[part])
            elif part:
                chunks = part.split(" ")
                if chunks[0] and chunks[-1] and self.unsafe.search(part) is None:  # every space is a safe cut
                    chunks[1:] = [" " + c for c in chunks[1:]]
                else:
                    chunks = self.safe.split(part)
                out += map(self.pieces.__getitem__, chunks)
        out.append(_END)
        return np.frombuffer(b"".join(out), "<u4")

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [self.encode(t) for t in texts]


_END = np.array([END], "<u4").tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One tokenizer for all tasks of a worker."""
    return Encoder(path)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ``doc_id, piece`` (from 0), ``start`` (ids of its document before it), ``length``, ``ids_crc32`` (CRC-32 of
    its ids as little-endian unsigned 32-bit), ``sequence_id``, ``offset`` (place in the sequence, gapless from 0), ``doc_tokens``.

    Ids come from the tokenizer without special tokens, then id 2; a null or empty text is one id. Repeated rows and null ids are
    documents like others. An empty table gives no rows; other columns are ignored. ``sequence_id`` is the task's number times
    2^32 plus a number within it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer_path)
        group: list[tuple] = []
        base = TaskContext.get().partitionId() << 32

        def close() -> pa.RecordBatch:
            nonlocal base
            placed, made = best_fit([g[3] for g in group], capacity)
            cols = list(zip(*[(*g[:4], g[4], base + s, o, g[5]) for g, (s, o) in zip(group, placed, strict=True)], strict=True))
            base += made
            group.clear()
            kinds = [pa.int64(), pa.int32()] + [pa.int64()] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[f.split()[0] for f in SCHEMA.split(", ")])

        for batch in batches:
            keys = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for key, ids in zip(keys, coder.ids(texts), strict=True):
                for number, (start, length) in enumerate(pieces_of(len(ids), capacity)):
                    group.append((key, number, start, length, zlib.crc32(ids[start : start + length].tobytes()), len(ids)))
            if len(group) >= GROUP_PIECES:
                yield close()
        if group:
            yield close()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, SCHEMA)
