"""Cost-balanced packing of tokenised documents into sequences (operator 6).

Attention makes a piece of n tokens cost ``LINEAR * n + QUADRATIC * n * n``. Each task packs what it reads, a
group of some hundred sequences at a time: lengths are known when a group closes, so the number of
sequences is exactly what the tokens fill, and the rest of the group is cut into sequences whose lengths are powers
of two, which need no padding. Pieces go in descending order to the sequence of the lowest cost that has room;
only where none has room for the whole piece it is cut. Nothing is shuffled, and a task holds one group.
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

CAPACITY = 4096
GROUP_TOKENS = 256 * CAPACITY
LINEAR = 1.0
QUADRATIC = 1.0 / 4096
END = 2
_LATIN = "a-zß-öø-ɏ"
_SIGNS = r"!-&(-/:;=-@\[-`{-~"  # ASCII without apostrophe and <
_PLAIN = re.compile(f"[{_LATIN}0-9{_SIGNS}]+")
_PARTS = re.compile(f"[{_LATIN}]+|[0-9]|[{_SIGNS}]+")
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


class WordIds(dict):
    """Ids of words between ASCII white space, which the tokenizer never joins; at most ``bound`` words are held.

    A plain word falls into runs of Latin letters, digits and runs of ASCII signs, as the tokenizer cuts it; the model is asked for each such
    part. A word with anything else (an apostrophe, other scripts, the start of a special token) goes through the whole tokenizer.
    """

    def __init__(self, path: str, bound: int = 400_000):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.bound = bound
        cut = ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes_of = {c: cut.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x250)}

    def part(self, part: str) -> bytes:
        key = part.encode()
        found = self.get(key)
        if found is None:
            raw = part if part.isascii() else part.translate(self.bytes_of)
            found = self[key] = np.array([t.id for t in self.model.tokenize(raw)], "<u4").tobytes()
        return found

    def learn(self, given: list[bytes]) -> None:
        found = self._encoded([*map(bytes.decode, given)])
        self.update(zip(given, found, strict=True))

    def encode(self, words: list[str]) -> list[bytes]:
        """The ids of words that a caller keeps; only their parts stay here."""
        if len(self) > self.bound:
            self.clear()
        return self._encoded(words)

    def _encoded(self, words: list[str]) -> list[bytes]:
        found, other = [], []
        for place, word in enumerate(words):
            low = word.lower()
            if _PLAIN.fullmatch(low):
                found.append(b"".join(map(self.part, _PARTS.findall(low))))
            else:
                found.append(b"")
                other.append(place)
        for place, whole in zip(other, self.tokenizer.encode_batch_fast([words[i] for i in other], add_special_tokens=False), strict=True):
            found[place] = np.array(whole.ids, "<u4").tobytes()
        return found

    def of(self, text: str) -> np.ndarray:
        words = text.encode().split()
        new = [w for w in set(words) if w not in self]
        if len(self) + 2 * len(new) > self.bound:
            self.clear()
            new = list(set(words))
        self.learn(new)
        return np.frombuffer(b"".join(map(self.__getitem__, words)), "<u4")


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One cache for all tasks of a worker."""
    return WordIds(path)


def capacities(tokens: int, capacity: int = CAPACITY) -> list[int]:
    """Full sequences, then the binary digits of what is left, largest first."""
    rest = tokens % capacity
    return [capacity] * (tokens // capacity) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def assign(lengths: list[int], capacity: int = CAPACITY) -> Iterator[tuple[int, int, int, int, int]]:
    """Pieces as (document, start, length, sequence, offset).

    Descending documents, ties in the given order; a document longer than a sequence gives full pieces first.
    """
    room = np.array(capacities(sum(lengths), capacity), np.int64)
    size, cost = room.copy(), np.zeros(len(room))
    parts = [(min(capacity, n - at), i, at) for i, n in enumerate(lengths) for at in range(0, n, capacity)]
    parts.sort(key=lambda p: (-p[0], p[1], p[2]))
    for n, doc, start in parts:
        while n:
            fits = room >= n
            if fits.any():
                to = int(np.argmin(np.where(fits, cost, np.inf)))
            else:  # cut; the sequence with most room leaves the fewest pieces
                to = int(np.argmax(room))
            take = min(n, int(room[to]))
            yield doc, start, take, to, int(size[to] - room[to])
            room[to] -= take
            cost[to] += LINEAR * take + QUADRATIC * take * take
            start, n = start + take, n - take


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: its document, ``start`` and ``length`` in it, ``ids`` (little-endian unsigned 32-bit),
    the sequence and the offset there.

    Every document ends in id 2, so a null or empty text is one token. Repeated rows and null ids are documents
    like others. An empty table gives an empty result; other columns are ignored. ``sequence_id`` is the number of
    the task times 2^32 plus a number within it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer_path)
        keys: list[int | None] = []
        held: list[np.ndarray] = []
        tokens, base = 0, TaskContext.get().partitionId() << 32

        def close() -> pa.RecordBatch:
            nonlocal base, tokens
            out = []
            for doc, start, n, to, offset in assign([len(h) for h in held], capacity):
                raw = held[doc][start : start + n].tobytes()
                out.append((keys[doc], start, n, zlib.crc32(raw), len(held[doc]), base + to, offset, raw))
            base += len(capacities(tokens, capacity))
            keys.clear()
            held.clear()
            tokens = 0
            kinds = [pa.int64()] * 7 + [pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=[f.split()[0] for f in SCHEMA.split(", ")])

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(words.of(text or ""), np.uint32(END)).astype("<u4")
                keys.append(key)
                held.append(ids)
                tokens += len(ids)
                if tokens >= GROUP_TOKENS:
                    yield close()
        if held:
            yield close()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, SCHEMA)


