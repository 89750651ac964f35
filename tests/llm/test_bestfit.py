"""Operator 12: pieces against the tokenizer, places against a plain best fit."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from skillweave.llm import bestfit as B

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain_best_fit(lengths, capacity=B.CAPACITY):
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    fill, placed, by_room = [], [None] * len(lengths), defaultdict(list)
    for i in order:
        rooms = [capacity - f for f in fill if capacity - f >= lengths[i] and f < capacity]
        if rooms:
            s = by_room[min(rooms)].pop()
        else:
            s = len(fill)
            fill.append(0)
        placed[i] = (s, fill[s])
        fill[s] += lengths[i]
        if fill[s] < capacity:
            by_room[capacity - fill[s]].append(s)
    return placed, len(fill)


def test_tree_equals_plain_best_fit():
    rng = random.Random(5)
    for _ in range(150):
        lengths = [rng.choice([rng.randint(1, 1024), rng.randint(1, 40), 1024, 1023, 512, 1]) for _ in range(rng.randint(0, 250))]
        assert B.best_fit(lengths) == plain_best_fit(lengths)


def test_pieces_of_long_documents():
    assert B.pieces_of(1) == [(0, 1)] and B.pieces_of(1024) == [(0, 1024)]
    assert B.pieces_of(1025) == [(0, 1), (1, 1024)] and B.pieces_of(2048) == [(0, 1024), (1024, 1024)]


def test_query_covers_every_id(spark):
    texts = [None, "", "a b. <|endoftext|> é", "word " * 3000, "word " * 3000, "x" * 5000] + [f"text {i} " * (i % 300) for i in range(200)]
    rows = [(i if i != 3 else None, t, "other") for i, t in enumerate(texts)]
    got = B.pack(spark.createDataFrame(rows, "doc_id long, text string, lang string"), PATH).collect()
    tokenizer = Tokenizer.from_file(PATH)
    want = {}
    for key, text, _ in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        want.setdefault(key, []).append(ids)
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
    for key, docs in want.items():
        pieces = sorted(by_doc[key], key=lambda r: (r.doc_tokens, r.start))
        assert len(pieces) == sum(len(B.pieces_of(len(d))) for d in docs)
        for d in docs:
            mine = [p for p in pieces if p.doc_tokens == len(d)]
            assert {(p.start, p.length, p.ids_crc32) for p in mine} >= {(s, n, zlib.crc32(d[s : s + n].tobytes())) for s, n in B.pieces_of(len(d))}
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for placed in sequences.values():
        placed.sort()
        assert placed[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(placed, placed[1:])) and sum(n for _, n in placed) <= 1024


def test_empty_table(spark):
    assert B.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
