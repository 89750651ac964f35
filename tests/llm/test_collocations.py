"""Operator 13: the filter's parts against plain numbers, the query against its SQL twin on odd rows."""

from __future__ import annotations

import random

import duckdb
import numpy as np
import pandas as pd

from skillweave.llm import collocations as C
from skillweave.llm.queries import ORACLES


def test_permutation_and_packing_are_lossless():
    rng = np.random.default_rng(3)
    hi, lo = rng.integers(0, 2**63, 5000).astype(np.uint64), rng.integers(0, 2**63, 5000).astype(np.uint64)
    back = C.unpermute(*C.permute(hi, lo))
    assert (back[0] == hi).all() and (back[1] == lo).all()
    for width in (2, 10, 34, 64, 86, 126):
        h = hi >> np.uint64(max(0, 128 - width)) if width > 64 else np.zeros_like(hi)
        l = lo if width >= 64 else lo & np.uint64((1 << width) - 1)
        if width > 64:
            h = h & np.uint64((1 << (width - 64)) - 1)
        ph, pl = C.permute(h, l, width)
        assert (ph < np.uint64(1 << max(0, width - 64))).all() if width > 64 else (ph == 0).all()
        back = C.unpermute(ph, pl, width)
        assert (back[0] == h).all() and (back[1] == l).all()
    for bits in (3, 17, 25):
        ids = rng.integers(1, 2**bits, 400).astype(np.uint64)
        starts = np.arange(0, 395)
        for m in range(1, 6):
            h, l = C.pack(ids, starts, m, bits)
            q, rh, rl, counts = C.quotient_filter(h, l, C.width_of(m, bits))
            assert (q >= 0).all() and (q < 1 << C.QUOTIENT_BITS).all()
            h2, l2 = C.restore(q, rh, rl, C.width_of(m, bits))
            got = sorted(map(tuple, C.unpack(h2, l2, m, bits).tolist()))
            assert got == sorted({tuple(ids[s : s + m].tolist()) for s in starts}) and counts.sum() == len(starts)


def test_known_is_exact():
    rng = np.random.default_rng(4)
    hi, lo = rng.integers(0, 50, 3000).astype(np.uint64), rng.integers(0, 50, 3000).astype(np.uint64)
    known = C.Known(["en"] * 1500 + ["de"] * 1500, hi, lo)
    qh, ql = rng.integers(0, 50, 4000).astype(np.uint64), rng.integers(0, 50, 4000).astype(np.uint64)
    want = np.array([(a, b) in set(zip(hi[:1500].tolist(), lo[:1500].tolist())) for a, b in zip(qh.tolist(), ql.tolist())])
    assert (known.has("en", qh, ql) == want).all() and not known.has("fr", qh, ql).any()


def test_query_equals_sql_on_odd_rows(spark):
    rng = random.Random(9)
    phrases = ["New York City Hall", "the big red barn", "a\tb c", "ÉCOLE normale", "x y"]
    rows = []
    for i in range(700):
        words = " ".join(rng.choice(phrases) + rng.choice([" ", ". ", ", ", "\n", " z "]) for _ in range(rng.randint(0, 6)))
        rows.append((i, words if i % 50 else None, rng.choice(["en", None, "de"]), 1))
    rows += [(1, "New York City Hall " * 120, "en", 1)] * 2
    frame = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "n"])
    got = sorted(tuple(r) for r in C.collocations(spark.createDataFrame(frame)).collect())
    con = duckdb.connect()
    con.register("documents", frame)
    want = sorted(tuple(r) for r in con.execute(ORACLES["op13_collocations"]).fetchall())
    assert got == want and len(got) > 5


def test_empty_table(spark):
    assert C.collocations(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0
