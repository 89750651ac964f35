"""Exact top-k through the cell index: equal to all pairs, with pruning where vectors cluster."""

from __future__ import annotations

import numpy as np

from skillweave.operators import cell_index as C
from tests.conftest import rows

SCHEMA_Q = "JobID long, embedding array<double>"
SCHEMA_I = "ID long, Category string, embedding array<double>"


def brute(queries, items, k):
    out = []
    for qid, qv in queries:
        if qv is None:
            continue
        q = np.asarray(qv) / (np.linalg.norm(qv) or 1)
        scored = []
        for iid, _, iv in items:
            if iv is None:
                continue
            x = np.asarray(iv) / (np.linalg.norm(iv) or 1)
            scored.append((-round(float(q @ x), 6), iid))
        scored.sort()
        out += [(qid, iid, -s, r + 1) for r, (s, iid) in enumerate(scored[:k])]
    return sorted(out)


def clustered(n, centres, seed, spread=0.05):
    rng = np.random.default_rng(seed)
    mids = rng.normal(size=(centres, 16))
    return [(mids[i % centres] + spread * rng.normal(size=16)).round(4).tolist() for i in range(n)]


def test_forced_cells_equal_all_pairs(spark):
    vectors = clustered(300, 12, 1, 0.6)
    items = [(i, f"c{i % 3}", v) for i, v in enumerate(vectors)] + [(900, "x", vectors[5])] * 40 + [(901, "y", None), (902, "z", [0.0] * 16)]
    queries = [(i, vectors[i]) for i in range(0, 300, 7)] + [(-1, None), (-2, [0.0] * 16)]
    for cell_rows in (1, 7, 1000):
        got = C.topk_cosine_cells(spark.createDataFrame(queries, SCHEMA_Q), spark.createDataFrame(items, SCHEMA_I), 5, cell_rows=cell_rows, carry=["Category"])
        assert sorted((r.JobID, r.ID, r.score, r.rank) for r in got.collect()) == brute(queries, items, 5)


def test_clustered_vectors_are_pruned(spark):
    vectors = clustered(2000, 40, 2)
    items = spark.createDataFrame([(i, "c", v) for i, v in enumerate(vectors)], SCHEMA_I)
    queries = spark.createDataFrame([(i, vectors[i]) for i in range(0, 2000, 20)], SCHEMA_Q)
    share = C.scored_share(queries, items, 10, cell_rows=50)
    assert share < 0.2
    got = sorted(rows(C.topk_cosine_cells(queries, items, 10, cell_rows=50).select("JobID", "ID", "score", "rank")))
    assert got == brute([(i, vectors[i]) for i in range(0, 2000, 20)], [(i, "c", v) for i, v in enumerate(vectors)], 10)


def test_empty_items(spark):
    got = C.topk_cosine_cells(spark.createDataFrame([(1, [1.0, 0.0])], SCHEMA_Q), spark.createDataFrame([], SCHEMA_I), 3)
    assert got.count() == 0


def test_visits_leave_in_small_frames(spark):
    """Every query visits every cell; what a task sends on at once stays bounded."""
    index = (np.eye(16), np.full(16, np.pi), np.ones(16, np.int64))
    rng = np.random.default_rng(4)
    queries = spark.createDataFrame([(i, v) for i, v in enumerate(rng.normal(size=(3000, 16)).tolist())], SCHEMA_Q).coalesce(1)
    run = C._visits(queries, index, 16, "JobID", "embedding", None)
    assert run.count() == 3000 * 16
    frame = queries.toPandas()
    sizes = [len(f) for f in C._slices(iter([frame]), "embedding")]
    assert sum(sizes) == 3000 and max(sizes) <= C.READ_ROWS


def test_scoring_a_group_needs_little_memory():
    """20,000 queries against 6,000 items of a cell: the table of all pairs alone would be 960 MB."""
    import tracemalloc

    rng = np.random.default_rng(5)
    q, x = (rng.normal(size=(n, 4)) for n in (20_000, 6_000))
    tracemalloc.start()
    found = C._nearest_places(q, x, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200_000_000
    rows_, cols, scores = found
    assert len(rows_) == 60_000 and (np.bincount(rows_) == 3).all()
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    for at in (0, 19_999):
        exact = np.rint(unit(q)[at] @ unit(x).T * 1_000_000)
        assert set(cols[rows_ == at]) == set(np.lexsort((np.arange(len(x)), -exact))[:3])


def test_no_row_for_every_query_and_cell(spark, monkeypatch):
    """Directions without clusters, so every query needs every cell: what is written and moved follows the tables, not their product."""
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(1200, 16)).tolist()
    items = [(i, "c", v) for i, v in enumerate(vectors)]
    queries = [(i, v) for i, v in enumerate(vectors[:700])]
    sizes, keep = [], C.written

    def counted(df, name):
        kept = keep(df, name)
        sizes.append(kept.count())
        return kept

    monkeypatch.setattr(C, "written", counted)
    got = C.topk_cosine_cells(spark.createDataFrame(queries, SCHEMA_Q), spark.createDataFrame(items, SCHEMA_I), 4, cell_rows=20)
    assert sorted((r.JobID, r.ID, r.score, r.rank) for r in got.collect()) == brute(queries, items, 4)
    assert sum(sizes) < 10 * (len(queries) + len(items))  # a visit of each query to each of the 60 cells would be 42,000 rows


def test_keys_repeated_missing_and_of_text(spark, monkeypatch):
    """Blocks of a few queries, ids that are null or repeated, null values carried, and queries of which none has a vector."""
    monkeypatch.setattr(C, "BLOCK_VALUES", 900)
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(90, 8)).round(3).tolist()
    items = [(None if i % 9 == 0 else f"i{i % 40:02}", None if i % 2 else i, v) for i, v in enumerate(vectors)]
    queries = [(None if i % 20 == 0 else f"q{i % 25}", v) for i, v in enumerate(vectors[:60])] + [("none", None)]
    schema = "ID string, n int, embedding array<float>"
    found = C.topk_cosine_cells(spark.createDataFrame(queries, "JobID string, embedding array<double>"), spark.createDataFrame(items, schema), 3, cell_rows=6, carry=["n"])
    unit = lambda v: np.float32(v).astype(float) / np.linalg.norm(np.float32(v).astype(float))
    best = {}
    for query, q in queries[:-1]:
        for item, n, v in items:
            best.setdefault(query, []).append((-round(float(np.asarray(q) / np.linalg.norm(q) @ unit(v)), 6), item or "", n or -1))
    expect = sorted((q or "", i, -s, r + 1) for q, all_ in best.items() for r, (s, i, _) in enumerate(sorted(all_)[:3]))
    assert sorted((r.JobID or "", r.ID or "", r.score, r.rank) for r in found.collect()) == expect
    of = {(i or "", n) for i, n, _ in items}
    assert all((r.ID or "", r.n) in of for r in found.collect())
    empty = C.topk_cosine_cells(spark.createDataFrame([(1, None)], SCHEMA_Q), spark.createDataFrame([(1, "c", [1.0, 0.0])], SCHEMA_I), 3)
    assert empty.count() == 0
    sizes = {needed: C._layout(needed, 8) for needed in (0, 1, 3, 5, 8, 10)}
    assert sizes == {0: (2, 4), 1: (2, 4), 3: (4, 2), 5: (8, 1), 8: (8, 1), 10: (16, 1)}
