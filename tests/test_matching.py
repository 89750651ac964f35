from __future__ import annotations

import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from skillweave.functions.vectors import cosine, l2_normalise
from skillweave.operators import matching, similarity
from skillweave.operators.categories import category_variants, infer_categories
from skillweave.operators.similarity import rank_by_cosine, score_pairs, topk_cosine

VECTORS = "embedding array<double>"


def brute(queries, items, k):
    def cos(a, b):
        na, nb = math.sqrt(sum(x * x for x in a)), math.sqrt(sum(x * x for x in b))
        return round(sum(x * y for x, y in zip(a, b)) / (na * nb), 6) if na and nb else 0.0

    out = []
    for q, v in queries:
        best = sorted(((-cos(v, w), i) for i, w in items))[:k]
        out += [(q, i, r + 1) for r, (_, i) in enumerate(best)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def points():
    rng = random.Random(3)
    # A third of the items are copies of one vector.
    items = [(f"i{n:03d}", [1.0, 2.0, 3.0] if n % 3 == 0 else [rng.gauss(0, 1) for _ in range(3)]) for n in range(120)]
    queries = [(f"q{n:02d}", [rng.gauss(0, 1) for _ in range(3)]) for n in range(30)] + [("zero", [0.0, 0.0, 0.0])]
    return queries, items


@pytest.mark.parametrize("limit", [8_000_000, 3 * 7])
@pytest.mark.parametrize("prune", [None, 1])
def test_topk_equals_brute_force_on_both_paths(spark, points, limit, prune):
    queries, items = points
    q = spark.createDataFrame(queries, f"JobID string, {VECTORS}")
    d = spark.createDataFrame(items, f"ID string, {VECTORS}").repartition(5)
    found = topk_cosine(q, d, 2, max_broadcast_values=limit, prune_from_tasks=prune)
    assert rows(found, "JobID", "ID", "rank") == brute(queries, items, 2)
    found = topk_cosine(q, d, 7, max_broadcast_values=limit, prune_from_tasks=prune)
    assert rows(found, "JobID", "ID", "rank") == brute(queries, items, 7)


def test_blocks_send_only_the_best_of_each_query_to_the_merge(spark, points, monkeypatch):
    queries, items = points
    q = spark.createDataFrame(queries, f"JobID string, {VECTORS}")
    d = spark.createDataFrame(items * 40, f"ID string, {VECTORS}").repartition(5)
    sent, merge = [], similarity.top_within

    def counted(partial, *options):
        sent.append(partial.count())
        return merge(partial, *options)

    monkeypatch.setattr(similarity, "top_within", counted)
    found = topk_cosine(q, d, 4, max_broadcast_values=3 * 7, prune_from_tasks=None)
    assert rows(found, "JobID", "ID", "rank") == brute(queries, items * 40, 4)
    assert sent == [4 * len(queries)]


def test_candidates_are_those_in_the_evaluated_places(spark, points):
    queries, items = points
    jobs = spark.createDataFrame(queries, f"JobID string, {VECTORS}")
    profiles = spark.createDataFrame([(i, "A", v) for i, v in items], f"ID string, Category string, {VECTORS}")
    matched = jobs.select("JobID", F.array(F.lit("A")).alias("matched_categories"))
    candidates = matching.rank_candidates(jobs, profiles, matched, top_k=3)
    assert candidates.count() == 10 * len(queries)


@pytest.mark.parametrize("blocks", [False, True])
def test_lists_per_job_rank_as_the_rows_do(spark, points, blocks):
    queries, items = points
    # Repeated and missing job ids, a job matched twice, one not at all, a profile without a category.
    jobs = spark.createDataFrame([(q, v) for q, v in queries] + [queries[0], ("q01", [1.0, 0.0, 0.0]), (None, [0.0, 1.0, 0.0])], f"JobID string, {VECTORS}")
    profiles = spark.createDataFrame([(i, None if n == 3 else "ABC"[n % 3], v) for n, (i, v) in enumerate(items)], f"ID string, Category string, {VECTORS}")
    wanted = [(q, ["A"] if n % 2 else ["B", "C"]) for n, (q, _) in enumerate(queries[:-3])] + [("q00", ["C"]), ("q05", None)]
    matched = spark.createDataFrame(wanted, "JobID string, matched_categories array<string>")
    limit = 3 * 7 if blocks else similarity.MAX_BROADCAST_VALUES
    ranked = topk_cosine(jobs, profiles, 20, carry=["Category"], max_broadcast_values=limit, prune_from_tasks=None)
    known = ranked.join(matched, "JobID", "left").withColumn("matched_categories", F.coalesce("matched_categories", F.array().cast("array<string>")))
    expected = matching.rerank_pool(known, 0.2, 12).where("final_rank <= 9")
    lists = similarity.nearest_lists(jobs, profiles, 20, carry=["Category"], max_broadcast_values=limit, prune_from_tasks=None)
    assert lists.count() == len(queries) + 1
    columns = ["JobID", "ID", "Category", "score", "matched_categories", "relevant", "boosted", "final_rank"]
    odd = ("q00", "q01", "q05")
    once = [r for r in rows(expected, *columns) if r[0] not in odd]
    found = matching.rerank_lists(lists, matched, 0.2, 12, 9)
    assert [r for r in rows(found, *columns) if r[0] not in odd] == once
    # Of rows that are alike in all that orders them either may come first, so the repeated ids compare without what tells them apart.
    several = ["JobID", "ID", "score", "boosted", "final_rank"]
    assert rows(found.where(F.col("JobID").isin(*odd)), *several) == rows(expected.where(F.col("JobID").isin(*odd)), *several)


def test_ranked_pairs_of_blocks_are_neither_shuffled_nor_sorted(spark, points, monkeypatch):
    queries, items = points
    monkeypatch.setattr(similarity, "MAX_BROADCAST_RESULTS", 300 * 5)
    jobs = spark.createDataFrame(queries, f"JobID string, {VECTORS}")
    profiles = spark.createDataFrame([(i, "A", v) for i, v in items], f"ID string, Category string, {VECTORS}")
    matched = jobs.select("JobID", F.array(F.lit("A")).alias("matched_categories"))
    plan = matching.rank_candidates(jobs, profiles, matched)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan
    assert "Window" not in plan[: plan.index("MapInArrow")]


def test_topk_with_fewer_items_than_k_and_none(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0])], f"JobID bigint, {VECTORS}")
    d = spark.createDataFrame([(5, [1.0, 0.0]), (4, [1.0, 0.0])], f"ID bigint, {VECTORS}")
    assert rows(topk_cosine(q, d, 9), "ID", "rank") == [(4, 1), (5, 2)]
    assert topk_cosine(q.limit(0), d, 9).count() == 0
    assert topk_cosine(q, d.limit(0), 9).count() == 0


def test_given_pairs_are_scored_and_ranked(spark):
    pairs = spark.createDataFrame(
        [("j", "b", [1.0, 0.0], [1.0, 0.0]), ("j", "a", [1.0, 0.0], [2.0, 0.0]), ("j", "c", [1.0, 0.0], [0.0, 1.0])],
        "JobID string, ID string, left array<double>, right array<double>",
    )
    assert rows(rank_by_cosine(score_pairs(pairs)), "ID", "score", "rank") == [("a", 1.0, 1), ("b", 1.0, 2), ("c", 0.0, 3)]


def test_zero_vectors(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    assert df.select(cosine(F.col("a"), F.col("b"))).first()[0] == 0.0
    assert df.select(l2_normalise(F.col("a"))).first()[0] == [0.0, 0.0]
    assert df.select(l2_normalise(F.col("b"))).first()[0] == [1.0, 0.0]


def test_rerank_stays_inside_the_pool(spark):
    angle = [0.0, 0.1, 0.2, 0.3]
    profiles = spark.createDataFrame(
        [(f"p{n}", "WANTED" if n in (1, 3) else "OTHER", [math.cos(a), math.sin(a)]) for n, a in enumerate(angle)],
        f"ID string, Category string, {VECTORS}",
    )
    jobs = spark.createDataFrame([("j", [1.0, 0.0]), ("plain", [1.0, 0.0])], f"JobID string, {VECTORS}")
    matched = spark.createDataFrame([("j", ["WANTED"]), ("plain", [])], "JobID string, matched_categories array<string>")

    def order(pool, rerank=True):
        lists = matching.match_jobs(jobs, profiles, matched, top_k=2, rerank_pool_size=pool, category_rerank=rerank)
        return {r["JobID"]: (r["ranked_resume_ids"], r["category_rerank_applied"]) for r in lists.collect()}

    assert order(4)["j"] == (["p1", "p3"], True)
    assert order(2)["j"] == (["p1", "p0"], True)  # p3 is outside the pool
    assert order(4)["plain"] == (["p0", "p1"], False)
    assert order(4, rerank=False)["j"] == (["p0", "p1"], False)


def test_precision_is_judged_on_ten_places_even_for_a_short_list(spark):
    profiles = spark.createDataFrame([(f"p{n:02d}", "A", [1.0, n / 100]) for n in range(20)], f"ID string, Category string, {VECTORS}")
    jobs = spark.createDataFrame([("j", [1.0, 0.0]), ("none", [1.0, 0.0])], f"JobID string, {VECTORS}")
    matched = spark.createDataFrame([("j", ["A"]), ("none", [])], "JobID string, matched_categories array<string>")
    candidates = matching.rank_candidates(jobs, profiles, matched, top_k=3, rerank_pool_size=3)
    got = {r["k"]: r for r in matching.precision_summary(candidates, matched).collect()}
    assert got[10]["mean_precision_at_k"] == 0.5 and got[10]["mean_precision_at_k_nonempty"] == 1.0
    assert (got[5]["n_queries"], got[5]["n_queries_with_nonempty_relevant"], got[5]["n_queries_with_empty_relevant"]) == (2, 1, 1)


def test_recorded_precision_means_are_consistent():
    assert 0.9943355119825709 * 918 / 1068 == pytest.approx(0.8546816479400748, abs=1e-12)


CATEGORIES = ["HR", "ARTS", "INFORMATION-TECHNOLOGY", "PUBLIC-RELATIONS", "BPO"]
TEXTS = [
    ("1", "three spare parts", ["ARTS", "HR"]),
    ("2", "Relations with the PUBLIC", ["PUBLIC-RELATIONS"]),
    ("3", "we code in Java!", ["INFORMATION-TECHNOLOGY"]),
    ("4", "informationtechnology", ["INFORMATION-TECHNOLOGY"]),
    ("5", "stack of full trays", ["INFORMATION-TECHNOLOGY"]),
    ("6", "nothing", []),
    ("7", None, []),
    ("8", "center for a call", ["BPO"]),
]


@pytest.mark.parametrize("inline", [2000, 0])
def test_infer_categories_on_both_paths(spark, inline):
    texts = spark.createDataFrame([t[:2] for t in TEXTS], "JobID string, clean_text string")
    names = spark.createDataFrame([(c,) for c in CATEGORIES * 2], "Category string")
    found = infer_categories(texts, names, max_inline_variants=inline)
    assert rows(found) == sorted([(i, c) for i, _, c in TEXTS], key=repr)


@pytest.mark.parametrize("inline", [2000, 0])
def test_infer_categories_by_whole_words(spark, inline):
    texts = spark.createDataFrame([t[:2] for t in TEXTS], "JobID string, clean_text string")
    names = spark.createDataFrame([(c,) for c in CATEGORIES], "Category string")
    found = infer_categories(texts, names, word_boundary=True, max_inline_variants=inline)
    assert {r[0]: r[1] for r in found.collect()}["1"] == []


def test_variants_cover_dashes(spark):
    names = spark.createDataFrame([("A-B",)], "Category string")
    assert rows(category_variants(names, {})) == [("A-B", "a b"), ("A-B", "ab")]


def test_relevance_flags_ranked_profiles(spark):
    ranked = spark.createDataFrame([("j", "1", "A"), ("j", "2", "B")], "JobID string, ID string, Category string")
    matched = spark.createDataFrame([("j", ["B", "C"])], "JobID string, matched_categories array<string>")
    assert rows(matching.relevance(ranked, matched)) == [("j", "2")]
