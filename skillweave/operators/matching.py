"""Profiles ranked for every job: cosine first, then a bounded category re-rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillweave.operators.joins import fits
from skillweave.operators.ranking import rank_within
from skillweave.operators.similarity import nearest_lists, topk_cosine

TOP_K = 10
CATEGORY_BOOST = 0.20
RERANK_POOL = 300
EVALUATED_KS = (5, 10)
#: Jobs whose matched categories travel to the lists, if they also fit in bytes.
BROADCAST_JOBS = 1_000_000


def pool_size(top_k: int, rerank_pool: int = RERANK_POOL) -> int:
    return max(top_k, rerank_pool)


def topk_match(jobs: DataFrame, profiles: DataFrame, k: int = TOP_K) -> DataFrame:
    """The ``k`` nearest profiles of every job: JobID, ID, score, rank."""
    return topk_cosine(jobs, profiles, k)


def rerank_pool(ranked: DataFrame, boost: float = CATEGORY_BOOST, pool: int = RERANK_POOL) -> DataFrame:
    """Boost the profiles whose category the job matched, within the first ``pool`` ranks only.

    ``ranked`` has JobID, ID, Category, score, rank, matched_categories. Adds ``relevant``,
    ``boosted`` and ``final_rank``; ranks beyond the pool keep their cosine order. A job without
    matched categories keeps its order, because nothing is boosted.
    """
    inside = F.col("rank") <= pool
    flagged = ranked.withColumn("relevant", F.array_contains("matched_categories", F.col("Category"))).withColumn(
        "boosted",
        F.when(inside & F.col("relevant"), F.round(F.col("score") + F.lit(boost), 6)).otherwise(F.col("score")),
    )
    return rank_within(flagged, ["JobID"], [inside.desc(), F.desc("boosted"), F.asc("ID")], "final_rank")


def rerank_lists(
    lists: DataFrame, matched: DataFrame, boost: float = CATEGORY_BOOST, pool: int = RERANK_POOL, keep: int = TOP_K
) -> DataFrame:
    """The first ``keep`` rows per job of :func:`rerank_pool`, from one list per job.

    ``lists`` has JobID and ``near``, an array of (ID, Category, score), best first. The order is found inside the row, so only
    the rows kept are ever listed.
    """
    none = F.array().cast("array<string>")
    wants = matched.groupBy("JobID").agg(F.collect_list(F.coalesce("matched_categories", none)).alias("_wants"))
    known = lists.join(F.broadcast(wants) if fits(wants, BROADCAST_JOBS) else wants, "JobID", "left")
    wants_of, near = F.coalesce("_wants", F.array(none)), F.col("near")

    def boosted(item: Column, at: Column, relevant: Column) -> Column:
        return F.when((at < pool) & relevant, F.round(item["score"] + F.lit(boost), 6)).otherwise(item["score"])

    def places(wanted: Column, which: Column) -> Column:
        """What the order needs and where to find the rest."""

        def place(item: Column, at: Column) -> Column:
            score = boosted(item, at, F.array_contains(wanted, item["Category"]))
            return F.struct((at >= pool).alias("outside"), (-score).alias("order"), item["ID"].alias("ID"), which.alias("which"), at.alias("at"))

        return F.transform(near, place)

    def row(place: Column) -> Column:
        item, wanted = F.get(near, place["at"]), F.get(wants_of, place["which"])
        relevant = F.array_contains(wanted, item["Category"])
        return F.struct(
            item["ID"].alias("ID"), item["Category"].alias("Category"), item["score"].alias("score"), (place["at"] + 1).alias("rank"),
            wanted.alias("matched_categories"), relevant.alias("relevant"), boosted(item, place["at"], relevant).alias("boosted"),
        )

    first = F.slice(F.sort_array(F.flatten(F.transform(wants_of, places))), 1, keep)
    found = known.select("JobID", F.posexplode(F.transform(first, row)).alias("_at", "_row"))
    return found.select("JobID", "_row.*", (F.col("_at") + 1).alias("final_rank"))


def rank_candidates(
    jobs: DataFrame,
    profiles: DataFrame,
    matched: DataFrame,
    top_k: int = TOP_K,
    category_rerank: bool = True,
    category_boost: float = CATEGORY_BOOST,
    rerank_pool_size: int = RERANK_POOL,
) -> DataFrame:
    """The candidates in the first ``max(top_k, 10)`` places, with their final rank.

    ``jobs`` has JobID and embedding, ``profiles`` ID, Category and embedding, ``matched`` JobID and
    matched_categories. The pool bounds what is kept per job, so the full similarity table never
    exists.
    """
    pool = pool_size(top_k, rerank_pool_size)
    keep = max(pool, top_k, *EVALUATED_KS)
    near = nearest_lists(jobs, profiles, keep, carry=["Category"])
    return rerank_lists(near, matched, category_boost if category_rerank else 0.0, pool, max(top_k, *EVALUATED_KS))


def ranked_lists(
    candidates: DataFrame, matched: DataFrame, top_k: int = TOP_K, category_rerank: bool = True
) -> DataFrame:
    """One row per job: ranked ids, matched categories and whether the re-rank applied."""
    lists = (
        candidates.where(F.col("final_rank") <= top_k)
        .groupBy("JobID")
        .agg(F.array_sort(F.collect_list(F.struct("final_rank", "ID"))).alias("_ranked"))
    )
    nobody = F.array().cast(candidates.select(F.array("ID")).schema[0].dataType)
    return matched.join(lists, "JobID", "left").select(
        "JobID",
        F.coalesce(F.transform("_ranked", lambda r: r["ID"]), nobody).alias("ranked_resume_ids"),
        "matched_categories",
        (F.lit(category_rerank) & (F.size("matched_categories") > 0)).alias("category_rerank_applied"),
    )


def match_jobs(jobs: DataFrame, profiles: DataFrame, matched: DataFrame, top_k: int = TOP_K, **options) -> DataFrame:
    """The ranked list of every job; options as in :func:`rank_candidates`."""
    candidates = rank_candidates(jobs, profiles, matched, top_k, **options)
    return ranked_lists(candidates, matched, top_k, options.get("category_rerank", True))


def relevance(ranked: DataFrame, matched: DataFrame) -> DataFrame:
    """(JobID, ID) of the ranked profiles whose category the job matched.

    ``ranked`` carries the profile's Category. Only ranked profiles are looked at: whatever is
    relevant but not ranked cannot change a precision.
    """
    wanted = matched.select("JobID", F.explode("matched_categories").alias("Category")).distinct()
    return ranked.join(wanted, ["JobID", "Category"], "left_semi").select("JobID", "ID")


def precision_summary(candidates: DataFrame, matched: DataFrame, ks: tuple[int, ...] = EVALUATED_KS) -> DataFrame:
    """Mean precision at each k over all jobs and over the jobs with a matched category.

    Matched categories are profile categories, so a job has relevant profiles exactly when it
    matched one, and a candidate's own flag says whether it is relevant: the (job, profile)
    relevance pairs are never listed.
    """
    hits = candidates.where((F.col("final_rank") <= max(ks)) & F.col("relevant")).groupBy("JobID").agg(
        *[F.count_if(F.col("final_rank") <= k).alias(f"_hits{k}") for k in ks]
    )
    per_job = matched.select("JobID", (F.size("matched_categories") > 0).alias("_any")).join(hits, "JobID", "left")
    rows = F.array(
        *[
            F.struct(F.lit(k).alias("k"), (F.coalesce(F.col(f"_hits{k}"), F.lit(0)) / F.lit(float(k))).alias("p"))
            for k in ks
        ]
    )
    return (
        per_job.select("_any", F.inline(rows))
        .groupBy("k")
        .agg(
            F.avg("p").alias("mean_precision_at_k"),
            F.coalesce(F.avg(F.when(F.col("_any"), F.col("p"))), F.lit(0.0)).alias("mean_precision_at_k_nonempty"),
            F.count("*").alias("n_queries"),
            F.count_if(F.col("_any")).alias("n_queries_with_nonempty_relevant"),
            F.count_if(~F.col("_any")).alias("n_queries_with_empty_relevant"),
        )
    )
