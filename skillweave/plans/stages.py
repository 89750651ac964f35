"""The analysis as stages over DataFrames: preprocess, skills, cluster, arm, classify, match."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillweave.functions.text import ENGLISH_STOPWORDS, clean_tokens
from skillweave.operators import classify as classification
from skillweave.operators import clustering, matching, mining
from skillweave.operators.categories import infer_categories
from skillweave.operators.cleaning import build_lemmas, clean_text
from skillweave.operators.embedding import EMBEDDING_DIM, embed_text, inverse_frequencies
from skillweave.operators.incremental import cache_status, merge_cache, pending
from skillweave.operators.schema import attach_embeddings, check_aligned, standardise_jobs, standardise_profiles, take_first
from skillweave.operators.skills import extract_skills, parse_skill_response, skills_with_fallback
from skillweave.session import cut_lineage, written
from skillweave.sources.writers import read_table, write_summary, write_table

Tables = dict[str, DataFrame | None]


def preprocess(
    tables: Tables,
    sample_size: int | None = None,
    stops: Iterable[str] = ENGLISH_STOPWORDS,
    lemmas: DataFrame | None = None,
    order_by: list[str] | None = None,
) -> dict[str, DataFrame]:
    """``resumes`` and, when given, ``jobs`` to clean tables; one lemma table serves both."""
    stops = list(stops)
    profiles = standardise_profiles(tables["resumes"], order_by)
    jobs = None if tables.get("jobs") is None else standardise_jobs(tables["jobs"], order_by)
    if sample_size:
        profiles = take_first(profiles, sample_size, ["ID"])
        jobs = None if jobs is None else take_first(jobs, sample_size, ["JobID"])
    if lemmas is None:
        texts = profiles.select("raw_text") if jobs is None else profiles.select("raw_text").unionAll(jobs.select("raw_text"))
        lemmas = cut_lineage(build_lemmas(texts.select(clean_tokens(F.col("raw_text"), stops).alias("tokens"))))
    out = {"clean_resumes": clean_text(profiles, stops=stops, lemmas=lemmas)}
    if jobs is not None:
        out["clean_jobs"] = clean_text(jobs, stops=stops, lemmas=lemmas, key="JobID")
    return out


def skills(
    tables: Tables,
    extractor: Callable | None = None,
    sample_size: int | None = None,
    refill_empty: bool = False,
    skip_extraction: bool = False,
    dim: int = EMBEDDING_DIM,
    encoder: Callable | None = None,
) -> dict[str, DataFrame]:
    """Skill lists of the profiles not yet in the cache, merged into it, and the vectors of all.

    Skills come from ``responses`` (ID, response) when that table is given, else from ``extractor``,
    else from the keywords in the text.
    """
    profiles = tables["clean_resumes"]
    spark = profiles.sparkSession
    cache = tables.get("skill_lists")
    if cache is None:
        cache = spark.createDataFrame([], "ID string, technical array<string>, soft array<string>")
    out = {
        "cache_status": cache_status(profiles, cache),
        "embeddings": embed_text(profiles.select("ID", "clean_text"), dim, encoder),
    }
    if skip_extraction:
        return {**out, "skill_lists": cache}
    todo = pending(profiles.select("ID", "clean_text"), cache, refill_empty)
    if sample_size:
        todo = take_first(todo, sample_size, ["ID"])
    if tables.get("responses") is not None:
        answers = parse_skill_response(tables["responses"])
        found = skills_with_fallback(todo.join(answers, "ID", "left"))
    else:
        found = extract_skills(todo, extractor=extractor)
    found = written(found, "skills")
    return {
        **out,
        "skill_lists": merge_cache(cache, found),
        "recovered": found.agg(F.count("*").alias("processed"), F.count_if("recovered").alias("recovered_empty")),
    }


def cluster(
    tables: Tables,
    sample_size: int | None = None,
    k_min: int = clustering.K_MIN,
    k_max: int = clustering.K_MAX,
    normalize_embeddings: bool = True,
    pca_components: int | None = None,
    n_init: int = clustering.RESTARTS,
) -> dict[str, DataFrame]:
    profiles, vectors = tables["clean_resumes"].select("ID", "Category"), tables["embeddings"]
    joined = attach_embeddings(check_aligned(profiles, vectors, "ID"), vectors)
    if sample_size:
        joined = take_first(joined, sample_size, ["ID"])
    ready, kept = clustering.prepare_vectors(joined, normalize_embeddings, pca_components)
    ready = written(ready, "vectors")
    scores, models = clustering.kmeans_sweep(ready, k_min, k_max, n_init=n_init)
    best = clustering.select_k(scores).first()["k"]
    assigned = clustering.kmeans_assign(models[best], ready).select("ID", "Category", "cluster_id")
    return {
        "cluster_assignments": assigned,
        "cluster_scores": scores,
        "clustering_summary": clustering.clustering_summary(scores, assigned, normalize_embeddings, pca_components, kept),
    }


def arm(
    tables: Tables,
    min_support: float = mining.MIN_SUPPORT,
    min_threshold: float = mining.MIN_THRESHOLD,
    metric: str = mining.METRIC,
    sample_size: int | None = None,
) -> dict[str, DataFrame]:
    lists, profiles = tables["skill_lists"], tables.get("clean_resumes")
    tx = mining.transactions(lists if profiles is None else profiles, lists)
    if sample_size:
        tx = take_first(tx, sample_size, mining.order_transactions(tx) if profiles is None else ["ID"])
    mined = mining.mine_rules(written(tx, "transactions"), min_support, metric, min_threshold)
    return {"frequent_itemsets": mined.itemsets, "association_rules": mined.rules, "skill_item_matrix_meta": mined.meta}


def classify(tables: Tables, sample_size: int | None = None, **options: Any) -> dict[str, DataFrame]:
    profiles, vectors = tables["clean_resumes"], tables["embeddings"]
    joined = attach_embeddings(check_aligned(profiles, vectors, "ID"), vectors)
    if sample_size:
        joined = take_first(joined, sample_size, ["ID"])
    predictions = written(
        classification.classify(joined.select("ID", "Category", "clean_text", "embedding"), **options), "predictions"
    )
    test = predictions.where(F.col("split") == "test")
    return {
        "classification_comparison": classification.comparison_table(predictions),
        "per_class_f1_disparity": classification.per_class_f1_table(test),
        "classification_test_predictions": classification.side_by_side(test),
    }


def match(
    tables: Tables,
    sample_size: int | None = None,
    top_k: int = matching.TOP_K,
    eval_precision_k: bool = True,
    category_rerank: bool = True,
    category_boost: float = matching.CATEGORY_BOOST,
    rerank_pool_size: int = matching.RERANK_POOL,
    aliases: dict[str, list[str]] | None = None,
    job_embeddings: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Ranked profiles per job; without jobs there is nothing to match.

    Jobs are embedded with the weights of the profile texts unless their vectors are given.
    """
    jobs, profiles, vectors = tables.get("clean_jobs"), tables["clean_resumes"], tables["embeddings"]
    if jobs is None:
        return {}
    if sample_size:
        jobs = take_first(jobs, sample_size, ["JobID"])
    joined = attach_embeddings(check_aligned(profiles, vectors, "ID").select("ID", "Category"), vectors)
    if job_embeddings is None:
        dim = len(vectors.select("embedding").first()["embedding"])
        job_embeddings = embed_text(
            jobs.select("JobID", "clean_text"), dim, key="JobID", weights=inverse_frequencies(profiles, dim=dim)
        )
    matched = written(infer_categories(jobs, profiles.select("Category"), aliases), "matched")
    candidates = written(
        matching.rank_candidates(
            job_embeddings.join(jobs.select("JobID"), "JobID", "left_semi"),
            joined,
            matched,
            top_k,
            category_rerank,
            category_boost,
            rerank_pool_size,
        ),
        "candidates",
    )
    out = {"matching_topk": matching.ranked_lists(candidates, matched, top_k, category_rerank)}
    if eval_precision_k:
        out["matching_precision_at_k"] = matching.precision_summary(candidates, matched)
    return out


STAGES: dict[str, Callable[..., dict[str, DataFrame]]] = {
    "preprocess": preprocess,
    "skills": skills,
    "cluster": cluster,
    "arm": arm,
    "classify": classify,
    "match": match,
}
SUMMARIES = {"cache_status", "recovered", "clustering_summary", "skill_item_matrix_meta", "matching_precision_at_k"}
GROUPS: dict[str, tuple[str, ...]] = {
    "week1": ("preprocess", "skills"),
    "week2": ("cluster", "arm", "classify", "match"),
}


def save_results(results: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Write the tables of a stage below ``folder``, a new version each, and return them as read back.

    Summaries become JSON documents, the one of a clustering run also under its variant.
    """
    out = {}
    for name, df in results.items():
        path = f"{folder.rstrip('/')}/{name}"
        if name in SUMMARIES:
            kept = written(df, name)
            write_summary(kept, path, kept.first()["variant"] if "variant" in df.columns else None)
            out[name] = read_table(df.sparkSession, f"{path}/latest", "json")
        else:
            write_table(df, path, fmt)
            out[name] = read_table(df.sparkSession, path, fmt)
    return out


def run_stage(name: str, tables: Tables, save_to: str | None = None, **params: Any) -> dict[str, DataFrame]:
    """Run one stage, or a group of stages that feed each other, and return its tables by name.

    For a group, ``params`` maps stage names to their options. With ``save_to`` the results are written there and read back.
    """
    if save_to is not None:
        return save_results(run_stage(name, tables, **params), save_to)
    if name in STAGES:
        return STAGES[name](tables, **params)
    if name not in GROUPS:
        raise ValueError(f"unknown stage {name}")
    known, out = dict(tables), {}
    for stage in GROUPS[name]:
        made = STAGES[stage](known, **params.get(stage, {}))
        if stage == "preprocess":
            made = {k: written(v, k) for k, v in made.items()}
        out.update(made)
        known.update(made)
    return out
