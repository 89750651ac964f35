"""Whole stages over the given tables, and the hooks for a caller's own code."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillweave.operators import cluster_quality as quality
from skillweave.operators import clustering
from skillweave.operators.skills import SOFT_DEFAULTS, SOFT_KEYWORDS, TECHNICAL_DEFAULTS, TECHNICAL_KEYWORDS, extract_skills
from skillweave.plans.catalog.matching_queries import ranked_output, rounded_summary
from skillweave.plans.catalog.model_queries import vectors
from skillweave.plans.catalog.registry import joined, query, r6, table, text_table
from skillweave.plans.catalog.skill_queries import _filled, _found, cache_table, lists
from skillweave.plans.catalog.sql_parts import clean_ctes, collapse, quality_values
from skillweave.plans.stages import run_stage
from skillweave.session import shared_root

# One lemma table for both texts, so the corpus is both.
BOTH_SQL = f"""
corpus AS (SELECT 'r' || doc_id AS id, text FROM documents UNION ALL SELECT 'j' || item_id, text FROM benchmark),
{clean_ctes("corpus", "id", "text")}"""


def _preprocessed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    resumes = text_table(spark, sf_dir, "documents", "ID", ID="doc_id", Category="source", Resume_str="text")
    jobs = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("JobID"), F.col("text").alias("Responsibilities"))
    return run_stage("preprocess", {"resumes": resumes, "jobs": jobs})


@query(
    "stage_preprocess_resumes",
    f"""WITH {BOTH_SQL}
SELECT d.doc_id::VARCHAR AS "ID", d.source AS "Category", c.clean_text FROM documents d JOIN clean c ON c.id = 'r' || d.doc_id""",
)
def stage_resumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _preprocessed(spark, sf_dir)["clean_resumes"].select("ID", "Category", "clean_text")


@query(
    "stage_preprocess_jobs",
    f"""WITH {BOTH_SQL} SELECT b.item_id::VARCHAR AS "JobID", c.clean_text FROM benchmark b JOIN clean c ON c.id = 'j' || b.item_id""",
)
def stage_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _preprocessed(spark, sf_dir)["clean_jobs"].select("JobID", "clean_text")


DEFAULT_SKILLS_SQL = f"""
body AS (SELECT doc_id AS id, ' ' || {collapse("lower(coalesce(text, ''))")} || ' ' AS t FROM documents),
found AS (SELECT id, {_found(list(TECHNICAL_KEYWORDS), "t")} AS technical, {_found(list(SOFT_KEYWORDS), "t")} AS soft FROM body),
filled AS (
  SELECT id, {_filled("technical[1:20]", TECHNICAL_DEFAULTS, 3)} AS technical, {_filled("soft[1:10]", SOFT_DEFAULTS, 2)} AS soft FROM found)"""


@query(
    "stage_skills",
    f"""WITH {DEFAULT_SKILLS_SQL}
SELECT d.doc_id::VARCHAR AS "ID",
  array_to_string(CASE WHEN l.quality = 1 THEN ['quality'] WHEN l.toxic = 1 THEN [] ELSE f.technical END, '|') AS technical,
  array_to_string(CASE WHEN l.toxic = 1 THEN ['toxic'] WHEN l.quality = 1 THEN [] ELSE f.soft END, '|') AS soft
FROM documents d JOIN filled f ON f.id = d.doc_id LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def stage_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skills into a cache that already knows the labelled documents; its empty rows are refilled."""
    profiles = text_table(spark, sf_dir, "documents", "ID", ID="doc_id", clean_text="text").withColumn("ID", F.col("ID").cast("string"))
    cache = cache_table(spark, sf_dir).withColumn("ID", F.col("ID").cast("string"))
    return lists(run_stage("skills", {"clean_resumes": profiles, "skill_lists": cache}, refill_empty=True, dim=64)["skill_lists"], "ID")


@query(
    "stage_arm",
    """
WITH pair AS (
  SELECT doc_id AS id, 'quality' AS item FROM labels WHERE quality = 1 UNION ALL SELECT doc_id, 'toxic' FROM labels WHERE toxic = 1),
total AS (SELECT count(*)::DOUBLE AS n FROM documents),
found AS (
  SELECT item AS items, count(*) AS freq FROM pair GROUP BY item
  UNION ALL SELECT a.item || '|' || b.item, count(*) FROM pair a JOIN pair b ON a.id = b.id AND a.item < b.item GROUP BY 1)
SELECT items, freq, round(freq / n, 6) AS support FROM found, total WHERE freq / n >= 0.01""",
)
def stage_arm(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ID"))
    mined = run_stage("arm", {"clean_resumes": profiles, "skill_lists": cache_table(spark, sf_dir)}, min_support=0.01)
    return mined["frequent_itemsets"].select(joined("items").alias("items"), "freq", r6("support").alias("support"))


def _matched(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Every vector is a job whose text names its label."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("ID"), F.col("label").cast("string").alias("Category"), "embedding")
    jobs = e.select(F.col("ID").alias("JobID"), F.concat(F.lit("wanted: label "), F.col("Category")).alias("clean_text"))
    return run_stage(
        "match",
        {"clean_resumes": e.select("ID", "Category"), "embeddings": e.select("ID", "embedding"), "clean_jobs": jobs},
        job_embeddings=e.select(F.col("ID").alias("JobID"), "embedding"),
    )


STAGE_MATCH_SQL = """
WITH e AS (SELECT vec_id::VARCHAR AS vec_id, embedding::DOUBLE[] AS v, label::VARCHAR AS cat FROM embeddings),
scored AS (
  SELECT q.vec_id AS job, q.cat AS want, d.vec_id AS id, d.cat AS cat, round(list_cosine_similarity(q.v, d.v), 6) AS score FROM e q, e d),
ranked AS (SELECT *, row_number() OVER (PARTITION BY job ORDER BY score DESC, id) AS rank FROM scored),
boosted AS (SELECT *, cat = want AS relevant, CASE WHEN cat = want THEN round(score + 0.2, 6) ELSE score END AS boost FROM ranked WHERE rank <= 300),
final AS (SELECT *, row_number() OVER (PARTITION BY job ORDER BY boost DESC, id) AS final_rank FROM boosted)
"""


@query(
    "stage_match",
    STAGE_MATCH_SQL
    + """SELECT job AS "JobID", string_agg(id, ',' ORDER BY final_rank) AS ranked_resume_ids, any_value(want) AS matched_categories,
  true AS category_rerank_applied FROM final WHERE final_rank <= 10 GROUP BY job""",
)
def stage_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_output(_matched(spark, sf_dir)["matching_topk"])


@query(
    "stage_match_precision",
    STAGE_MATCH_SQL
    + """, hits AS (SELECT k, job, count(*) FILTER (WHERE relevant AND final_rank <= k) / k::DOUBLE AS p FROM final, (VALUES (5), (10)) AS ks(k) GROUP BY k, job)
SELECT k::BIGINT AS k, round(avg(p), 6) AS mean_precision_at_k, round(avg(p), 6) AS mean_precision_at_k_nonempty, count(*) AS n_queries,
  count(*) AS n_queries_with_nonempty_relevant, 0::BIGINT AS n_queries_with_empty_relevant FROM hits GROUP BY k""",
)
def stage_match_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_summary(_matched(spark, sf_dir)["matching_precision_at_k"])


@query("stage_cluster")
def stage_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = vectors(spark, sf_dir)
    tables = {"clean_resumes": e.select("ID", F.col("label").cast("string").alias("Category")), "embeddings": e.select("ID", "embedding")}
    return run_stage("cluster", tables)["cluster_assignments"]


@query("kmeans_fit")
def kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = vectors(spark, sf_dir)
    assigned = clustering.kmeans_assign(clustering.kmeans_fit(points, 10), points)
    return quality.cluster_sizes(assigned, "cluster_id")


@query(
    "silhouette_sq",
    f"""
WITH {quality_values()},
sq AS (SELECT id, label, sum(x * x) AS q FROM v GROUP BY id, label),
psi AS (SELECT label, avg(q) AS q FROM sq GROUP BY label),
dot AS (SELECT v.id, v.label AS own, c.label AS other, sum(v.x * c.m) AS xy FROM v JOIN c ON c.pos = v.pos GROUP BY v.id, v.label, c.label),
d AS (SELECT dot.id, own, other, sq.q - 2 * xy + psi.q AS d FROM dot JOIN sq ON sq.id = dot.id JOIN psi ON psi.label = other),
ab AS (
  SELECT d.id, any_value(s.n) AS n, sum(d) FILTER (WHERE own = other) * any_value(s.n) / (any_value(s.n) - 1) AS a, min(d) FILTER (WHERE own <> other) AS b
  FROM d JOIN size s ON s.label = own GROUP BY d.id),
score AS (SELECT avg(CASE WHEN n = 1 THEN 0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END) AS s FROM ab)
SELECT label, n::BIGINT AS size, round(s, 6) AS silhouette_sq FROM size, score""",
)
def silhouette_squared(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = vectors(spark, sf_dir)
    return quality.cluster_sizes(points, "label").withColumn("silhouette_sq", r6(F.lit(quality.silhouette_sq(points, "label"))))


@query(
    "week1",
    f"""WITH {BOTH_SQL},
resume AS (SELECT substr(id, 2) AS doc_id, clean_text AS text FROM clean WHERE id LIKE 'r%'),
{DEFAULT_SKILLS_SQL.replace("FROM documents", "FROM resume")}
SELECT id AS "ID", array_to_string(technical, '|') AS technical, array_to_string(soft, '|') AS soft FROM filled""",
)
def week1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw profiles to cleaned texts and skills, written to the shared folder and read back."""
    resumes = text_table(spark, sf_dir, "documents", "ID", ID="doc_id", Category="source", Resume_str="text")
    jobs = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("JobID"), F.col("text").alias("Responsibilities"))
    results = run_stage("week1", {"resumes": resumes, "jobs": jobs}, save_to=f"{shared_root(spark).rstrip('/')}/week1-{uuid.uuid4().hex}")
    return lists(results["skill_lists"], "ID")


@query(
    "extract_skills",
    f"""WITH {DEFAULT_SKILLS_SQL}
SELECT d.doc_id AS "ID", CASE WHEN length(d.text) % 2 = 0 THEN 'chars ' || length(d.text) ELSE array_to_string(f.technical, '|') END AS technical,
  CASE WHEN length(d.text) % 2 = 0 THEN '' ELSE array_to_string(f.soft, '|') END AS soft, length(d.text) % 2 = 1 AS recovered
FROM documents d JOIN filled f ON f.id = d.doc_id""",
)
def own_extractor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extractor that answers for texts of even length; the others take the fallback."""

    def extractor(batches):
        for batch in batches:
            sizes = batch["clean_text"].str.len()
            yield batch[["ID"]].assign(
                technical=[[f"Chars {n}"] if n % 2 == 0 else [] for n in sizes], soft=[[] for _ in sizes]
            )

    profiles = text_table(spark, sf_dir, "documents", "ID", ID="doc_id", clean_text="text")
    return lists(extract_skills(profiles, extractor=extractor), "ID", "recovered")
