"""Matching, categories, relevance and precision."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillweave.functions.vectors import cosine, l2_normalise
from skillweave.operators import matching
from skillweave.operators.categories import infer_categories
from skillweave.operators.cleaning import clean_text
from skillweave.operators.embedding import embed_text, inverse_frequencies, portable_hash
from skillweave.operators.metrics import mean_precision_at_k, precision_at_k, relevant_ids
from skillweave.operators.schema import attach_embeddings
from skillweave.operators.cell_index import topk_cosine_cells
from skillweave.operators.similarity import topk_cosine
from skillweave.plans.catalog.registry import joined, query, r6, table, text_table
from skillweave.plans.catalog.sql_parts import alnum, clean_ctes
from skillweave.session import written

DIM = 64


def vector_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every vector is a job and a profile; its label is its category and the one it asks for."""
    e = table(spark, sf_dir, "embeddings")
    category = F.col("label").cast("string")
    jobs = e.select(F.col("vec_id").alias("JobID"), "embedding")
    profiles = e.select(F.col("vec_id").alias("ID"), category.alias("Category"), "embedding")
    matched = e.select(F.col("vec_id").alias("JobID"), F.array(category).alias("matched_categories"))
    return jobs, profiles, matched


def ranked_output(lists: DataFrame) -> DataFrame:
    return lists.select(
        "JobID",
        joined("ranked_resume_ids", ",").alias("ranked_resume_ids"),
        joined("matched_categories", ",").alias("matched_categories"),
        "category_rerank_applied",
    )


RANKED_VECTORS = """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v, label::VARCHAR AS cat FROM embeddings),
scored AS (
  SELECT q.vec_id AS job, q.cat AS want, d.vec_id AS id, d.cat AS cat, round(list_cosine_similarity(q.v, d.v), 6) AS score
  FROM e q, e d),
ranked AS (SELECT *, row_number() OVER (PARTITION BY job ORDER BY score DESC, id) AS rank FROM scored),
boosted AS (
  SELECT *, cat = want AS relevant,
         CASE WHEN rank <= 300 AND cat = want THEN round(score + 0.2, 6) ELSE score END AS boost
  FROM ranked WHERE rank <= 300),
final AS (SELECT *, row_number() OVER (PARTITION BY job ORDER BY boost DESC, id) AS final_rank FROM boosted)
"""


@query(
    "match_topk_rerank",
    RANKED_VECTORS
    + """
SELECT job AS "JobID", string_agg(id::VARCHAR, ',' ORDER BY final_rank) AS ranked_resume_ids,
       any_value(want) AS matched_categories, true AS category_rerank_applied
FROM final WHERE final_rank <= 10 GROUP BY job""",
)
def match_topk_rerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs, profiles, matched = vector_tables(spark, sf_dir)
    return ranked_output(matching.match_jobs(jobs, profiles, matched))


@query(
    "match_without_rerank",
    """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v, label::VARCHAR AS cat FROM embeddings),
ranked AS (
  SELECT job, id, want, row_number() OVER (PARTITION BY job ORDER BY score DESC, id) AS rank FROM (
    SELECT q.vec_id AS job, q.cat AS want, d.vec_id AS id, round(list_cosine_similarity(q.v, d.v), 6) AS score FROM e q, e d))
SELECT job AS "JobID", string_agg(id::VARCHAR, ',' ORDER BY rank) AS ranked_resume_ids,
       any_value(want) AS matched_categories, false AS category_rerank_applied
FROM ranked WHERE rank <= 10 GROUP BY job""",
)
def match_without_rerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs, profiles, matched = vector_tables(spark, sf_dir)
    return ranked_output(matching.match_jobs(jobs, profiles, matched, category_rerank=False))


@query(
    "topk_cosine",
    """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)
SELECT job AS "JobID", id AS "ID", score, rank FROM (
  SELECT job, id, score, row_number() OVER (PARTITION BY job ORDER BY score DESC, id)::BIGINT AS rank FROM (
    SELECT q.vec_id AS job, d.vec_id AS id, round(list_cosine_similarity(q.v, d.v), 6) AS score FROM e q, e d))
WHERE rank <= 10""",
)
def topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs, profiles, _ = vector_tables(spark, sf_dir)
    return matching.topk_match(jobs, profiles.drop("Category")).select("JobID", "ID", "score", F.col("rank").cast("bigint").alias("rank"))


@query(
    "topk_cosine_cells",
    """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)
SELECT job AS "JobID", id AS "ID", score, rank FROM (
  SELECT job, id, score, row_number() OVER (PARTITION BY job ORDER BY score DESC, id)::BIGINT AS rank FROM (
    SELECT q.vec_id AS job, d.vec_id AS id, round(list_cosine_similarity(q.v, d.v), 6) AS score FROM e q, e d))
WHERE rank <= 10""",
)
def topk_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector against all, through the cell index."""
    jobs, profiles, _ = vector_tables(spark, sf_dir)
    return topk_cosine_cells(jobs, profiles.drop("Category"), 10).select("JobID", "ID", "score", F.col("rank").cast("bigint").alias("rank"))


@query(
    "match_precision_summary",
    RANKED_VECTORS
    + """,
hits AS (
  SELECT k, job, count(*) FILTER (WHERE relevant AND final_rank <= k) / k::DOUBLE AS p
  FROM final, (VALUES (5), (10)) AS ks(k) GROUP BY k, job)
SELECT k::BIGINT AS k, round(avg(p), 6) AS mean_precision_at_k, round(avg(p), 6) AS mean_precision_at_k_nonempty,
       count(*) AS n_queries, count(*) AS n_queries_with_nonempty_relevant, 0::BIGINT AS n_queries_with_empty_relevant
FROM hits GROUP BY k""",
)
def match_precision_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs, profiles, matched = vector_tables(spark, sf_dir)
    return rounded_summary(matching.precision_summary(matching.rank_candidates(jobs, profiles, matched), matched))


def rounded_summary(summary: DataFrame) -> DataFrame:
    return summary.withColumns(
        {
            "k": F.col("k").cast("bigint"),
            "mean_precision_at_k": r6("mean_precision_at_k"),
            "mean_precision_at_k_nonempty": r6("mean_precision_at_k_nonempty"),
        }
    )


# Job texts against document texts, end to end: clean, embed, infer categories, rank, re-rank.
TEXT_ALIASES = {"EN": ["the and", "thereing"], "FR": ["les des", "euxaux"], "ES": ["que los"]}

MATCHED_TEXTS = f"""
WITH {clean_ctes("documents", "doc_id", "text", "p")},
{clean_ctes("benchmark", "item_id", "text", "j")},
term AS (
  SELECT 'p' AS side, id, ('0x' || substr(md5(word), 1, 8))::BIGINT AS h FROM pbase
  UNION ALL SELECT 'j', id, ('0x' || substr(md5(word), 1, 8))::BIGINT FROM jbase),
cell AS (
  SELECT side, id, h % {DIM} AS bucket, sum(1 - 2 * ((h // {DIM}) % 2)) AS tf FROM term GROUP BY side, id, h % {DIM}),
freq AS (SELECT h % {DIM} AS bucket, count(DISTINCT id) AS df FROM term WHERE side = 'p' GROUP BY h % {DIM}),
weight AS (
  SELECT side, id, c.bucket,
         tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + coalesce(f.df, 0))) + 1) AS w
  FROM cell c LEFT JOIN freq f ON f.bucket = c.bucket),
norm AS (SELECT side, id, sqrt(sum(w * w)) AS len FROM weight GROUP BY side, id),
pairs AS (
  SELECT j.item_id AS job, p.doc_id AS id, p.lang AS cat FROM benchmark j, documents p),
dots AS (
  SELECT a.id AS job, b.id AS id, sum(a.w * b.w) AS dot FROM weight a JOIN weight b
  ON a.bucket = b.bucket AND a.side = 'j' AND b.side = 'p' GROUP BY a.id, b.id),
scored AS (
  SELECT x.job, x.id, x.cat,
         round(CASE WHEN n1.len > 0 AND n2.len > 0 THEN coalesce(d.dot, 0) / (n1.len * n2.len) ELSE 0 END, 6) + 0.0 AS score
  FROM pairs x LEFT JOIN dots d ON d.job = x.job AND d.id = x.id
  LEFT JOIN norm n1 ON n1.side = 'j' AND n1.id = x.job LEFT JOIN norm n2 ON n2.side = 'p' AND n2.id = x.id),
variant AS (
  SELECT DISTINCT lang AS cat, lower(lang) AS variant FROM documents
  UNION SELECT * FROM (VALUES ('en', 'the and'), ('en', 'thereing'), ('fr', 'les des'), ('fr', 'euxaux'), ('es', 'que los'))),
want AS (
  SELECT j.id AS job, v.cat FROM jclean j JOIN variant v
  ON contains(j.clean_text, v.variant)
     OR len(list_filter(string_split(v.variant, ' '), lambda w: NOT list_contains(string_split(j.clean_text, ' '), w))) = 0
  GROUP BY j.id, v.cat),
wants AS (SELECT item_id AS job, coalesce(string_agg(w.cat, ',' ORDER BY w.cat), '') AS cats
          FROM benchmark b LEFT JOIN want w ON w.job = b.item_id GROUP BY item_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY job ORDER BY score DESC, id) AS rank FROM scored),
boosted AS (
  SELECT r.*, w.cat IS NOT NULL AS relevant, CASE WHEN w.cat IS NOT NULL THEN round(score + 0.2, 6) ELSE score END AS boost
  FROM ranked r LEFT JOIN want w ON w.job = r.job AND w.cat = r.cat WHERE rank <= 300),
final AS (SELECT *, row_number() OVER (PARTITION BY job ORDER BY boost DESC, id) AS final_rank FROM boosted)
"""


def text_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    documents = text_table(spark, sf_dir, "documents", "ID", ID="doc_id", Category="lang", raw_text="text")
    benchmark = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("JobID"), F.col("text").alias("raw_text"))
    profiles = written(clean_text(documents).drop("raw_text"))
    jobs = written(clean_text(benchmark, key="JobID").drop("raw_text"))
    weights = inverse_frequencies(profiles, dim=DIM, term_hash=portable_hash)
    matched = infer_categories(jobs, profiles.select("Category"), TEXT_ALIASES)
    vectors = [embed_text(df, DIM, key=k, weights=weights, term_hash=portable_hash) for df, k in ((jobs, "JobID"), (profiles, "ID"))]
    return vectors[0], vectors[1], matched


@query(
    "match_jobs_text",
    MATCHED_TEXTS
    + """
SELECT f.job AS "JobID", string_agg(f.id::VARCHAR, ',' ORDER BY final_rank) AS ranked_resume_ids,
       any_value(w.cats) AS matched_categories, any_value(w.cats <> '') AS category_rerank_applied
FROM final f JOIN wants w ON w.job = f.job WHERE final_rank <= 10 GROUP BY f.job""",
)
def match_jobs_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_output(matching.match_jobs(*text_tables(spark, sf_dir)))


@query(
    "match_text_precision",
    MATCHED_TEXTS
    + """,
hits AS (
  SELECT k, f.job, any_value(w.cats <> '') AS any_cat, count(*) FILTER (WHERE relevant AND final_rank <= k) / k::DOUBLE AS p
  FROM final f JOIN wants w ON w.job = f.job, (VALUES (5), (10)) AS ks(k) GROUP BY k, f.job)
SELECT k::BIGINT AS k, round(avg(p), 6) AS mean_precision_at_k,
       round(coalesce(avg(p) FILTER (WHERE any_cat), 0), 6) AS mean_precision_at_k_nonempty,
       count(*) AS n_queries, count(*) FILTER (WHERE any_cat) AS n_queries_with_nonempty_relevant,
       count(*) FILTER (WHERE NOT any_cat) AS n_queries_with_empty_relevant
FROM hits GROUP BY k""",
)
def match_text_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs, profiles, matched = text_tables(spark, sf_dir)
    return rounded_summary(matching.precision_summary(matching.rank_candidates(jobs, profiles, matched), matched))


@query(
    "embed_text",
    f"""
WITH {clean_ctes("documents", "doc_id", "text")},
term AS (SELECT id, ('0x' || substr(md5(word), 1, 8))::BIGINT AS h FROM base),
cell AS (SELECT id, h % {DIM} AS bucket, sum(1 - 2 * ((h // {DIM}) % 2)) AS tf FROM term GROUP BY id, h % {DIM}),
freq AS (SELECT h % {DIM} AS bucket, count(DISTINCT id) AS df FROM term GROUP BY h % {DIM}),
weight AS (
  SELECT id, c.bucket, tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + f.df)) + 1) AS w FROM cell c JOIN freq f ON f.bucket = c.bucket),
norm AS (SELECT id, sqrt(sum(w * w)) AS len FROM weight GROUP BY id)
SELECT d.doc_id AS id, s.bucket::BIGINT AS position, round(coalesce(w.w / nullif(n.len, 0), 0), 6) + 0.0 AS value
FROM documents d CROSS JOIN range({DIM}) AS s(bucket)
LEFT JOIN weight w ON w.id = d.doc_id AND w.bucket = s.bucket LEFT JOIN norm n ON n.id = d.doc_id""",
)
def embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = text_table(spark, sf_dir, "documents", "id", id="doc_id", raw_text="text")
    cleaned = written(clean_text(documents, key="id").drop("raw_text"))
    vectors = embed_text(cleaned, DIM, key="id", term_hash=portable_hash)
    return vectors.select("id", F.posexplode("embedding").alias("position", "value")).select(
        "id", F.col("position").cast("bigint").alias("position"), (r6("value") + F.lit(0.0)).alias("value")
    )


REGION_ALIASES = {
    "AFRICA": ["the and", "xyzzy"],
    "AMERICA": ["que los", "ciónez"],
    "ASIA": ["thonin oned"],
    "EUROPE": ["der die", "les des"],
}
REGION_VARIANTS = f"""
variant AS (
  SELECT r_name AS cat, {alnum("r_name")} AS variant FROM region
  UNION SELECT * FROM (VALUES ('AFRICA', 'the and'), ('AFRICA', 'xyzzy'), ('AMERICA', 'que los'), ('AMERICA', 'ci nez'),
                              ('ASIA', 'thonin oned'), ('EUROPE', 'der die'), ('EUROPE', 'les des'))),
body AS (SELECT doc_id, {alnum("text")} AS t FROM documents)"""


def _region_categories(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    texts = text_table(spark, sf_dir, "documents", "doc_id", doc_id="doc_id", text="text")
    names = table(spark, sf_dir, "region").select(F.col("r_name").alias("Category"))
    found = infer_categories(texts, names, REGION_ALIASES, key="doc_id", text="text", **options)
    return found.select("doc_id", joined("matched_categories").alias("matched_categories"))


def _region_sql(substring: str) -> str:
    return f"""
WITH {REGION_VARIANTS},
hit AS (
  SELECT DISTINCT b.doc_id, v.cat FROM body b JOIN variant v
  ON {substring}
     OR len(list_filter(string_split(v.variant, ' '), lambda w: NOT list_contains(string_split(b.t, ' '), w))) = 0)
SELECT d.doc_id, coalesce(string_agg(h.cat, '|' ORDER BY h.cat), '') AS matched_categories
FROM documents d LEFT JOIN hit h ON h.doc_id = d.doc_id GROUP BY d.doc_id"""


@query("infer_categories", _region_sql("contains(b.t, v.variant)"))
def infer_inline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _region_categories(spark, sf_dir)


@query("infer_categories_many", _region_sql("contains(b.t, v.variant)"))
def infer_by_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The path for variant lists too long to carry to the rows."""
    return _region_categories(spark, sf_dir, max_inline_variants=0)


@query("infer_categories_words", _region_sql("contains(' ' || b.t || ' ', ' ' || v.variant || ' ')"))
def infer_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _region_categories(spark, sf_dir, word_boundary=True)


@query(
    "relevant_ids",
    """SELECT s_suppkey::VARCHAR AS "ID" FROM supplier WHERE s_nationkey = (SELECT min(s_nationkey) FROM supplier)""",
)
def relevant(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("ID"), F.col("s_nationkey").alias("Category"))
    first = suppliers.agg(F.min("Category")).first()[0]
    return relevant_ids(suppliers, str(first))


def _ranked_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Suppliers rank their parts by quantity sold; parts they had returned are the relevant ones."""
    from skillweave.operators.ranking import rank_within

    lines = table(spark, sf_dir, "lineitem")
    sold = lines.groupBy(F.col("l_suppkey").alias("JobID"), F.col("l_partkey").alias("ID")).agg(F.sum("l_quantity").alias("qty"))
    ranked = rank_within(sold, ["JobID"], [F.desc("qty"), F.asc("ID")])
    returned = lines.where(F.col("l_returnflag") == "R").select(F.col("l_suppkey").alias("JobID"), F.col("l_partkey").alias("ID"))
    return ranked, returned


RANKED_PARTS = """
WITH ranked AS (
  SELECT l_suppkey AS job, l_partkey AS id, row_number() OVER (PARTITION BY l_suppkey ORDER BY sum(l_quantity) DESC, l_partkey) AS rank
  FROM lineitem GROUP BY l_suppkey, l_partkey),
rel AS (SELECT DISTINCT l_suppkey AS job, l_partkey AS id FROM lineitem WHERE l_returnflag = 'R'),
p AS (SELECT r.job, count(rel.id) FILTER (WHERE rank <= 5) / 5.0 AS p
      FROM ranked r LEFT JOIN rel ON rel.job = r.job AND rel.id = r.id GROUP BY r.job)
"""


@query("precision_at_k", RANKED_PARTS + """SELECT job AS "JobID", round(p::DOUBLE, 6) AS precision_at_k FROM p""")
def precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return precision_at_k(*_ranked_parts(spark, sf_dir), 5).select("JobID", r6("precision_at_k").alias("precision_at_k"))


@query("mean_precision_at_k", RANKED_PARTS + "SELECT round(avg(p::DOUBLE), 6) AS mean_precision_at_k FROM p")
def mean_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mean_precision_at_k(*_ranked_parts(spark, sf_dir), 5).select(r6("mean_precision_at_k").alias("mean_precision_at_k"))


@query(
    "l2_normalise",
    """
WITH v AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS position, unnest(embedding)::DOUBLE AS x FROM embeddings)
SELECT vec_id, position::BIGINT AS position,
       round(x / greatest(sqrt(sum(x * x) OVER (PARTITION BY vec_id)), 1e-12), 6) + 0.0 AS value FROM v""",
)
def normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(l2_normalise(F.col("embedding"))).alias("position", "value"))
    return e.select("vec_id", F.col("position").cast("bigint").alias("position"), (r6("value") + F.lit(0.0)).alias("value"))


@query(
    "cosine",
    """
SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) + 0.0 AS score
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
)
def cosine_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its successor by id."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    following = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return e.join(following, "vec_id").select("vec_id", (r6(cosine(F.col("embedding"), F.col("other"))) + F.lit(0.0)).alias("score"))


@query(
    "attach_embeddings",
    """
SELECT d.doc_id AS "ID", d.source AS "Category", len(e.embedding)::BIGINT AS width
FROM documents d JOIN embeddings e ON e.vec_id = d.doc_id""",
)
def attached(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ID"), F.col("source").alias("Category"))
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("ID"), "embedding")
    return attach_embeddings(profiles, vectors).select("ID", "Category", F.size("embedding").cast("bigint").alias("width"))


@query(
    "relevance",
    """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v, label FROM embeddings)
SELECT job AS "JobID", id AS "ID" FROM (
  SELECT *, row_number() OVER (PARTITION BY job ORDER BY score DESC, id) AS rank FROM (
    SELECT q.vec_id AS job, q.label AS want, d.vec_id AS id, d.label AS cat, round(list_cosine_similarity(q.v, d.v), 6) AS score
    FROM e q, e d))
WHERE rank <= 10 AND (cat = want OR cat = want + 1)""",
)
def relevance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors ask for their own label and the next; which of their ten nearest have one of the two."""
    jobs, profiles, _ = vector_tables(spark, sf_dir)
    wanted = F.array(F.col("label").cast("string"), (F.col("label") + 1).cast("string"))
    matched = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("JobID"), wanted.alias("matched_categories"))
    return matching.relevance(topk_cosine(jobs, profiles, 10, carry=["Category"]), matched)
