"""Sources, schemas and text."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillweave.functions.text import (
    SYSTEM_PROMPT,
    USER_PROMPT,
    alnum_normalise,
    clean_tokens,
    drop_stopwords,
    letters_only,
    skill_normalise,
    strip_html,
    tokenise,
    truncate_text,
)
from skillweave.operators.cleaning import build_lemmas, clean_text, lemmatise, prompt_rows
from skillweave.operators.schema import alignment, resolve_column, standardise_jobs, standardise_profiles, take_first, with_surrogate_id
from skillweave.plans.catalog.registry import joined, query, table, text_table
from skillweave.plans.catalog.sql_parts import STOPS, alnum, clean_ctes, collapse, letters, untag
from skillweave.session import shared_root
from skillweave.sources.readers import read_embeddings, read_jobs, read_profiles, read_skill_map, write_embeddings
from skillweave.sources.writers import read_table, write_summary, write_table


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared root."""
    return f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query(
    "read_profiles",
    """SELECT doc_id::VARCHAR AS "ID", source AS "Category", md5(coalesce(text, '')) AS raw_text FROM documents""",
)
def profiles_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as CSV, read back with their line breaks and quotes, and standardised."""
    path = scratch(spark, "profiles") + ".csv"
    raw = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("Resume_str"), F.col("source").alias("category"))
    raw.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return standardise_profiles(read_profiles(spark, path)).withColumn("raw_text", F.md5("raw_text"))


@query("read_jobs", """SELECT item_id::VARCHAR AS "JobID", md5(text) AS raw_text FROM benchmark""")
def jobs_from_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = read_jobs(spark, f"{sf_dir}/benchmark.parquet").select(F.col("item_id").alias("JobID"), F.col("text").alias("Keywords"))
    return standardise_jobs(jobs).withColumn("raw_text", F.md5("raw_text"))


@query(
    "read_embeddings",
    """SELECT vec_id AS "ID", len(embedding)::BIGINT AS width, round(embedding[1]::DOUBLE, 6) AS first FROM embeddings""",
)
def embeddings_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "vectors")
    write_embeddings(read_embeddings(spark, f"{sf_dir}/embeddings.parquet", "vec_id"), path, "vec_id")
    return read_embeddings(spark, path, "vec_id").select(
        F.col("vec_id").alias("ID"),
        F.size("embedding").cast("bigint").alias("width"),
        F.round(F.col("embedding")[0].cast("double"), 6).alias("first"),
    )


@query(
    "read_skill_map",
    """
SELECT p_partkey::VARCHAR AS "ID", p_name || '|' || p_brand AS technical, p_type AS soft FROM part""",
)
def skill_map_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map of id to skill lists as JSON text, one object per part, read back as rows."""
    entry = F.struct(F.array("p_name", "p_brand").alias("technical"), F.array("p_type").alias("soft"))
    document = F.to_json(F.create_map(F.col("p_partkey").cast("string"), entry))
    lines = table(spark, sf_dir, "part").select(document.alias("value"))
    path = scratch(spark, "skills")
    # One object per file is the format; a folder of many such files is read in parallel.
    merged = lines.groupBy(F.spark_partition_id()).agg(F.collect_list("value").alias("v")).select(
        F.concat(F.lit("{"), F.array_join(F.transform("v", lambda o: F.substring(o, F.lit(2), F.length(o) - 2)), ","), F.lit("}")).alias("value")
    )
    merged.write.text(path)
    return read_skill_map(spark, path).select("ID", joined("technical").alias("technical"), joined("soft").alias("soft"))


@query(
    "write_table_csv",
    """
SELECT l_orderkey::VARCHAR AS order_id, to_json(list_sort(list(DISTINCT l_shipmode)))::VARCHAR AS items FROM
  (SELECT l_orderkey, l_returnflag || l_linestatus AS l_shipmode FROM lineitem) GROUP BY l_orderkey""",
)
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists become JSON cells; the second version replaces the first."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.concat("l_returnflag", "l_linestatus").alias("flag"))
    lists = lines.groupBy(F.col("l_orderkey").alias("order_id")).agg(F.array_sort(F.collect_set("flag")).alias("items"))
    path = scratch(spark, "table")
    write_table(lists.limit(0), path, "csv")
    write_table(lists, path, "csv")
    return read_table(spark, path, "csv").select("order_id", "items")


@query(
    "write_summary",
    """SELECT lang AS variant, count(*) AS n, max(length(text))::BIGINT AS longest FROM documents GROUP BY lang""",
)
def summary_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "summary")
    summary = table(spark, sf_dir, "documents").groupBy(F.col("lang").alias("variant")).agg(
        F.count("*").alias("n"), F.max(F.length("text")).cast("bigint").alias("longest")
    )
    write_summary(summary, path, "norm")
    return read_table(spark, f"{path}/variant=norm", "json").select("variant", "n", "longest")


@query("resolve_column", """SELECT doc_id AS id, length(text)::BIGINT AS chars FROM documents""")
def resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    text = resolve_column(documents, ["Resume_str", "RESUME", "resume_text", "TEXT"])
    return documents.select(F.col(resolve_column(documents, ["DOC_ID"])).alias("id"), F.length(text).cast("bigint").alias("chars"))


@query(
    "surrogate_id",
    """SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS "ID" FROM orders""",
)
def surrogate(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return with_surrogate_id(orders, [F.desc("o_totalprice"), "o_orderkey"]).select("o_orderkey", "ID")


@query(
    "standardise_profiles",
    """SELECT page_id::VARCHAR AS "ID", 'unknown' AS "Category", coalesce(html, '') AS raw_text FROM pages""",
)
def profiles_without_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardise_profiles(table(spark, sf_dir, "pages").select(F.col("page_id").alias("ID"), F.col("html").alias("Text")))


@query(
    "standardise_jobs",
    """
SELECT p_partkey::VARCHAR AS "JobID",
       coalesce(nullif(p_name, 'hot bolt'), '') || ' ' || coalesce(nullif(p_brand, 'Brand#1'), '') || ' ' || p_type AS raw_text
FROM part""",
)
def concat_job_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls leave their separator, absent columns do not."""
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("jobid"),
        F.nullif("p_name", F.lit("hot bolt")).alias("title"),
        F.nullif("p_brand", F.lit("Brand#1")).alias("SKILLS"),
        F.col("p_type").alias("keyword"),
    )
    return standardise_jobs(part)


@query(
    "take_first",
    """SELECT doc_id, source FROM documents ORDER BY n_chars DESC, doc_id LIMIT 25""",
)
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return take_first(table(spark, sf_dir, "documents"), 25, [F.desc("n_chars"), "doc_id"]).select("doc_id", "source")


@query(
    "alignment",
    """
SELECT count(*) FILTER (WHERE d.doc_id IS NOT NULL AND l.doc_id IS NOT NULL) AS matched,
       count(*) FILTER (WHERE l.doc_id IS NULL) AS left_only, count(*) FILTER (WHERE d.doc_id IS NULL) AS right_only
FROM documents d FULL JOIN labels l ON l.doc_id = d.doc_id""",
)
def aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


@query(
    "text_functions",
    f"""
SELECT doc_id, md5({letters("text")}) AS letters, md5({alnum("text")}) AS alnum, md5({collapse("lower(text)")}) AS skill,
       md5(substr(text, 1, 4000)) AS truncated, len(list_filter(string_split({collapse("text")}, ' '), lambda w: w <> ''))::BIGINT AS tokens
FROM documents""",
)
def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return text_table(spark, sf_dir, "documents", "doc_id", doc_id="doc_id", text="text").select(
        "doc_id",
        F.md5(letters_only(text)).alias("letters"),
        F.md5(alnum_normalise(text)).alias("alnum"),
        F.md5(skill_normalise(text)).alias("skill"),
        F.md5(truncate_text(text)).alias("truncated"),
        F.size(tokenise(text)).cast("bigint").alias("tokens"),
    )


@query("strip_html", f"""SELECT page_id, {collapse(untag("html"))} AS text FROM pages""")
def untagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", strip_html(F.col("html")).alias("text"))


@query(
    "drop_stopwords",
    f"""
SELECT conv_id, turn, array_to_string(list_filter(string_split({letters("text")}, ' '),
       lambda w: length(w) > 1 AND w NOT IN ({STOPS})), ' ') AS kept FROM conversations""",
)
def without_stopwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.array_join(drop_stopwords(tokenise(letters_only(F.col("text")))), " ").alias("kept")
    )


@query("build_lemmas", f"WITH {clean_ctes('documents', 'doc_id', 'text')} SELECT surface, lemma FROM lemma")
def lemma_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_lemmas(text_table(spark, sf_dir, "documents", "id", id="doc_id", text="text").select(clean_tokens(F.col("text")).alias("tokens")))


@query("clean_text_pages", f"WITH {clean_ctes('pages', 'page_id', 'html')} SELECT id, clean_text FROM clean")
def clean_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = text_table(spark, sf_dir, "pages", "id", id="page_id", raw_text="html")
    return clean_text(pages, key="id").select("id", "clean_text")


CLEAN_DOCUMENTS = f"WITH {clean_ctes('documents', 'doc_id', 'text')} SELECT id, clean_text FROM clean"


@query("clean_text_documents", CLEAN_DOCUMENTS)
def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = text_table(spark, sf_dir, "documents", "id", id="doc_id", raw_text="text")
    return clean_text(documents, key="id").select("id", "clean_text")


@query("lemmatise_many", CLEAN_DOCUMENTS)
def lemmatise_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The path for lemma tables too long to carry to the rows."""
    tokens = text_table(spark, sf_dir, "documents", "id", id="doc_id", text="text").select("id", clean_tokens(F.col("text")).alias("tokens"))
    changed = lemmatise(tokens, key="id", max_inline_lemmas=0)
    return changed.select("id", F.array_join("tokens", " ").alias("clean_text"))


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


@query(
    "prompt_rows",
    f"""
SELECT doc_id AS "ID", unnest(['system', 'user']) AS role,
       unnest([{_sql_text(SYSTEM_PROMPT)}, {_sql_text(USER_PROMPT)} || substr(coalesce(text, ''), 1, 4000)]) AS content
FROM documents""",
)
def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ID"), F.col("text").alias("clean_text"))
    return prompt_rows(documents).select("ID", F.inline("messages"))
