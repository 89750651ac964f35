"""Clusters, features, classifiers and their metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillweave.operators import classify as classification
from skillweave.operators import cluster_quality as quality
from skillweave.operators import clustering, features, metrics
from skillweave.operators.cleaning import clean_text
from skillweave.operators.embedding import embed_text, pca_reduce
from skillweave.operators.kmeans_pass import kmeans_all
from skillweave.plans.catalog.registry import query, r6, table, text_table
from skillweave.plans.catalog.sql_parts import quality_values
from skillweave.session import written


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("ID"), "label", "embedding")


# --- clusters -------------------------------------------------------------------------------


@query(
    "dispersion",
    f"""
WITH {quality_values()},
w AS (SELECT sum((v.x - c.m) * (v.x - c.m)) AS within FROM v JOIN c ON c.label = v.label AND c.pos = v.pos),
b AS (SELECT sum(s.n * (c.m - g.m) * (c.m - g.m)) AS between_ FROM c JOIN g ON g.pos = c.pos JOIN size s ON s.label = c.label),
t AS (SELECT count(*) AS k, sum(n) AS n FROM size)
SELECT k, n::BIGINT AS n, round(within, 6) AS inertia, round(between_ / within * (n - k) / (k - 1), 6) AS calinski_harabasz FROM w, b, t""",
)
def dispersion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dispersion(vectors(spark, sf_dir), "label").select("k", "n", r6("inertia").alias("inertia"), r6("calinski_harabasz").alias("calinski_harabasz"))


@query(
    "davies_bouldin",
    f"""
WITH {quality_values()},
d AS (SELECT v.id, v.label, sqrt(sum((v.x - c.m) * (v.x - c.m))) AS d FROM v JOIN c ON c.label = v.label AND c.pos = v.pos GROUP BY v.id, v.label),
s AS (SELECT label, avg(d) AS spread FROM d GROUP BY label),
m AS (SELECT a.label AS a, b.label AS b, sqrt(sum((a.m - b.m) * (a.m - b.m))) AS gap FROM c a JOIN c b ON a.pos = b.pos AND a.label <> b.label GROUP BY 1, 2),
w AS (SELECT m.a, max((x.spread + y.spread) / m.gap) AS worst FROM m JOIN s x ON x.label = m.a JOIN s y ON y.label = m.b GROUP BY m.a)
SELECT round(avg(worst), 6) AS davies_bouldin FROM w""",
)
def davies_bouldin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.davies_bouldin(vectors(spark, sf_dir), "label").select(r6("davies_bouldin").alias("davies_bouldin"))


def _silhouette_sql(label: str) -> str:
    """Silhouette of every point for a labelling; the sample of 2,000 in md5 order is a feature of the measure."""
    return f"""
e AS (SELECT vec_id AS id, {label} AS label, embedding::DOUBLE[] AS x FROM embeddings ORDER BY md5(vec_id::VARCHAR), vec_id::VARCHAR LIMIT 2000),
d AS (SELECT p.id, p.label, q.label AS other, sum(list_distance(p.x, q.x)) AS total, count(*) AS n FROM e p, e q GROUP BY p.id, p.label, q.label),
ab AS (
  SELECT id, label, max(CASE WHEN other = label THEN n END) AS own, max(CASE WHEN other = label THEN total / greatest(n - 1, 1) END) AS a,
         min(CASE WHEN other <> label THEN total / n END) AS b FROM d GROUP BY id, label),
points AS (SELECT id, label, a, b, CASE WHEN own > 1 THEN (b - a) / greatest(a, b) ELSE 0 END AS s FROM ab)"""


@query(
    "silhouette",
    f"""WITH {_silhouette_sql("label")}
SELECT id::VARCHAR AS key, label::VARCHAR AS label, round(a, 5) AS a, round(b, 5) AS b, round(s, 5) AS silhouette FROM points""",
)
def silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = quality.silhouette_points(vectors(spark, sf_dir), "label")
    return points.select("key", "label", *[F.round(c, 5).alias(c) for c in ("a", "b", "silhouette")])


CANDIDATE_K = (2, 3, 4, 5)


@query(
    "select_k",
    "WITH "
    + ", ".join(
        _silhouette_sql(f"label % {k}").replace("e AS", f"e{k} AS").replace("d AS (", f"d{k} AS (").replace("FROM e p, e q", f"FROM e{k} p, e{k} q")
        .replace("ab AS", f"ab{k} AS").replace("FROM d GROUP", f"FROM d{k} GROUP").replace("points AS", f"points{k} AS").replace("FROM ab)", f"FROM ab{k})")
        for k in CANDIDATE_K
    )
    + ", score AS ("
    + " UNION ALL ".join(f"SELECT {k}::BIGINT AS k, round(avg(s), 6) AS silhouette FROM points{k}" for k in CANDIDATE_K)
    + ") SELECT k, silhouette FROM score ORDER BY silhouette DESC, k LIMIT 1",
)
def select_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best of several labellings of the same vectors, by silhouette."""
    scores = []
    for k in CANDIDATE_K:
        labelled = vectors(spark, sf_dir).withColumn("c", F.col("label") % k)
        scores.append(quality.silhouette(labelled, "c").select(F.lit(k).cast("bigint").alias("k"), r6("silhouette").alias("silhouette")))
    return clustering.select_k(reduce(DataFrame.unionByName, scores))


@query(
    "assign_nearest",
    f"""
WITH {quality_values()},
d AS (SELECT v.id, c.label, sum((v.x - c.m) * (v.x - c.m)) AS d FROM v JOIN c ON c.pos = v.pos GROUP BY v.id, c.label)
SELECT id AS "ID", label::BIGINT AS cluster_id FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, label) AS n FROM d) WHERE n = 1""",
)
def assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = vectors(spark, sf_dir)
    centres = quality.centroids(points, "label").select(F.col("label").alias("cluster_id"), "centre")
    return clustering.assign_nearest(points, centres).select("ID", "cluster_id")


@query("cluster_sizes", "SELECT label, count(*) AS size FROM embeddings GROUP BY label")
def sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.cluster_sizes(vectors(spark, sf_dir), "label")


@query(
    "size_summary",
    """
WITH s AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label)
SELECT sum(n)::BIGINT AS n_samples, min(n) AS cluster_size_min, max(n) AS cluster_size_max, round(avg(n), 1) AS cluster_size_mean FROM s""",
)
def size_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.size_summary(quality.cluster_sizes(vectors(spark, sf_dir), "label"))


@query("contingency", "SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY ALL")
def contingency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.contingency(table(spark, sf_dir, "customer"), "c_mktsegment", "c_nationkey")


@query(
    "purity",
    """
WITH n AS (SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY ALL),
m AS (SELECT c_mktsegment, max(n) AS top, sum(n) AS size FROM n GROUP BY c_mktsegment)
SELECT round(sum(top)::DOUBLE / sum(size), 6) AS purity FROM m""",
)
def purity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.purity(table(spark, sf_dir, "customer"), "c_mktsegment", "c_nationkey").select(r6("purity").alias("purity"))


@query(
    "nmi",
    """
WITH n AS (SELECT c_mktsegment AS a, c_nationkey AS b, count(*)::DOUBLE AS n FROM customer GROUP BY ALL),
t AS (SELECT sum(n) AS t FROM n), na AS (SELECT a, sum(n) AS n FROM n GROUP BY a), nb AS (SELECT b, sum(n) AS n FROM n GROUP BY b),
mi AS (SELECT sum(n.n / t * ln(n.n * t / (na.n * nb.n))) AS mi FROM n JOIN na USING (a) JOIN nb USING (b), t),
ha AS (SELECT -sum(n / t * ln(n / t)) AS h FROM na, t), hb AS (SELECT -sum(n / t * ln(n / t)) AS h FROM nb, t)
SELECT round(mi / ((ha.h + hb.h) / 2), 6) AS nmi FROM mi, ha, hb""",
)
def nmi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.nmi(table(spark, sf_dir, "customer"), "c_mktsegment", "c_nationkey").select(r6("nmi").alias("nmi"))


@query("kmeans_sweep")
def sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.kmeans_sweep(vectors(spark, sf_dir))[0]


@query("kmeans_all_models")
def all_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (k, seed) of the full settings, k from 8 to 16 and ten restarts, fitted in shared passes."""
    seeds = list(range(clustering.SEED, clustering.SEED + clustering.RESTARTS))
    found = kmeans_all(vectors(spark, sf_dir), list(range(clustering.K_MIN, clustering.K_MAX + 1)), seeds)
    return found.select("k", "seed", r6("inertia").alias("inertia"), "iterations", "best")


@query("clustering_summary")
def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sweep with and without principal components, as the two lines of an ablation table."""
    base = vectors(spark, sf_dir).withColumn("Category", F.col("label").cast("string"))
    lines = []
    for pca in (None, 16):
        ready, kept = clustering.prepare_vectors(base, True, pca)
        ready = written(ready)
        scores, models = clustering.kmeans_sweep(ready)
        assigned = clustering.kmeans_assign(models[clustering.select_k(scores).first()["k"]], ready)
        lines.append(clustering.clustering_summary(scores, assigned.select("ID", "Category", "cluster_id"), True, pca, kept))
    return clustering.ablation_table(lines)


@query("pca_reduce")
def pca(spark: SparkSession, sf_dir: str) -> DataFrame:
    reduced, kept = pca_reduce(vectors(spark, sf_dir), 16)
    return reduced.select("ID", F.size("embedding").alias("width"), F.lit(kept).alias("variance_explained"))


# --- features -------------------------------------------------------------------------------

TERMS_SQL = r"""
word AS (SELECT doc_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]{2,}') AS w FROM documents),
term AS (
  SELECT id, unnest(w) AS term FROM word
  UNION ALL SELECT id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM word WHERE len(w) > 1),
tf AS (SELECT id, term, count(*) AS tf FROM term GROUP BY id, term)"""

VOCABULARY_SQL = """
vocab AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS tf FROM tf GROUP BY term HAVING count(*) >= 2 ORDER BY sum(tf) DESC, term LIMIT 30000)"""


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_table(spark, sf_dir, "documents", "ID", ID="doc_id", clean_text="text")


@query(
    "ngrams",
    f"""WITH {TERMS_SQL} SELECT id AS "ID", count(*) AS n_terms, sum(tf)::BIGINT AS n_tokens, max(tf) AS top, min(term) AS first FROM tf GROUP BY id""",
)
def ngram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summed up inside the row first: Spark would sort all (text, term) pairs for the least term of a group."""
    counted = features.term_frequencies(_texts(spark, sf_dir), nested=True)
    summed = counted.select(
        "ID",
        F.size("counts").cast("bigint").alias("n"),
        F.aggregate("counts", F.lit(0).cast("bigint"), lambda s, c: s + c["tf"]).alias("tf"),
        F.array_max("counts.tf").alias("top"),
        F.array_min("counts.term").alias("first"),
    )
    return summed.groupBy("ID").agg(
        F.sum("n").alias("n_terms"), F.sum("tf").alias("n_tokens"), F.max("top").alias("top"), F.min("first").alias("first")
    ).where("n_terms > 0")


@query("build_vocabulary", f"WITH {TERMS_SQL}, {VOCABULARY_SQL} SELECT term, df, tf FROM vocab")
def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.build_vocabulary(_texts(spark, sf_dir))


@query(
    "tfidf",
    f"""WITH {TERMS_SQL}, {VOCABULARY_SQL},
raw AS (
  SELECT t.id, t.term, t.tf * (ln((1 + (SELECT count(*) FROM documents)::DOUBLE) / (1 + v.df)) + 1) AS w FROM tf t JOIN vocab v ON v.term = t.term)
SELECT id AS "ID", term, round(w / sqrt(sum(w * w) OVER (PARTITION BY id)), 6) AS weight FROM raw""",
)
def weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _texts(spark, sf_dir)
    return features.tfidf(texts, features.build_vocabulary(texts), texts.count()).select("ID", "term", r6("weight").alias("weight"))


@query(
    "class_weights",
    """SELECT lang AS "Category", count(*) AS n, round((SELECT count(*) FROM documents)::DOUBLE / ((SELECT count(DISTINCT lang) FROM documents) * count(*)), 6) AS weight
FROM documents GROUP BY lang""",
)
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = table(spark, sf_dir, "documents").select(F.col("lang").alias("Category"))
    return features.class_weights(labelled).withColumn("weight", r6("weight"))


@query(
    "stratified_split",
    """
WITH n AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
t AS (SELECT sum(n) AS total, ceil(0.15::DOUBLE * sum(n)) AS test FROM n),
k0 AS (SELECT lang, n, total, test, n / total::DOUBLE * (total - test) AS exact FROM n, t),
k1 AS (SELECT *, floor(exact) AS fl, row_number() OVER (ORDER BY exact - floor(exact) DESC, lang) AS place,
       (total - test) - sum(floor(exact)) OVER () AS missing FROM k0),
k2 AS (SELECT lang, n, fl + CASE WHEN place <= missing THEN 1 ELSE 0 END AS keep, total - test AS rest,
       ceil(0.15::DOUBLE / (1 - 0.15::DOUBLE) * (total - test)) AS val FROM k1),
k3 AS (SELECT *, keep / rest * (rest - val) AS exact FROM k2),
k4 AS (SELECT *, floor(exact) AS fl, row_number() OVER (ORDER BY exact - floor(exact) DESC, lang) AS place,
       (rest - val) - sum(floor(exact)) OVER () AS missing FROM k3),
q AS (SELECT lang, n - keep AS n_test, keep - (fl + CASE WHEN place <= missing THEN 1 ELSE 0 END) AS n_val FROM k4),
r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id::VARCHAR || '|42'), doc_id) AS rank FROM documents)
SELECT r.doc_id AS "ID", r.lang AS "Category", CASE WHEN rank <= n_test THEN 'test' WHEN rank <= n_test + n_val THEN 'val' ELSE 'train' END AS split
FROM r JOIN q ON q.lang = r.lang""",
)
def split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.stratified_split(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ID"), F.col("lang").alias("Category")))


# --- classifiers ----------------------------------------------------------------------------


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of a document from its text and its vector."""
    documents = text_table(spark, sf_dir, "documents", "ID", ID="doc_id", Category="lang", raw_text="text")
    cleaned = written(clean_text(documents).select("ID", "Category", "clean_text"))
    embedded = embed_text(cleaned.select("ID", "clean_text"))
    profiles = cleaned.join(embedded, "ID")
    return written(classification.classify(profiles))


@query("classify_compare")
def classify_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classification.comparison_table(_predictions(spark, sf_dir))


@query("classify_side_by_side")
def classify_side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    predictions = _predictions(spark, sf_dir)
    return classification.side_by_side(predictions.where(F.col("split") == "test"))


# Rule-made predictions over whole tables: three "models" that guess an order's status.
GUESS_SQL = """
guess AS (
  SELECT m.model, s.split, o_orderkey AS id, o_orderstatus AS t,
    CASE m.model WHEN 'price' THEN CASE WHEN o_totalprice > 200000 THEN 'F' ELSE 'O' END
                 WHEN 'priority' THEN CASE WHEN o_orderpriority LIKE '1%' THEN 'P' WHEN o_orderpriority LIKE '2%' THEN 'F' ELSE 'X' END
                 ELSE CASE WHEN month(o_orderdate) > 6 THEN 'O' ELSE 'F' END END AS p
  FROM orders, (VALUES ('price'), ('priority'), ('season')) AS m(model),
       LATERAL (SELECT CASE WHEN year(o_orderdate) > 1995 THEN 'test' ELSE 'val' END AS split) s),
side AS (
  SELECT model, split, t AS label, (t = p)::INT AS tp, 0 AS fp, (t <> p)::INT AS fn FROM guess
  UNION ALL SELECT model, split, p, 0, 1, 0 FROM guess WHERE t <> p)"""


def guesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.when(F.col("o_totalprice") > 200000, "F").otherwise("O")
    level = F.col("o_orderpriority")
    priority = F.when(level.startswith("1"), "P").when(level.startswith("2"), "F").otherwise("X")
    season = F.when(F.month("o_orderdate") > 6, "O").otherwise("F")
    models = F.array(*[F.struct(F.lit(n).alias("model"), p.alias("y_pred")) for n, p in (("price", price), ("priority", priority), ("season", season))])
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ID"),
        F.when(F.year("o_orderdate") > 1995, "test").otherwise("val").alias("split"),
        F.col("o_orderstatus").alias("y_true"),
        F.inline(models),
    )


PER_SPLIT_SQL = f"""{GUESS_SQL},
class AS (
  SELECT model, split, label, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn,
    CASE WHEN sum(tp) + sum(fp) > 0 THEN sum(tp)::DOUBLE / (sum(tp) + sum(fp)) ELSE 0 END AS precision,
    CASE WHEN sum(tp) + sum(fn) > 0 THEN sum(tp)::DOUBLE / (sum(tp) + sum(fn)) ELSE 0 END AS recall,
    2.0::DOUBLE * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)) AS f1, sum(tp) + sum(fn) AS support
  FROM side GROUP BY model, split, label)"""

# The same without the split, over all orders of a model.
PER_MODEL_SQL = PER_SPLIT_SQL.replace("SELECT model, split, label, sum", "SELECT model, label, sum").replace("GROUP BY model, split, label", "GROUP BY model, label")


@query("comparison_table", f"""WITH {PER_SPLIT_SQL}
SELECT model, split, round(sum(tp)::DOUBLE / sum(support), 6) AS accuracy, round(avg(f1), 6) AS macro_f1,
  round(sum(f1 * support) / sum(support), 6) AS weighted_f1, round(max(f1) - min(f1), 6) AS disparity_gap FROM class GROUP BY model, split""")
def comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classification.comparison_table(guesses(spark, sf_dir)).select(
        "model", "split", *[r6(c).alias(c) for c in ("accuracy", "macro_f1", "weighted_f1", "disparity_gap")]
    )


@query("per_class_f1_table", f"WITH {PER_MODEL_SQL} SELECT model, label AS category, round(f1, 6) AS f1 FROM class WHERE support > 0")
def class_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classification.per_class_f1_table(guesses(spark, sf_dir)).withColumn("f1", r6("f1"))


@query(
    "side_by_side",
    f"""WITH {GUESS_SQL}
SELECT id AS "ID", t AS y_true, max(p) FILTER (WHERE model = 'price') AS price, max(p) FILTER (WHERE model = 'priority') AS priority,
  max(p) FILTER (WHERE model = 'season') AS season FROM guess GROUP BY id, t""",
)
def side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classification.side_by_side(guesses(spark, sf_dir), names={n: n for n in ("price", "priority", "season")})


@query("accuracy", f"WITH {GUESS_SQL} SELECT model, round(avg((t = p)::INT), 6) AS accuracy FROM guess GROUP BY model")
def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.accuracy(guesses(spark, sf_dir), ["model"]).withColumn("accuracy", r6("accuracy"))


@query(
    "per_class",
    f"""WITH {PER_MODEL_SQL}
SELECT model, label, tp::BIGINT AS tp, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support::BIGINT AS support FROM class""",
)
def per_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.per_class(guesses(spark, sf_dir), ["model"]).withColumns({c: r6(c) for c in ("precision", "recall", "f1")})


@query("macro_f1", f"WITH {PER_MODEL_SQL} SELECT model, round(avg(f1), 6) AS macro_f1 FROM class GROUP BY model")
def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.macro_f1(guesses(spark, sf_dir), ["model"]).withColumn("macro_f1", r6("macro_f1"))


@query("weighted_f1", f"WITH {PER_MODEL_SQL} SELECT model, round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM class GROUP BY model")
def weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.weighted_f1(guesses(spark, sf_dir), ["model"]).withColumn("weighted_f1", r6("weighted_f1"))


@query(
    "classification_report",
    f"""WITH {PER_MODEL_SQL}
SELECT model, label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support::BIGINT AS support FROM class
UNION ALL SELECT model, 'accuracy', NULL, NULL, round(sum(tp)::DOUBLE / sum(support), 6), sum(support)::BIGINT FROM class GROUP BY model
UNION ALL SELECT model, 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::BIGINT FROM class GROUP BY model
UNION ALL SELECT model, 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
  round(sum(f1 * support) / sum(support), 6), sum(support)::BIGINT FROM class GROUP BY model""",
)
def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.classification_report(guesses(spark, sf_dir), ["model"]).withColumns({c: r6(c) for c in ("precision", "recall", "f1")})


@query(
    "disparity",
    f"""WITH {PER_MODEL_SQL}
SELECT model, round(min(f1), 6) AS min_f1, round(max(f1), 6) AS max_f1, round(max(f1) - min(f1), 6) AS gap, round(stddev_pop(f1), 6) AS std FROM class GROUP BY model""",
)
def disparity(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = metrics.per_class(guesses(spark, sf_dir), ["model"])
    return metrics.disparity(classes, ["model"]).withColumns({c: r6(c) for c in ("min_f1", "max_f1", "gap", "std")})


@query(
    "evaluate_predictions",
    """
WITH pair AS (SELECT quality AS t, 1 - toxic AS p FROM labels),
side AS (SELECT t AS label, (t = p)::INT AS tp, 0 AS fp, (t <> p)::INT AS fn FROM pair UNION ALL SELECT p, 0, 1, 0 FROM pair WHERE t <> p),
class AS (SELECT label, sum(tp) AS tp, 2.0::DOUBLE * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)) AS f1, sum(tp) + sum(fn) AS support FROM side GROUP BY label)
SELECT round(sum(tp)::DOUBLE / sum(support), 6) AS accuracy, round(avg(f1), 6) AS macro_f1, round(sum(f1 * support) / sum(support), 6) AS weighted_f1,
  round(min(f1), 6) AS disparity_min_f1, round(max(f1), 6) AS disparity_max_f1, round(max(f1) - min(f1), 6) AS disparity_gap,
  round(stddev_pop(f1), 6) AS disparity_std FROM class""",
)
def evaluated(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "labels").select(F.col("quality").alias("y_true"), (1 - F.col("toxic")).alias("y_pred"))
    flat = metrics.flatten_models(metrics.evaluate_predictions(pairs))
    return flat.select(*[r6(c).alias(c) for c in flat.columns])


@query(
    "compare_models",
    f"""WITH {PER_MODEL_SQL}
SELECT model, round(sum(tp)::DOUBLE / sum(support), 6) AS accuracy, round(avg(f1), 6) AS macro_f1, round(sum(f1 * support) / sum(support), 6) AS weighted_f1,
  round(min(f1), 6) AS disparity_min_f1, round(max(f1), 6) AS disparity_max_f1, round(max(f1) - min(f1), 6) AS disparity_gap,
  round(stddev_pop(f1), 6) AS disparity_std FROM class GROUP BY model ORDER BY macro_f1 DESC""",
)
def compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    table_ = metrics.compare_models(metrics.evaluate_predictions(guesses(spark, sf_dir), ["model"]))
    return table_.select("model", *[r6(c).alias(c) for c in table_.columns if c != "model"])
