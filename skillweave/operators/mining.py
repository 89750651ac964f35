"""Frequent itemsets and association rules over skill lists or any baskets."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillweave.operators.joins import lookup_join, one_row
from skillweave.operators.skills import skill_items
from skillweave.session import cut_lineage

MIN_SUPPORT = 0.05
MIN_THRESHOLD = 0.5
METRIC = "confidence"

ITEMSETS = "items array<string>, freq bigint, support double"
METRICS = (
    "support", "confidence", "lift", "leverage", "conviction", "zhangs_metric", "jaccard", "certainty", "kulczynski",
)


def transactions(profiles: DataFrame, skills: DataFrame, key: str = "ID") -> DataFrame:
    """(key, items): distinct items per profile; a profile without skills is an empty transaction."""
    items = skills.select(F.col(key).cast("string").alias(key), F.array_distinct(skill_items(skills)).alias("items"))
    ids = profiles.select(F.col(key).cast("string").alias(key))
    return ids.join(items, key, "left").select(key, F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def order_transactions(tx: DataFrame, key: str = "ID") -> list:
    """Sort columns of transactions without a profile table: whole numbers by value, then the rest as text."""
    number = F.expr(f"try_cast(`{key}` AS bigint)")
    return [number.isNull(), number, F.col(key)]


def basket_transactions(spine: DataFrame, pairs: DataFrame, key: str, item: str) -> DataFrame:
    """(key, items) of every spine key from (key, item) rows; keys without rows give empty baskets."""
    baskets = pairs.select(key, item).distinct().groupBy(key).agg(F.collect_list(item).alias("items"))
    return spine.select(key).join(baskets, key, "left").select(key, F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def item_pairs(tx: DataFrame, key: str = "ID") -> DataFrame:
    """(key, item), each item once per transaction."""
    return tx.select(key, F.explode(F.array_distinct("items")).alias("item"))


def frequent_itemsets(tx: DataFrame, min_support: float = MIN_SUPPORT) -> DataFrame:
    """(items, freq, support) of every itemset in at least ``min_support`` of all transactions.

    Empty transactions count in the denominator. Items are sorted within a set.
    """
    spark = tx.sparkSession
    baskets = tx.select(F.array_distinct("items").alias("items"))
    n = baskets.count()
    if not n:
        return spark.createDataFrame([], ITEMSETS)
    # The miner rounds its own threshold up to a whole count; asked a little lower, it never loses a set.
    model = FPGrowth(itemsCol="items", minSupport=max(0.0, min_support - 1e-9), minConfidence=1.0).fit(baskets)
    support = F.col("freq") / F.lit(float(n))
    found = model.freqItemsets.select(F.array_sort("items").alias("items"), "freq", support.alias("support"))
    # Written once: the model mines again for every use of its result.
    return cut_lineage(found.where(F.col("support") >= min_support))


def _key(items):
    return F.to_json(items)


def association_rules(itemsets: DataFrame, metric: str = METRIC, min_threshold: float = MIN_THRESHOLD) -> DataFrame:
    """Every split of every itemset into antecedent and consequent, with all metrics, at or above the threshold."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric}")
    known = itemsets.select(_key(F.col("items")).alias("key"), "support")
    size = F.size("items")
    masks = F.expr("sequence(1L, shiftleft(1L, size(items)) - 2L)")
    split = (
        itemsets.where(size > 1)
        .select("items", "support", F.explode(masks).alias("mask"))
        .select(
            "support",
            F.expr("filter(items, (x, i) -> (shiftright(mask, i) & 1L) = 1L)").alias("antecedent"),
            F.expr("filter(items, (x, i) -> (shiftright(mask, i) & 1L) = 0L)").alias("consequent"),
        )
    )
    left = known.select(F.col("key").alias("_a"), F.col("support").alias("antecedent_support"))
    right = known.select(F.col("key").alias("_c"), F.col("support").alias("consequent_support"))
    keyed = split.withColumns({"_a": _key(F.col("antecedent")), "_c": _key(F.col("consequent"))})
    rules = lookup_join(lookup_join(keyed, left, "_a"), right, "_c")
    return _with_metrics(rules).where(F.col(metric) >= min_threshold)


def _with_metrics(rules: DataFrame) -> DataFrame:
    s, a, c = F.col("support"), F.col("antecedent_support"), F.col("consequent_support")
    confidence, leverage = s / a, s - a * c
    bound = F.greatest(s * (1 - a), a * (c - s))
    return rules.select(
        "antecedent",
        "consequent",
        "antecedent_support",
        "consequent_support",
        "support",
        confidence.alias("confidence"),
        (confidence / c).alias("lift"),
        leverage.alias("leverage"),
        F.when(confidence < 1, (1 - c) / (1 - confidence)).otherwise(F.lit(float("inf"))).alias("conviction"),
        F.when(bound != 0, leverage / bound).otherwise(F.lit(0.0)).alias("zhangs_metric"),
        (s / (a + c - s)).alias("jaccard"),
        F.when(c < 1, (confidence - c) / (1 - c)).otherwise(F.lit(0.0)).alias("certainty"),
        ((s / a + s / c) / 2).alias("kulczynski"),
    )


def rank_rules(rules: DataFrame) -> DataFrame:
    """Highest lift first; equal lifts by antecedent, then consequent."""
    return rules.orderBy(F.desc("lift"), "antecedent", "consequent")


def mining_meta(tx: DataFrame, min_support: float = MIN_SUPPORT, metric: str = METRIC, min_threshold: float = MIN_THRESHOLD, key: str = "ID") -> DataFrame:
    """One row: transactions, distinct items and the parameters of the run."""
    parts = [
        tx.agg(F.count("*").alias("n_transactions")),
        item_pairs(tx, key).select("item").distinct().agg(F.count("*").alias("n_unique_skills")),
    ]
    return one_row(parts).select(
        "n_transactions",
        "n_unique_skills",
        F.lit(min_support).alias("min_support"),
        F.lit(metric).alias("metric"),
        F.lit(min_threshold).alias("min_threshold"),
    )


class Mined(NamedTuple):
    itemsets: DataFrame
    rules: DataFrame
    meta: DataFrame


def mine_rules(tx: DataFrame, min_support: float = MIN_SUPPORT, metric: str = METRIC, min_threshold: float = MIN_THRESHOLD, key: str = "ID") -> Mined:
    """Itemsets, ranked rules and metadata; without frequent itemsets there are no rules."""
    itemsets = frequent_itemsets(tx, min_support)
    rules = association_rules(itemsets, metric, min_threshold)
    if itemsets.isEmpty():
        rules = rules.limit(0)
    return Mined(itemsets, rank_rules(rules), mining_meta(tx, min_support, metric, min_threshold, key))
