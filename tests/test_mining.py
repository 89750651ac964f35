from __future__ import annotations

from itertools import combinations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from skillweave.operators import mining
from skillweave.operators.joins import lookup_join

BASKETS = [["a", "b", "c"], ["a", "b"], ["a", "c", "a"], ["b"], [], ["a", "b", "c", "d"], ["a"], ["b", "c"], [], ["a", "b", "c"]]


@pytest.fixture(scope="module")
def tx(spark):
    return spark.createDataFrame([(str(i), b) for i, b in enumerate(BASKETS)], "ID string, items array<string>")


def brute(min_support):
    sets = [set(b) for b in BASKETS]
    items = sorted(set().union(*sets))
    found = {}
    for size in range(1, len(items) + 1):
        for combo in combinations(items, size):
            support = sum(set(combo) <= s for s in sets) / len(sets)
            if support >= min_support:
                found[combo] = support
    return found


@pytest.mark.parametrize("min_support", [0.1, 0.3, 0.4])
def test_itemsets_and_rules_equal_brute_force(tx, min_support):
    expect = brute(min_support)
    itemsets = mining.frequent_itemsets(tx, min_support)
    assert {tuple(r["items"]): r["support"] for r in itemsets.collect()} == expect
    rules = {(tuple(r["antecedent"]), tuple(r["consequent"])): r for r in mining.association_rules(itemsets, "confidence", 0.5).collect()}
    wanted = {}
    for whole, support in expect.items():
        for size in range(1, len(whole)):
            for left in combinations(whole, size):
                right = tuple(x for x in whole if x not in left)
                if support / expect[left] >= 0.5:
                    wanted[(left, right)] = (support / expect[left], support / expect[left] / expect[right])
    assert {k: (pytest.approx(v["confidence"]), pytest.approx(v["lift"])) for k, v in rules.items()} == wanted


def test_a_count_exactly_at_the_threshold_is_kept(spark):
    baskets = spark.createDataFrame([(str(i), ["x"] if i < 124 else []) for i in range(2480)], "ID string, items array<string>")
    assert [tuple(r) for r in mining.frequent_itemsets(baskets, 0.05).collect()] == [(["x"], 124, 0.05)]


def test_metrics_of_one_rule(spark):
    sets = spark.createDataFrame([(["a"], 5, 0.5), (["b"], 4, 0.4), (["a", "b"], 4, 0.4)], mining.ITEMSETS)
    rule = mining.association_rules(sets, "lift", 0.0).where(F.col("antecedent") == F.array(F.lit("b"))).first()
    assert (rule["confidence"], rule["conviction"]) == (1.0, float("inf"))
    assert rule["lift"] == pytest.approx(2.0) and rule["leverage"] == pytest.approx(0.2)
    assert rule["zhangs_metric"] == pytest.approx(0.2 / max(0.4 * 0.6, 0.4 * 0.1)) and rule["jaccard"] == pytest.approx(0.8)
    assert rule["certainty"] == pytest.approx(1.0) and rule["kulczynski"] == pytest.approx(0.9)


def test_threshold_on_another_metric_and_order(tx):
    itemsets = mining.frequent_itemsets(tx, 0.1)
    ranked = mining.rank_rules(mining.association_rules(itemsets, "lift", 1.0)).collect()
    lifts = [r["lift"] for r in ranked]
    assert lifts == sorted(lifts, reverse=True) and min(lifts) >= 1.0
    with pytest.raises(ValueError):
        mining.association_rules(itemsets, "unknown", 1.0)


def test_nothing_frequent(tx):
    mined = mining.mine_rules(tx, min_support=0.99)
    assert mined.itemsets.count() == 0 and mined.rules.count() == 0
    assert mining.frequent_itemsets(tx.limit(0)).count() == 0


def test_meta_counts_empty_transactions(tx):
    assert tuple(mining.mining_meta(tx).first()) == (10, 4, 0.05, "confidence", 0.5)


def test_profiles_without_skills_are_empty_transactions(spark):
    profiles = spark.createDataFrame([(1,), (2,)], "ID int")
    skills = spark.createDataFrame([("1", ["SQL ", ""], ["sql", "calm"])], "ID string, technical array<string>, soft array<string>")
    assert rows(mining.transactions(profiles, skills)) == [("1", ["sql", "calm"]), ("2", [])]


def test_order_without_profiles_is_numeric(spark):
    df = spark.createDataFrame([("10", []), ("9", []), ("x", [])], "ID string, items array<string>")
    assert [r["ID"] for r in df.orderBy(*mining.order_transactions(df)).collect()] == ["9", "10", "x"]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_beyond_the_broadcast_bound(spark, how):
    # A third of all facts share one key; one key has no match.
    facts = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    dim = spark.range(49).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    expect = rows(facts.join(dim, "k", how), "id", "k", "v")
    assert rows(lookup_join(facts, dim, "k", how, max_broadcast_rows=5), "id", "k", "v") == expect
    assert rows(lookup_join(facts, dim, "k", how), "id", "k", "v") == expect
