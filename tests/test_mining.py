import math
import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from threadloom.operators import mining


def transactions(spark, lists):
    return spark.createDataFrame([(sorted(t),) for t in lists], "items array<string>")


def brute(lists, min_support):
    counts = Counter(s for t in lists for k in range(1, len(t) + 1)
                     for s in combinations(sorted(t), k))
    return {s: n / len(lists) for s, n in counts.items() if n / len(lists) >= min_support}


def found(itemsets):
    return {tuple(r["items"]): r.support for r in itemsets.collect()}


LISTS = [["a", "b"]] * 7 + [["a", "c"]] * 40 + [["c"]] * 30 + [["d", "e", "f"]] * 20 + [["g"]] * 3


@pytest.mark.parametrize("support", [0.07, 0.03, 0.2, 0.31, 0.0001])
def test_itemsets_at_the_limit(spark, support):
    tx = transactions(spark, LISTS)
    expected = brute(LISTS, support)
    assert found(mining.frequent_itemsets(mining.count_equal(tx), support)) == expected


def test_wide_transactions_equal_brute_force(spark):
    rng = random.Random(8)
    lists = [rng.sample("abcdefghijklmno", 12) for _ in range(40)] + [list("abcdefghijkl")] * 9
    for support in (0.15, 0.45):
        counts = mining.count_equal(transactions(spark, lists))
        expected = brute(lists, support)
        assert found(mining.frequent_itemsets(counts, support)) == expected
        assert max(map(len, expected)) > (7 if support < 0.2 else 3)


def test_candidates_hold_no_rare_subset(spark):
    frequent = spark.createDataFrame([(list(s),) for s in ("ab", "ac", "bc", "ad", "bd")],
                                     "items array<string>")
    got = {"".join(r["items"]) for r in mining._candidates(frequent, 3).collect()}
    assert got == {"abc", "abd"}


def test_empty_and_repeated_items(spark):
    none = spark.createDataFrame([], "items array<string>, n long")
    assert mining.frequent_itemsets(none, 0.1).collect() == []
    twice = spark.createDataFrame([(["a", "a", "b"], 2), ([], 2)], "items array<string>, n long")
    assert found(mining.frequent_itemsets(twice, 0.5)) == {
        ("a",): 0.5, ("b",): 0.5, ("a", "b"): 0.5}


def test_rules_against_direct_counts(spark):
    counts = mining.count_equal(transactions(spark, LISTS))
    supports = brute(LISTS, 0.05)
    rules = mining.association_rules(mining.frequent_itemsets(counts, 0.05), 0.1).collect()
    expected = {}
    for items, support in supports.items():
        for k in range(1, len(items)):
            for a in combinations(items, k):
                c = tuple(x for x in items if x not in a)
                confidence = support / supports[a]
                if confidence >= 0.1:
                    expected[a, c] = (support, confidence, confidence / supports[c])
    got = {(tuple(r.antecedents), tuple(r.consequents)): (r.support, r.confidence, r.lift)
           for r in rules}
    assert got == expected
    for r in rules:
        if r.confidence == 1:
            assert math.isinf(r.conviction)
        else:
            assert r.conviction == (1 - r.consequent_support) / (1 - r.confidence)


def test_published_rule_metrics(spark):
    """A rule with support 0.0709, confidence 0.9232 and lift 1.1639."""
    row = spark.range(1).select(
        mining.lift(F.lit(0.9232), F.lit(0.9232 / 1.1639)).alias("lift"),
        mining.conviction(F.lit(0.9232), F.lit(0.9232 / 1.1639)).alias("conviction"),
    ).first()
    assert row.lift == pytest.approx(1.1639)
    assert row.conviction == pytest.approx((1 - 0.9232 / 1.1639) / (1 - 0.9232))


def test_items(spark):
    df = spark.createDataFrame(
        [("news", 51, 1, 1, -1, 1, "None"), (None, None, None, None, None, None, "admin"),
         ("x", 50, 0, 0, 0, 0, None), ("x", 6, 0, 0, 7, 2, None), ("x", 5, 0, 0, 0, 0, None),
         ("x", 1, 0, 0, 0, 0, None), ("x", 0, 0, 0, 0, 0, None)],
        "subreddit string, score int, gilded int, controversiality int, edited long, archived int,"
        " distinguished string")
    got = [r["items"] for r in mining.transactions(df).collect()]
    assert got[0] == ["archived", "controversial", "edited", "gilded", "subreddit:news",
                      "very_high_score"]
    assert got[1] == ["distinguished", "negative_score"]
    assert [g[-2] if g[-1].startswith("sub") else g[-1] for g in got[2:]] == [
        "high_score", "medium_score", "low_score", "low_score", "negative_score"]
    assert "edited" in got[3]


def test_early_counting_equals_row_transactions(ws, rows_of):
    early = mining.transaction_counts(ws.cleaned)
    by_row = mining.count_equal(mining.transactions(mining.mining_input(ws.cleaned)))
    assert rows_of(early) == rows_of(by_row)
