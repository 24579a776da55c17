"""Transactions, frequent itemsets and association rules.

A transaction has few items (community, score band, gilded, controversial, edited,
distinguished, archived), so equal ones are counted first. Comments are counted per post and item combination even before
they meet their post, which keeps very active posts cheap. Everything after
that works on distinct transactions, whose number depends on the communities
and not on the comments.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.operators.ranking import top
from threadloom.session import store_shared

Tables = Mapping[str, DataFrame]
Store = Callable[[DataFrame], DataFrame]

MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.5

# Lower bounds (exclusive) of the score bands, best first.
SCORE_BANDS = [(50, "very_high_score"), (20, "high_score"), (5, "medium_score"), (0, "low_score")]
LOWEST_BAND = "negative_score"


def mining_input(cleaned: Tables) -> DataFrame:
    """Cleaned comments with the attributes of their post and community."""
    return (
        cleaned["comment"]
        .select("link_id", "score", "gilded", "controversiality", "edited")
        .join(cleaned["post"].select("link_id", "subreddit_id", "archived"), "link_id")
        .join(cleaned["subreddit"], "subreddit_id")
        .select(
            "subreddit", "score", "gilded", "controversiality", "edited", "archived",
            F.lit(None).cast("string").alias("distinguished"),
        )
    )


def subreddit_item(name: Column) -> Column:
    """The community item; NULL without a name."""
    return F.concat(F.lit("subreddit:"), name)


def score_item(score: Column) -> Column:
    """The score band; a missing score falls into the lowest one."""
    bands = reduce(
        lambda chain, band: chain.when(score > band[0], band[1]),
        SCORE_BANDS[1:],
        F.when(score > SCORE_BANDS[0][0], SCORE_BANDS[0][1]),
    )
    return bands.otherwise(LOWEST_BAND)


def gilded_item(value: Column) -> Column:
    return F.when(value > 0, "gilded")


def controversial_item(value: Column) -> Column:
    return F.when(value > 0, "controversial")


def edited_item(value: Column) -> Column:
    return F.when(value != 0, "edited")


def distinguished_item(value: Column) -> Column:
    return F.when(value != "None", "distinguished")


def archived_item(value: Column) -> Column:
    return F.when(value == 1, "archived")


def _items(*items: Column) -> Column:
    """A sorted array of the items that are present."""
    return F.array_sort(F.array_compact(F.array(*items)))


def transactions(rows: DataFrame) -> DataFrame:
    """One item array per input row, in item order."""
    return rows.select(
        _items(
            subreddit_item(F.col("subreddit")),
            score_item(F.col("score")),
            gilded_item(F.col("gilded")),
            controversial_item(F.col("controversiality")),
            edited_item(F.col("edited")),
            distinguished_item(F.col("distinguished")),
            archived_item(F.col("archived")),
        ).alias("items")
    ).filter(F.size("items") > 0)


def count_equal(tx: DataFrame) -> DataFrame:
    """Distinct transactions with the number of times each occurs."""
    return tx.groupBy("items").agg(F.count(F.lit(1)).alias("n"))


def transaction_counts(cleaned: Tables) -> DataFrame:
    """`count_equal(transactions(mining_input(...)))`, counted before the joins."""
    per_post = (
        cleaned["comment"]
        .select(
            "link_id",
            score_item(F.col("score")).alias("score"),
            gilded_item(F.col("gilded")).alias("gilded"),
            controversial_item(F.col("controversiality")).alias("controversial"),
            edited_item(F.col("edited")).alias("edited"),
        )
        .groupBy("link_id", "score", "gilded", "controversial", "edited")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    per_community = (
        per_post.join(cleaned["post"].select("link_id", "subreddit_id", "archived"), "link_id")
        .groupBy(
            "subreddit_id", "score", "gilded", "controversial", "edited",
            archived_item(F.col("archived")).alias("archived"),
        )
        .agg(F.sum("n").alias("n"))
    )
    return (
        per_community.join(cleaned["subreddit"], "subreddit_id")
        .select(
            _items(
                subreddit_item(F.col("subreddit")), F.col("score"), F.col("gilded"),
                F.col("controversial"), F.col("edited"), F.col("archived"),
            ).alias("items"),
            "n",
        )
        .filter(F.size("items") > 0)
        .groupBy("items")
        .agg(F.sum("n").alias("n"))
    )


def encoding(counts: DataFrame) -> DataFrame:
    """Size of the item matrix: its transactions and its distinct items."""
    one_row = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("transactions"))
    items = counts.select(F.explode("items").alias("item")).agg(F.count_distinct("item"))
    return one_row.select("transactions", items.scalar().alias("unique_items"))


def item_counts(counts: DataFrame) -> DataFrame:
    """Column totals of the item matrix."""
    return (
        counts.select(F.explode("items").alias("item"), "n")
        .groupBy("item").agg(F.sum("n").alias("transactions"))
    )


def _subset(items: str, mask: str, bit: int) -> Column:
    return F.filter(
        F.col(items), lambda _, i: F.getbit(F.col(mask), i) == F.lit(bit)
    )


def _candidates(frequent: DataFrame, length: int) -> DataFrame:
    """Itemsets of `length` all of whose subsets of one item less are frequent.

    Two frequent itemsets that differ in their last item alone are joined; then those are pruned that
    hold a rare subset.
    """
    prefix = F.slice("items", 1, length - 2)
    left, right = (frequent.select(prefix.alias("prefix"), F.element_at("items", -1).alias(name))
                   for name in ("a", "b"))
    joined = left.join(right, "prefix").filter("a < b").select(
        F.concat("prefix", F.array("a", "b")).alias("items"))
    if length == 2:
        return joined
    subsets = joined.select("items", F.explode(F.sequence(F.lit(0), F.lit(length - 1))).alias("out")
                            ).select(F.col("items").alias("whole"), F.filter(
                                "items", lambda _, i: i != F.col("out")).alias("items"))
    rare = subsets.join(frequent.select("items"), "items", "left_anti").select(
        F.col("whole").alias("items"))
    return joined.join(rare, "items", "left_anti")


def frequent_itemsets(
    counts: DataFrame, min_support: float = MIN_SUPPORT, store: Store = store_shared
) -> DataFrame:
    """All itemsets with at least `min_support`, from counted transactions of any width.

    Level by level: candidates come from the frequent itemsets of one item less, and are counted where
    they occur. A transaction is represented by its frequent itemsets of the level before; two of them
    with a common beginning make one of the next. Every level is stored.
    """
    numbered = store(counts.select(
        F.monotonically_increasing_id().alias("tx"), "n",
        F.array_sort(F.array_distinct("items")).alias("items")))
    total = numbered.agg(F.sum("n")).scalar()
    occurs = numbered.select("tx", "n", F.explode("items").alias("item")).select(
        "tx", "n", F.array("item").alias("items"))
    levels, length = [], 1
    while True:
        level = store(
            occurs.groupBy("items").agg(F.sum("n").alias("freq"))
            .select("items", "freq", (F.col("freq") / total).alias("support"),
                    F.lit(length).alias("length"))
            .filter(F.col("support") >= F.lit(min_support)))
        if levels and level.isEmpty():
            break
        levels.append(level)
        length += 1
        kept = store(occurs.join(level.select("items"), "items", "left_semi"))
        candidates = _candidates(level, length)
        begins = F.slice("items", 1, length - 2)
        left, right = (kept.select("tx", begins.alias("prefix"), F.element_at("items", -1).alias(name),
                                   *extra) for name, extra in (("a", ["n"]), ("b", [])))
        occurs = (
            left.join(right, ["tx", "prefix"]).filter("a < b")
            .select("tx", "n", F.concat("prefix", F.array("a", "b")).alias("items"))
            .join(candidates, "items", "left_semi"))
    return reduce(DataFrame.unionByName, levels)


def association_rules(itemsets: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Every split of every itemset into antecedent and consequent, with its metrics.

    Supports of both sides are looked up among the itemsets, which contain all
    subsets of each other. Their number is bounded by 127 / min_support.
    """
    splits = (
        itemsets.filter(F.col("length") > 1)
        .select(
            "items", "support",
            F.explode(
                F.sequence(F.lit(1), F.pow(F.lit(2), F.col("length")).cast("int") - 2)
            ).alias("mask"),
        )
        .select(
            _subset("items", "mask", 1).alias("antecedents"),
            _subset("items", "mask", 0).alias("consequents"),
            "support",
        )
    )
    left = itemsets.select(
        F.col("items").alias("antecedents"), F.col("support").alias("antecedent_support")
    )
    right = itemsets.select(
        F.col("items").alias("consequents"), F.col("support").alias("consequent_support")
    )
    confident = (
        splits.join(left, "antecedents")
        .withColumn("confidence", F.col("support") / F.col("antecedent_support"))
        .filter(F.col("confidence") >= F.lit(min_confidence))
    )
    return confident.join(right, "consequents").select(
        "antecedents", "consequents", "antecedent_support", "consequent_support", "support",
        "confidence",
        lift(F.col("confidence"), F.col("consequent_support")).alias("lift"),
        conviction(F.col("confidence"), F.col("consequent_support")).alias("conviction"),
    )


def lift(confidence: Column, consequent_support: Column) -> Column:
    return confidence / consequent_support


def conviction(confidence: Column, consequent_support: Column) -> Column:
    """Infinite for a rule without exceptions."""
    return F.when(
        confidence < 1, (F.lit(1.0) - consequent_support) / (F.lit(1.0) - confidence)
    ).otherwise(F.lit(float("inf")))


def rule_order() -> list[Column]:
    return [
        F.col("confidence").desc(), F.col("lift").desc(),
        F.array_join("antecedents", ", ").asc(), F.array_join("consequents", ", ").asc(),
    ]


def itemset_order() -> list[Column]:
    return [F.col("support").desc(), F.array_join("items", ", ").asc()]


def top_rules(rules: DataFrame, k: int = 20) -> DataFrame:
    """The strongest rules by confidence, then lift."""
    return top(rules, k, *rule_order())


def top_itemsets(itemsets: DataFrame, k: int = 50) -> DataFrame:
    """The most frequent itemsets."""
    return top(itemsets, k, *itemset_order())


def summary(
    counts: DataFrame, itemsets: DataFrame, rules: DataFrame, digits: int | None = 4
) -> DataFrame:
    """Sizes of every stage and the mean metrics, rounded unless `digits` is None."""

    def shown(value: Column) -> Column:
        return value if digits is None else F.round(value, digits)

    return rules.agg(
        F.count(F.lit(1)).alias("association_rules"),
        shown(F.avg("confidence")).alias("average_confidence"),
        shown(F.avg("lift")).alias("average_lift"),
        F.count_if(F.col("lift") > 1).alias("rules_with_positive_lift"),
    ).select(
        counts.agg(F.sum("n")).scalar().alias("transactions"),
        itemsets.agg(F.count(F.lit(1))).scalar().alias("frequent_itemsets"),
        "association_rules", "average_confidence", "average_lift", "rules_with_positive_lift",
    )
