"""Cleaning rules as column expressions, and the counters that describe them.

Each table has a chain of drop reasons (the first that applies counts) and a
set of fixes. Both are computed in the scan; cleaning never shuffles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from threadloom.functions.text import is_blank, is_sentinel, only_symbols
from threadloom.functions.values import unbelievable_time


def _first_reason(*rules: tuple[Column, str]) -> Column:
    return F.coalesce(*[F.when(cond, reason) for cond, reason in rules])


def _users_rules() -> tuple[Column, dict[str, tuple[Column, str, Column]]]:
    reason = _first_reason((is_blank(F.col("author")), "dropped_missing_author"))
    symbols = reason.isNull() & only_symbols(F.col("author_flair_text"))
    return reason, {
        "flair_symbols_only_to_null": (symbols, "author_flair_text", F.lit(None).cast("string")),
    }


def _subreddit_rules() -> tuple[Column, dict]:
    return _first_reason((is_blank(F.col("subreddit_id")), "dropped_missing_subreddit_id")), {}


def _post_rules() -> tuple[Column, dict]:
    reason = _first_reason(
        (is_blank(F.col("subreddit_id")), "dropped_missing_subreddit_id"),
        (unbelievable_time(F.col("created_utc")), "dropped_invalid_created_utc"),
    )
    negative = reason.isNull() & F.coalesce(F.col("edited") < 0, F.lit(False))
    return reason, {
        "edited_negative_to_null": (negative, "edited", F.lit(None).cast("long")),
    }


def _comment_rules() -> tuple[Column, dict]:
    no_link = is_blank(F.col("link_id"))
    reason = _first_reason(
        (no_link, "dropped_missing_link_id"),
        (is_blank(F.col("body")), "dropped_missing_body"),
        (is_sentinel(F.col("body")), "dropped_deleted_or_removed"),
        (unbelievable_time(F.col("created_utc")), "dropped_invalid_created_utc"),
    )
    expected = F.col("ups") - F.col("downs")
    # Counted once the link is accepted, also for rows that are dropped later.
    blank_author = ~no_link & F.col("author").isNotNull() & is_blank(F.col("author"))
    # The comparison is NULL, hence false, when any side is missing.
    wrong = reason.isNull() & F.coalesce(F.col("score") != expected, F.lit(False))
    return reason, {
        "author_empty_to_null": (blank_author, "author", F.lit(None).cast("string")),
        "score_fixed_from_ups_downs": (wrong, "score", expected),
    }


def _moderation_rules() -> tuple[Column, dict]:
    return _first_reason(
        (is_blank(F.col("target_id")), "dropped_missing_target_id"),
        (is_blank(F.col("subreddit_id")), "dropped_missing_subreddit_id"),
    ), {}


# Drop counters of each table, in the order in which the reasons are judged.
DROP_REASONS = {
    "users": ["dropped_missing_author"],
    "subreddit": ["dropped_missing_subreddit_id"],
    "post": ["dropped_missing_subreddit_id", "dropped_invalid_created_utc"],
    "comment": [
        "dropped_missing_link_id", "dropped_missing_body", "dropped_deleted_or_removed",
        "dropped_invalid_created_utc",
    ],
    "moderation": ["dropped_missing_target_id", "dropped_missing_subreddit_id"],
}

_RULES: dict[str, Callable[[], tuple[Column, dict]]] = {
    "users": _users_rules,
    "subreddit": _subreddit_rules,
    "post": _post_rules,
    "comment": _comment_rules,
    "moderation": _moderation_rules,
}


def clean(table: str, df: DataFrame) -> DataFrame:
    """The rows a table keeps, with its fixes applied."""
    reason, fixes = _RULES[table]()
    fixed = {column: F.when(hit, value).otherwise(F.col(column))
             for hit, column, value in fixes.values()}
    return df.filter(reason.isNull()).select(
        *[fixed[c].alias(c) if c in fixed else F.col(c) for c in df.columns]
    )


def _counters(table: str) -> dict[str, Column]:
    """Counters over rows that are judged: seen, processed, kept, every drop and every fix."""
    _, fixes = _RULES[table]()
    return {
        "seen": F.count(F.lit(1)),
        "processed": F.count(F.lit(1)),
        "kept": F.count_if(F.col("_reason").isNull()),
        **{r: F.count_if(F.col("_reason") == r) for r in DROP_REASONS[table]},
        **{name: F.count_if(F.col(f"_{name}")) for name in fixes},
    }


def _judged(table: str, df: DataFrame) -> DataFrame:
    reason, fixes = _RULES[table]()
    return df.select("*", reason.alias("_reason"), *[
        hit.alias(f"_{name}") for name, (hit, _, _) in fixes.items()])


def clean_stats(table: str, df: DataFrame) -> DataFrame:
    """Counters of one table in one pass."""
    counters = _counters(table)
    one_row = _judged(table, df).agg(*[c.alias(name) for name, c in counters.items()])
    return one_row.unpivot([], list(counters), "counter", "row_count").select(
        F.lit(table).alias("table_name"), "counter", "row_count"
    )


def clean_observed(table: str, df: DataFrame) -> tuple[DataFrame, Observation]:
    """The cleaned rows, and the counters of their table, which Spark fills while they are written."""
    observation = Observation(f"clean {table}")
    counters = [c.alias(name) for name, c in _counters(table).items()]
    _, fixes = _RULES[table]()
    fixed = {column: F.when(F.col(f"_{name}"), value).otherwise(F.col(column))
             for name, (_, column, value) in fixes.items()}
    rows = _judged(table, df).observe(observation, *counters).filter(F.col("_reason").isNull())
    return rows.select(
        *[fixed[c].alias(c) if c in fixed else F.col(c) for c in df.columns]), observation


def observed_stats(spark: SparkSession, table: str, observation: Observation) -> DataFrame:
    """The counters that were taken by `clean_observed`; one row each."""
    return spark.createDataFrame(
        [(table, name, int(n)) for name, n in observation.get.items()],
        "table_name string, counter string, row_count long")


def totals(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per source table."""
    result = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("total_rows")).select(
            F.lit(name).alias("table_name"), "total_rows"
        )
        result = row if result is None else result.unionByName(row)
    return result
