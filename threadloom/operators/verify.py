"""Comparison of raw and cleaned tables, and checks of what cleaning left behind."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom import schemas
from threadloom.functions.text import mentions_sentinel
from threadloom.functions.values import unbelievable_time
from threadloom.operators.ranking import top

Tables = Mapping[str, DataFrame]
COUNT_NAMES = {"moderation": "mod"}


def counts(raw: Tables, cleaned: Tables) -> DataFrame:
    """Raw and cleaned row counts of the five tables in one row."""
    one_row = raw["subreddit"].sparkSession.range(1)
    columns = []
    for table in schemas.CLEANED_TABLES:
        name = COUNT_NAMES.get(table, table)
        for label, tables in (("raw", raw), ("clean", cleaned)):
            total = tables[table].agg(F.count(F.lit(1))).scalar()
            columns.append(total.alias(f"{label}_{name}"))
    return one_row.select(*columns)


def removed(table: str, raw: Tables, cleaned: Tables) -> DataFrame:
    """Distinct raw rows that are not among the cleaned rows, changed rows included.

    EXCEPT as one hash aggregate over both tables: the set difference that
    `subtract` gives, without sorting both sides by all columns for a join.
    """
    names = raw[table].columns
    both = raw[table].withColumn("_cleaned", F.lit(False)).unionByName(
        cleaned[table].select(*names).withColumn("_cleaned", F.lit(True))
    )
    sides = both.groupBy(*names).agg(F.max("_cleaned").alias("_cleaned"))
    return sides.filter(~F.col("_cleaned")).drop("_cleaned")


def removed_count(table: str, raw: Tables, cleaned: Tables) -> DataFrame:
    label = {"post": "posts", "comment": "comments"}.get(table, table)
    return removed(table, raw, cleaned).agg(F.count(F.lit(1)).alias(f"{label}_removed"))


def removed_sample(table: str, raw: Tables, cleaned: Tables, k: int = 10) -> DataFrame:
    """The first k of those rows by key."""
    difference = removed(table, raw, cleaned)
    return top(difference, k, *[F.col(c).asc_nulls_last() for c in difference.columns])


def bad_times(cleaned: Tables) -> DataFrame:
    return cleaned["comment"].filter(unbelievable_time(F.col("created_utc"))).agg(
        F.count(F.lit(1)).alias("invalid_comment_timestamps")
    )


def deleted_bodies(cleaned: Tables) -> DataFrame:
    """Bodies that still contain a marker; the cleaner only drops bodies equal to one."""
    return cleaned["comment"].filter(mentions_sentinel(F.col("body"))).agg(
        F.count(F.lit(1)).alias("deleted_or_removed_bodies")
    )


def bad_scores(cleaned: Tables) -> DataFrame:
    return cleaned["comment"].filter(F.col("score") != F.col("ups") - F.col("downs")).agg(
        F.count(F.lit(1)).alias("incorrect_scores")
    )


def orphans(cleaned: Tables) -> DataFrame:
    """Cleaned comments whose post was dropped, counted per post before the lookup."""
    per_post = cleaned["comment"].groupBy("link_id").agg(F.count(F.lit(1)).alias("n"))
    return per_post.join(cleaned["post"].select("link_id"), "link_id", "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_comments")
    )
