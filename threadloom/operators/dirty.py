"""Finders for dirty rows in the relational tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.functions.text import is_empty, mentions_sentinel
from threadloom.functions.values import unbelievable_time

Tables = Mapping[str, DataFrame]


def missing_author(t: Tables) -> DataFrame:
    return t["comment"].filter(is_empty(F.col("author")))


def missing_subreddit(t: Tables) -> DataFrame:
    return t["post"].filter(is_empty(F.col("subreddit_id")))


def missing_body(t: Tables) -> DataFrame:
    return t["comment"].filter(is_empty(F.col("body")))


def non_positive_time(t: Tables) -> DataFrame:
    return t["comment"].filter(F.col("created_utc") <= 0)


def time_out_of_range(t: Tables) -> DataFrame:
    return t["comment"].filter(unbelievable_time(F.col("created_utc")))


def _absent(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    known = parent.select(F.col(parent_key).alias("_known"))
    return child.join(known, F.col(key) == F.col("_known"), "left_anti")


def comment_without_post(t: Tables) -> DataFrame:
    return _absent(t["comment"], "link_id", t["post"], "link_id")


def post_without_subreddit(t: Tables) -> DataFrame:
    return _absent(t["post"], "subreddit_id", t["subreddit"], "subreddit_id")


def unknown_author(t: Tables) -> DataFrame:
    named = t["comment"].filter(F.col("author").isNotNull())
    return _absent(named, "author", t["users"], "author")


def _repeated(df: DataFrame, key: str) -> DataFrame:
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.filter(F.col("row_count") > 1)


def repeated_posts(t: Tables) -> DataFrame:
    return _repeated(t["post"], "link_id")


def repeated_comments(t: Tables) -> DataFrame:
    return _repeated(t["comment"], "id")


def repeated_users(t: Tables) -> DataFrame:
    return _repeated(t["users"], "author")


def wrong_score(t: Tables) -> DataFrame:
    """Scores that differ from ups minus downs, where a missing side also differs."""
    return t["comment"].filter(
        ~F.col("score").eqNullSafe(F.col("ups") - F.col("downs"))
    ).select("id", "score", "ups", "downs")


def negative_edit(t: Tables) -> DataFrame:
    return t["comment"].filter(F.col("edited") < 0)


def edited_archive(t: Tables) -> DataFrame:
    return t["post"].filter((F.col("archived") == 1) & (F.col("edited") > 0))


def flair_without_user(t: Tables) -> DataFrame:
    has_flair = F.col("author_flair_text").isNotNull() | F.col("author_flair_css_class").isNotNull()
    return t["users"].filter(has_flair & F.col("author").isNull())


def symbol_flair(t: Tables) -> DataFrame:
    """Flair that starts with a symbol; the cleaner is stricter and wants symbols only."""
    return t["users"].filter(F.col("author_flair_text").rlike("^[!@#$%^&*]"))


def broken_reply(t: Tables, prefix: str = "") -> DataFrame:
    """Replies whose parent is absent; ids compared as stored, or with a prefix added."""
    replies = t["comment"].filter(F.col("parent_id").like("t1_%"))
    ids = t["comment"].select(F.concat(F.lit(prefix), F.col("id")).alias("id"))
    return _absent(replies, "parent_id", ids, "id")


def broken_top_level(t: Tables) -> DataFrame:
    top_level = t["comment"].filter(F.col("parent_id").like("t3_%"))
    return _absent(top_level, "parent_id", t["post"], "link_id")


def withdrawn_body(t: Tables) -> DataFrame:
    return t["comment"].filter(mentions_sentinel(F.col("body")))


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    "dirty_1_1": missing_author,
    "dirty_1_2": missing_subreddit,
    "dirty_1_3": missing_body,
    "dirty_2_1": non_positive_time,
    "dirty_2_2": time_out_of_range,
    "dirty_3_1": comment_without_post,
    "dirty_3_2": post_without_subreddit,
    "dirty_3_3": unknown_author,
    "dirty_4_1": repeated_posts,
    "dirty_4_2": repeated_comments,
    "dirty_4_3": repeated_users,
    "dirty_5_1": wrong_score,
    "dirty_5_2": negative_edit,
    "dirty_5_3": edited_archive,
    "dirty_6_1": flair_without_user,
    "dirty_6_2": symbol_flair,
    "dirty_7_1": broken_reply,
    "dirty_7_2": broken_top_level,
    "dirty_8_1": withdrawn_body,
    "dirty_8_2": withdrawn_body,
}
