"""Row counts, reference checks and join smoke queries over the six tables.

Reference checks count child rows per key first and look up the key once, so a
key held by many rows costs one row per map task in the join.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.operators.ranking import top

Tables = Mapping[str, DataFrame]


def row_count(df: DataFrame, column: str) -> DataFrame:
    """Number of rows as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias(column))


def _unmatched(
    child: DataFrame, key: str, parent: DataFrame, parent_key: str, column: str,
    count_null: bool = False,
) -> DataFrame:
    if not count_null:
        child = child.filter(F.col(key).isNotNull())
    keys = child.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    known = parent.select(F.col(parent_key).alias("_key"))
    return keys.join(known, "_key", "left_anti").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias(column)
    )


def missing_user_refs(t: Tables) -> DataFrame:
    """Posts whose author is given but is not in users."""
    return _unmatched(t["post"], "author", t["users"], "author", "missing_user_refs")


def missing_subreddit_refs(t: Tables) -> DataFrame:
    """Posts whose community does not exist."""
    return _unmatched(
        t["post"], "subreddit_id", t["subreddit"], "subreddit_id", "missing_subreddit_refs", True
    )


def invalid_post_links(t: Tables) -> DataFrame:
    """Post links that point at no post."""
    return _unmatched(t["post_link"], "post_id", t["post"], "link_id", "invalid_post_links", True)


def invalid_comment_links(t: Tables) -> DataFrame:
    """Comments whose link has no post link."""
    return _unmatched(
        t["comment"], "link_id", t["post_link"], "link_id", "invalid_comment_links", True
    )


def invalid_parents(t: Tables, prefix: str = "") -> DataFrame:
    """Comments whose parent comment does not exist.

    Ids are compared as stored. Parents carry a type prefix and ids do not, so
    pass it as `prefix` to compare like with like.
    """
    parents = t["comment"].select(F.concat(F.lit(prefix), F.col("id")).alias("id"))
    return _unmatched(t["comment"], "parent_id", parents, "id", "invalid_parent_comments")


def invalid_moderation_subs(t: Tables) -> DataFrame:
    """Moderation rows whose community does not exist."""
    return _unmatched(
        t["moderation"], "subreddit_id", t["subreddit"], "subreddit_id",
        "invalid_moderation_subs", True,
    )


def post_join(t: Tables, k: int = 10) -> DataFrame:
    """Posts with their author and community."""
    joined = (
        t["post"]
        .join(t["users"].select("author"), "author")
        .join(t["subreddit"], "subreddit_id")
        .select("link_id", "author", "subreddit", "created_utc")
    )
    return top(joined, k, F.col("link_id").asc())


def comment_join(t: Tables, k: int = 10) -> DataFrame:
    """Comments with their post and, where known, their author.

    Links meet posts first, so that comments are shuffled once. The first k
    comments are taken before the author lookup, which never drops a row.
    """
    posts = t["post"].select(F.col("link_id").alias("post_link"))
    links = t["post_link"].join(posts, F.col("post_id") == F.col("post_link")).select(
        "link_id", "post_link"
    )
    matched = t["comment"].join(links, "link_id").select(
        "id", "body", "post_link", F.col("author").alias("_author")
    )
    first = top(matched, k, F.col("id").asc())
    known = t["users"].select("author")
    return first.join(known, F.col("_author") == known["author"], "left").select(
        "id", "body", "post_link", "author"
    ).orderBy("id")


def moderation_join(t: Tables, k: int = 10) -> DataFrame:
    """Moderation rows with the name of their community."""
    joined = t["moderation"].join(t["subreddit"], "subreddit_id").select(
        "mod_action_id", "target_type", "target_id", "subreddit", "removal_reason"
    )
    return top(joined, k, F.col("mod_action_id").asc())


def posts_per_subreddit(t: Tables, k: int = 10) -> DataFrame:
    """Communities with the most posts."""
    counts = t["post"].groupBy("subreddit_id").agg(F.count(F.lit(1)).alias("posts"))
    return top(counts, k, F.col("posts").desc(), F.col("subreddit_id").asc())


def comments_per_post(t: Tables, k: int = 10) -> DataFrame:
    """Posts with the most comments."""
    counts = t["comment"].groupBy("link_id").agg(F.count(F.lit(1)).alias("comment_count"))
    return top(counts, k, F.col("comment_count").desc(), F.col("link_id").asc())


def orphan_summary(t: Tables) -> DataFrame:
    """All six reference checks side by side in one row."""
    parts = {
        "orphan_posts_by_user": missing_user_refs(t),
        "orphan_posts_by_subreddit": missing_subreddit_refs(t),
        "orphan_postlinks": invalid_post_links(t),
        "orphan_comments": invalid_comment_links(t),
        "orphan_comment_parents": invalid_parents(t),
        "orphan_moderations": invalid_moderation_subs(t),
    }
    one_row = t["subreddit"].sparkSession.range(1)
    return one_row.select(*[df.scalar().alias(name) for name, df in parts.items()])
