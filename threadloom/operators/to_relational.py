"""Document collections back to relational rows.

These are projections; only names taken from posts need a reduction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions.text import DELETED
from threadloom.functions.values import as_int
from threadloom.operators.ranking import dense_row_number, first_per_key, reverse_row_order


def _author(column: str = "author") -> Column:
    return F.nullif(F.col(column), F.lit(DELETED)).alias("author")


def users(collection: DataFrame) -> DataFrame:
    return collection.select(
        F.col("_id").alias("author"), "author_flair_text", "author_flair_css_class"
    )


def subreddit(collection: DataFrame) -> DataFrame:
    return collection.select(F.col("_id").alias("subreddit_id"), F.col("name").alias("subreddit"))


def subreddit_from_posts(posts: DataFrame) -> DataFrame:
    """Communities named inside posts; the name on the latest post wins."""
    found = posts.filter(F.col("subreddit.id").isNotNull()).select(
        F.col("subreddit.id").alias("subreddit_id"),
        F.col("subreddit.name").alias("subreddit"),
        "created_utc",
        "_id",
    )
    order = reverse_row_order(["subreddit"], lead=["created_utc", "_id"])
    return first_per_key(found, ["subreddit_id"], order).select("subreddit_id", "subreddit")


def post(posts: DataFrame) -> DataFrame:
    return posts.select(
        F.col("_id").alias("link_id"),
        F.col("subreddit.id").alias("subreddit_id"),
        _author(),
        "created_utc",
        as_int(F.col("archived")).alias("archived"),
        "gilded",
        as_int(F.col("edited")).cast("long").alias("edited"),
    )


def post_link(posts: DataFrame) -> DataFrame:
    return posts.filter(F.col("retrieved_on").isNotNull()).select(
        F.col("_id").alias("link_id"), F.col("_id").alias("post_id"), "retrieved_on"
    )


def comment(comments: DataFrame) -> DataFrame:
    return comments.select(
        "id", "body", _author(), F.col("post_id").alias("link_id"), "parent_id",
        "created_utc", "retrieved_on", "score", "ups", "downs",
        as_int(F.col("score_hidden")).alias("score_hidden"),
        "gilded", "controversiality",
        as_int(F.col("edited")).cast("long").alias("edited"),
    )


MODERATION_FIELDS = [
    "target_type", "target_id", "subreddit_id", "removal_reason", "distinguished",
    "action_timestamp",
]


def moderation_rows(collection: DataFrame, dedupe: bool = False) -> DataFrame:
    """The six copied fields; a repeated copy repeats rows unless `dedupe` is set."""
    rows = collection.select(*MODERATION_FIELDS)
    return rows.distinct() if dedupe else rows


def moderation(collection: DataFrame, store, dedupe: bool = False) -> DataFrame:
    """The copied fields with a fresh key 1..n."""
    order = dict.fromkeys(["target_id", "subreddit_id", *MODERATION_FIELDS])
    return dense_row_number(
        moderation_rows(collection, dedupe),
        [F.col(c).asc_nulls_last() for c in order],
        "mod_action_id",
        store,
    )
