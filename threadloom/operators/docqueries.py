"""Shape and quality queries over the document collections."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.functions.text import is_empty
from threadloom.operators.ranking import top

Collections = Mapping[str, DataFrame]


def _count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(column))


def sample_one(collection: DataFrame) -> DataFrame:
    """The document with the smallest id."""
    return top(collection, 1, F.col("_id").asc())


def null_flair(c: Collections, k: int = 3) -> DataFrame:
    """Up to k users that have neither flair."""
    bare = c["users"].filter(
        is_empty(F.col("author_flair_text")) & is_empty(F.col("author_flair_css_class"))
    )
    return top(bare, k, F.col("_id").asc())


def null_flair_count(c: Collections, k: int = 3) -> DataFrame:
    """How many of those k there are."""
    return _count(null_flair(c, k), "user_count")


def duplicate_names(c: Collections, k: int = 5) -> DataFrame:
    """Community names used more than once."""
    counts = c["subreddits"].groupBy("name").agg(F.count(F.lit(1)).alias("name_count"))
    return top(counts.filter(F.col("name_count") > 1), k, F.col("name").asc_nulls_first())


def post_slice(c: Collections, comments: int = 1) -> DataFrame:
    """One post with only its first comments."""
    return sample_one(c["posts"]).withColumn("comments", F.slice("comments", 1, comments))


def posts_with_comments(c: Collections) -> DataFrame:
    # The size of one leaf, so that no other field of the embedded comments is read.
    return _count(c["posts"].filter(F.size("comments.id") > 0), "post_count")


def average_embedded(c: Collections) -> DataFrame:
    """Average number of embedded comments; a missing array counts as 0."""
    embedded = F.when(F.col("comments.id").isNull(), 0).otherwise(F.size("comments.id"))
    return c["posts"].agg(F.avg(embedded).alias("avg_comments"))


def posts_without_author(c: Collections) -> DataFrame:
    return _count(c["posts"].filter(is_empty(F.col("author"))), "post_count")


def posts_per_name(c: Collections, k: int = 10) -> DataFrame:
    """Community names with the most posts."""
    counts = (
        c["posts"].groupBy(F.col("subreddit.name").alias("name"))
        .agg(F.count(F.lit(1)).alias("post_count"))
    )
    return top(counts, k, F.col("post_count").desc(), F.col("name").asc_nulls_first())


def _unnested(c: Collections, *fields: str) -> DataFrame:
    """Embedded comments as rows with some of their fields; no others are read."""
    leaves = F.arrays_zip(*[F.col(f"comments.{f}").alias(f) for f in fields])
    return c["posts"].select(F.col("_id").alias("post_id"), F.explode(leaves).alias("c")).select(
        "post_id", *[F.col("c").getField(f).alias(f) for f in fields])


def total_embedded(c: Collections) -> DataFrame:
    return _count(_unnested(c, "id"), "total_comments")


def random_comments(c: Collections, k: int = 2, seed: int = 7) -> DataFrame:
    """k random embedded comments."""
    rows = _unnested(c, "id", "author", "body")
    return rows.orderBy(F.rand(seed)).limit(k).select("id", "author", "body")


def random_comments_found(c: Collections, k: int = 2, seed: int = 7) -> DataFrame:
    """How many random comments are drawn, and how many of them are embedded comments."""
    drawn = random_comments(c, k, seed)
    known = _unnested(c, "id").select("id").distinct().withColumn("known", F.lit(1))
    return drawn.join(known, "id", "left").agg(
        F.count(F.lit(1)).alias("drawn"), F.count("known").alias("embedded"))


def controversial(c: Collections, k: int = 3) -> DataFrame:
    """Embedded comments marked as controversial."""
    found = _unnested(c, "id", "controversiality").filter(
        F.col("controversiality") > 0
    )
    return top(found, k, F.col("id").asc())


def removals(c: Collections) -> DataFrame:
    return _count(c["moderation"].filter(F.col("removal_reason").isNotNull()), "action_count")


def top_moderated(c: Collections, k: int = 10) -> DataFrame:
    """Community ids with the most moderation actions."""
    counts = c["moderation"].groupBy("subreddit_id").agg(F.count(F.lit(1)).alias("actions"))
    return top(counts, k, F.col("actions").desc(), F.col("subreddit_id").asc_nulls_first())


def _records_by_post(c: Collections, through_comments: bool) -> DataFrame:
    """Moderation records with the post they belong to in column `_id`.

    Targets are comment ids, so as stored they never equal a post id; going
    through the comment gives the records a reader expects.
    """
    records = c["moderation"].select("target_id", "removal_reason", "distinguished")
    if not through_comments:
        return records.withColumnRenamed("target_id", "_id")
    owners = c["comments"].select(F.col("id").alias("target_id"), F.col("post_id").alias("_id"))
    return records.join(owners, "target_id").drop("target_id")


def posts_moderated_count(c: Collections, through_comments: bool = False) -> DataFrame:
    """Posts that have at least one moderation record."""
    targets = _records_by_post(c, through_comments).select("_id").distinct()
    return _count(c["posts"].select("_id").join(targets, "_id", "left_semi"),
                  "posts_with_moderation")


def posts_moderated(c: Collections, k: int = 3, through_comments: bool = False) -> DataFrame:
    """The first k posts with moderation records, one row per post and record.

    The records stay rows: an array per post would put all records of a heavily
    moderated post into one value.
    """
    records = _records_by_post(c, through_comments)
    posts = c["posts"].select("_id", F.col("subreddit.name").alias("subreddit_name"), "author")
    targets = records.select("_id").distinct()
    chosen = top(posts.join(targets, "_id", "left_semi"), k, F.col("_id").asc())
    # k rows, so the hint is safe.
    return records.join(F.broadcast(chosen), "_id").select(
        "_id", "subreddit_name", "author", "removal_reason", "distinguished"
    )


def missing_subreddit(c: Collections, k: int = 3) -> DataFrame:
    """Up to k posts without a community id."""
    bare = c["posts"].filter(is_empty(F.col("subreddit.id")))
    return top(bare, k, F.col("_id").asc()).select(
        "_id", F.col("subreddit.id").alias("subreddit_id"),
        F.col("subreddit.name").alias("subreddit_name"), "author", "comment_count",
    )


def missing_subreddit_count(c: Collections, k: int = 3) -> DataFrame:
    """How many of those k there are."""
    return _count(missing_subreddit(c, k), "post_count")


def empty_bodies(c: Collections, k: int = 3) -> DataFrame:
    """Embedded comments without text."""
    found = _unnested(c, "id", "author", "body").filter(
        is_empty(F.col("body"))
    )
    return top(found, k, F.col("id").asc())
