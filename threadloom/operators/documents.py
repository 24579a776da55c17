"""Flat comments to five document collections, and the pieces a merge needs.

Each collection is a reduction (first or last row per key, in the total order of
`ranking`). Reductions can be applied to parts of the data and again to
the union of the results, which is what the incremental loader does; so the
`*_rows` functions keep the ordering columns that a later reduction needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom import schemas
from threadloom.functions.text import DELETED, has_text
from threadloom.functions.values import flag
from threadloom.operators.ranking import (
    RANK,
    bounded_groups,
    first_per_key,
    reverse_row_order,
    row_order,
)

EMBED_CAP = 200
ORDER_COLUMNS = ["created_utc", "name"]


def user_rows(flat: DataFrame) -> DataFrame:
    """Named, not withdrawn authors with their flair; may repeat."""
    return flat.filter(has_text(F.col("author")) & (F.col("author") != DELETED)).select(
        F.col("author").alias("_id"), "author_flair_text", "author_flair_css_class",
        *ORDER_COLUMNS,
    )


def last_users(rows: DataFrame) -> DataFrame:
    return first_per_key(rows, ["_id"], reverse_row_order(schemas.DOCUMENTS["users"].names))


def subreddit_rows(flat: DataFrame) -> DataFrame:
    """Communities with a non-empty id; may repeat."""
    return flat.filter(has_text(F.col("subreddit_id"))).select(
        F.col("subreddit_id").alias("_id"), F.col("subreddit").alias("name_"), *ORDER_COLUMNS
    )


def last_subreddits(rows: DataFrame) -> DataFrame:
    return first_per_key(rows, ["_id"], reverse_row_order(["_id", "name_"]))


def post_rows(flat: DataFrame) -> DataFrame:
    """Post attributes as found on each comment; may repeat."""
    return flat.filter(has_text(F.col("link_id"))).select(
        F.col("link_id").alias("_id"),
        "subreddit_id", "subreddit", "author",
        "created_utc",
        flag(F.col("archived"), flat.schema["archived"].dataType).alias("archived"),
        "gilded",
        flag(F.col("edited"), flat.schema["edited"].dataType).alias("edited"),
        "retrieved_on", "name",
    )


POST_ORDER = [
    "_id", "subreddit_id", "subreddit", "author", "archived", "gilded", "edited", "retrieved_on",
]


def first_posts(rows: DataFrame) -> DataFrame:
    return first_per_key(rows, ["_id"], row_order(POST_ORDER))


def comment_rows(flat: DataFrame) -> DataFrame:
    """Comments with an id and a post id, in document shape; ids may repeat."""
    rows = flat.filter(has_text(F.col("id")) & has_text(F.col("link_id"))).withColumnRenamed(
        "link_id", "post_id"
    )
    columns = [
        flag(F.col(c), flat.schema[c].dataType).alias(c) if c in ("score_hidden", "edited")
        else F.col(c)
        for c in schemas.DOCUMENTS["comments"].names
    ]
    return rows.select(*columns, "name")


def first_comments(rows: DataFrame) -> DataFrame:
    return first_per_key(rows, ["id"], row_order(schemas.DOCUMENTS["comments"].names))


def moderation_rows(flat: DataFrame) -> DataFrame:
    """Comments that were removed for a reason or distinguished; may repeat."""
    acted_on = has_text(F.col("removal_reason")) | has_text(F.col("distinguished"))
    # A missing id is spelled out, so that the key is never NULL.
    spelled = [F.coalesce(c, F.lit("None")) for c in ("id", "subreddit_id")]
    return flat.filter(acted_on).select(
        F.concat_ws("_", *spelled).alias("_id"),
        F.lit("comment").alias("target_type"),
        F.col("id").alias("target_id"),
        "subreddit_id",
        "removal_reason",
        "distinguished",
        F.col("retrieved_on").alias("action_timestamp"),
        *ORDER_COLUMNS,
    )


def last_moderation(rows: DataFrame) -> DataFrame:
    return first_per_key(
        rows, ["_id"], reverse_row_order(schemas.DOCUMENTS["moderation"].names)
    )


def users(flat: DataFrame) -> DataFrame:
    """The user collection: the last row of every author."""
    return shape_users(last_users(user_rows(flat)))


def subreddits(flat: DataFrame) -> DataFrame:
    """The community collection: the last row of every id."""
    return shape_subreddits(last_subreddits(subreddit_rows(flat)))


def comments(flat: DataFrame) -> DataFrame:
    """The comment collection: the first row of every id."""
    return shape_comments(first_comments(comment_rows(flat)))


def moderation(flat: DataFrame) -> DataFrame:
    """The moderation collection: the last row of every comment and community."""
    return shape_moderation(last_moderation(moderation_rows(flat)))


def posts(flat: DataFrame, kept_comments: DataFrame, embed_cap: int = EMBED_CAP) -> DataFrame:
    """The post collection with embedded comments and counters.

    `kept_comments` are the rows of `first_comments`, best read from a stored table.
    """
    return assemble_posts(first_posts(post_rows(flat)), kept_comments, embed_cap)


def comment_owners(flat: DataFrame) -> DataFrame:
    """The id and post of the rows of `first_comments`, from the columns that decide between posts.

    The order of comments begins with these columns, so of the rows of an id the same post wins.
    """
    order = row_order(schemas.DOCUMENTS["comments"].names[:2])
    rows = comment_rows(flat).select("id", "post_id", *ORDER_COLUMNS)
    return first_per_key(rows, ["id"], order).select("id", "post_id")


def post_heads(flat: DataFrame, embed_cap: int = EMBED_CAP) -> DataFrame:
    """The post collection without the embedded comments, which are only counted."""
    counts = comment_counts(comment_owners(flat)).withColumnRenamed("post_id", "_id")
    posts = with_comments(
        first_posts(post_rows(flat)), counts.withColumn("comments", _no_comments()), embed_cap)
    return posts.drop("comments").withColumn(
        "embedded_count", F.least("comment_count", F.lit(max(embed_cap, 0)).cast("long")))


def shape_users(rows: DataFrame) -> DataFrame:
    return rows.select(*schemas.DOCUMENTS["users"].names)


def shape_subreddits(rows: DataFrame) -> DataFrame:
    return rows.select("_id", F.col("name_").alias("name"))


def shape_comments(rows: DataFrame) -> DataFrame:
    return rows.select(*schemas.DOCUMENTS["comments"].names)


def shape_moderation(rows: DataFrame) -> DataFrame:
    return rows.select(*schemas.DOCUMENTS["moderation"].names)


def embedded(kept_comments: DataFrame, embed_cap: int = EMBED_CAP) -> DataFrame:
    """Per post, its first comments as an array of at most `embed_cap` structs."""
    fields = schemas.EMBEDDED_COMMENT.names
    kept = bounded_groups(
        kept_comments.select("post_id", *fields, "name"), ["post_id"], row_order(fields), embed_cap
    )
    # The rank leads the struct, so sorting the array restores the order.
    ranked = kept.groupBy("post_id").agg(
        F.array_sort(F.collect_list(F.struct(RANK, *fields))).alias("ranked")
    )
    comment = lambda c: F.struct(*[c[f].alias(f) for f in fields])
    return ranked.select("post_id", F.transform("ranked", comment).alias("comments"))


def comment_counts(kept_comments: DataFrame) -> DataFrame:
    """Distinct comments per post."""
    return kept_comments.groupBy("post_id").agg(F.count(F.lit(1)).alias("comment_count"))


def assemble_posts(
    first_rows: DataFrame, kept_comments: DataFrame, embed_cap: int = EMBED_CAP
) -> DataFrame:
    """Nest the community, attach counters and embed comments; one row per post."""
    counts = comment_counts(kept_comments).withColumnRenamed("post_id", "_id")
    if embed_cap > 0:
        arrays = embedded(kept_comments, embed_cap).withColumnRenamed("post_id", "_id")
        counts = counts.join(arrays, "_id", "left")
    else:
        counts = counts.withColumn("comments", _no_comments())
    return with_comments(first_rows, counts, embed_cap)


def _no_comments():
    return F.array().cast(schemas.DOCUMENTS["posts"]["comments"].dataType)


def with_comments(first_rows: DataFrame, counted: DataFrame, embed_cap: int) -> DataFrame:
    """Posts with their counters and arrays, as in `counted` (_id, comment_count, comments)."""
    result = first_rows.join(counted, "_id", "left")
    none = F.array().cast(counted.schema["comments"].dataType)
    comments_column = F.slice(F.coalesce("comments", none), 1, embed_cap)
    return result.select(
        "_id",
        F.struct(F.col("subreddit_id").alias("id"), F.col("subreddit").alias("name")).alias(
            "subreddit"
        ),
        "author", "created_utc", "archived", "gilded", "edited", "retrieved_on",
        F.coalesce("comment_count", F.lit(0)).cast("long").alias("comment_count"),
        F.size(comments_column).cast("long").alias("embedded_count"),
        comments_column.alias("comments"),
    )


def collection_counts(collections: dict[str, DataFrame]) -> DataFrame:
    """Rows per collection."""
    result = None
    for name, df in collections.items():
        row = df.agg(F.count(F.lit(1)).alias("documents")).select(
            F.lit(name).alias("collection"), "documents"
        )
        result = row if result is None else result.unionByName(row)
    return result
