"""Flat comments to six keyed relational tables.

Every table keeps the first row per key in the order of `ranking.row_order`.
The first row is chosen by a per-key limit that also runs before the shuffle,
so an author or post that holds a large share of all comments costs one row per
map task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom import schemas
from threadloom.operators.ranking import dense_row_number, first_per_key, row_order

POST_PREFIX = "t3_"
COMMENT_PREFIX = "t1_"


def _first_rows(flat: DataFrame, key: str, columns: list[str]) -> DataFrame:
    carried = flat.select(*dict.fromkeys(["created_utc", "name", *columns]))
    return first_per_key(carried, [key], row_order(columns)).select(*columns)


def users(flat: DataFrame) -> DataFrame:
    """One row per author, with the flair of the author's first comment."""
    known = flat.filter(F.col("author").isNotNull())
    return _first_rows(known, "author", schemas.RELATIONAL["users"].names)


def subreddit(flat: DataFrame) -> DataFrame:
    """One row per community id, with its first name."""
    known = flat.filter(F.col("subreddit_id").isNotNull())
    return _first_rows(known, "subreddit_id", schemas.RELATIONAL["subreddit"].names)


def post(flat: DataFrame) -> DataFrame:
    """One row per link id, with the attributes of its first comment."""
    known = flat.filter(F.col("link_id").isNotNull() & F.col("subreddit_id").isNotNull())
    return _first_rows(known, "link_id", schemas.RELATIONAL["post"].names)


def post_link(flat: DataFrame) -> DataFrame:
    """Links of top-level comments: the parent is the post; first row per link id."""
    top_level = flat.filter(
        F.col("parent_id").startswith(POST_PREFIX) & F.col("link_id").isNotNull()
    ).withColumnRenamed("parent_id", "post_id")
    return _first_rows(top_level, "link_id", schemas.RELATIONAL["post_link"].names)


def known_links(links: DataFrame, posts: DataFrame) -> DataFrame:
    """Links that have both a post link and a post, as a comment needs."""
    return links.select("link_id").join(posts.select("link_id"), "link_id", "left_semi")


def linked_comments(flat: DataFrame, links: DataFrame) -> DataFrame:
    """Comment rows whose link is known, with post parents set to NULL; ids may still repeat.

    `links` should be a stored table: a dominant link is split over tasks only
    where both sides of the join are freshly shuffled.
    """
    columns = schemas.RELATIONAL["comment"].names
    rows = flat.filter(F.col("id").isNotNull()).select(
        "name",
        *[c for c in columns if c != "parent_id"],
        F.when(F.col("parent_id").startswith(POST_PREFIX), None)
        .otherwise(F.col("parent_id"))
        .alias("parent_id"),
    )
    return rows.join(links.select("link_id"), "link_id", "left_semi")


def comment(flat: DataFrame, links: DataFrame) -> DataFrame:
    """One row per comment id among the comments whose link is known."""
    return _first_rows(
        linked_comments(flat, links), "id", schemas.RELATIONAL["comment"].names
    )


def target_type(target_id: Column) -> Column:
    """Kind of a moderation target by the prefix of its id; a comment when there is none."""
    return (
        F.when(target_id.startswith(COMMENT_PREFIX), "comment")
        .when(target_id.startswith(POST_PREFIX), "post")
        .otherwise("comment")
    )


def moderation_rows(flat: DataFrame, now: int | None = None) -> DataFrame:
    """One moderation row for every comment row, still without its generated key.

    `now` fixes the action time; by default it is the time of the run.
    """
    stamp = F.unix_timestamp() if now is None else F.lit(now)
    return flat.filter(F.col("id").isNotNull() & F.col("subreddit_id").isNotNull()).select(
        target_type(F.col("id")).alias("target_type"),
        F.col("id").alias("target_id"),
        "subreddit_id",
        "removal_reason",
        "distinguished",
        stamp.cast("long").alias("action_timestamp"),
    )


def moderation(flat: DataFrame, store, now: int | None = None) -> DataFrame:
    """Moderation rows with a generated key 1..n in the order of their values."""
    rows = moderation_rows(flat, now)
    order = ["target_id", "subreddit_id", "target_type", "removal_reason", "distinguished"]
    return dense_row_number(
        rows, [F.col(c).asc_nulls_last() for c in order], "mod_action_id", store
    )


def moderation_stats(rows: DataFrame) -> DataFrame:
    """How many moderation rows point at posts, at comments and at neither."""
    kind = F.col("target_type")
    return rows.agg(
        F.count_if(kind == "post").alias("post_count"),
        F.count_if(kind == "comment").alias("comment_count"),
        F.count_if(kind.isNull()).alias("null_count"),
    )


def with_defaults(df: DataFrame, table: str, now: int | None = None) -> DataFrame:
    """Fill the declared defaults: no gilding counts as 0, no action time as now."""
    if table in ("post", "comment"):
        given = F.col("gilded") if "gilded" in df.columns else F.lit(None).cast("int")
        return df.withColumn("gilded", F.coalesce(given, F.lit(0)))
    if table == "moderation":
        stamp = (F.unix_timestamp() if now is None else F.lit(now)).cast("long")
        if "action_timestamp" in df.columns:
            stamp = F.coalesce(F.col("action_timestamp"), stamp)
        return df.withColumn("action_timestamp", stamp)
    return df


def load_stats(
    flat: DataFrame, tables: Mapping[str, DataFrame], inserted: Mapping[str, int] | None = None
) -> DataFrame:
    """Rows read, left after the table's own filter, and inserted, for each table.

    The flat table is read once. With `inserted`, the rows that were counted while the tables were
    written, these are not read again.
    """
    # A comment passes its filter when its link is known, so the filter count is
    # a sum over links of pre-aggregated comment counts.
    top_level = F.col("parent_id").startswith(POST_PREFIX)
    per_link = flat.groupBy("link_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(top_level).alias("top_level"))
    links = tables["post_link"].select("link_id", F.lit(True).alias("known"))
    counted = per_link.join(links, "link_id", "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_read"),
        F.coalesce(F.sum("top_level"), F.lit(0)).alias("top_level"),
        F.coalesce(F.sum(F.when(F.col("known"), F.col("n"))), F.lit(0)).alias("linked"))
    rows = []
    for name in schemas.RELATIONAL:
        stored = (tables[name].agg(F.count(F.lit(1))).scalar() if inserted is None
                  else F.lit(inserted[name]))
        filtered = {"post_link": "top_level", "comment": "linked"}.get(name, "rows_read")
        rows.append(F.struct(
            F.lit(name).alias("table_name"), "rows_read",
            F.col(filtered).alias("rows_filtered"), stored.cast("long").alias("rows_inserted")))
    return counted.select(F.inline(F.array(*rows)))
