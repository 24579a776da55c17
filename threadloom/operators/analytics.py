"""The six analytical queries over the relational tables.

Time filters compare the raw epoch column with constants so that they reach the
Parquet scan. Comments are counted per post before any join.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.functions.values import epoch, rounded_ratio
from threadloom.operators.ranking import top

Tables = Mapping[str, DataFrame]


def _posted_between(posts: DataFrame, start: str, end: str) -> DataFrame:
    return posts.filter(F.col("created_utc").between(epoch(start), epoch(end)))


def _comment_counts(t: Tables) -> DataFrame:
    return t["comment"].groupBy("link_id").agg(F.count("id").alias("comment_count"))


def latest_posts(
    t: Tables, community: str = "AskReddit", start: str = "2015-05-28T00:00:00",
    end: str = "2015-05-29T00:00:00", k: int = 50,
) -> DataFrame:
    """Latest posts of one community within two inclusive times."""
    communities = t["subreddit"].filter(F.col("subreddit") == community)
    found = _posted_between(t["post"], start, end).join(communities, "subreddit_id").select(
        "link_id", "author", "subreddit", "created_utc"
    )
    return top(found, k, F.col("created_utc").desc(), F.col("link_id").asc())


def busy_posts(
    t: Tables, start: str = "2015-05-25T00:00:00", end: str = "2015-05-29T23:59:59",
    more_than: int = 5, k: int = 10,
) -> DataFrame:
    """Posts of a period with more than a given number of comments, by that number."""
    busy = _comment_counts(t).filter(F.col("comment_count") > more_than)
    found = (
        _posted_between(t["post"], start, end)
        .select("link_id", "subreddit_id")
        .join(busy, "link_id")
        .join(t["subreddit"], "subreddit_id")
        .select("link_id", "subreddit", "comment_count")
    )
    return top(found, k, F.col("comment_count").desc(), F.col("link_id").asc())


def top_authors(t: Tables, k: int = 20) -> DataFrame:
    """Authors with the most posts."""
    counts = (
        t["post"].filter(F.col("author").isNotNull())
        .groupBy("author").agg(F.count("link_id").alias("total_posts"))
    )
    return top(counts, k, F.col("total_posts").desc(), F.col("author").asc())


def gilded_live(
    t: Tables, start: str = "2015-05-27T00:00:00", end: str = "2015-05-27T23:59:59", k: int = 30
) -> DataFrame:
    """Latest posts of a day that are gilded and not archived."""
    found = (
        _posted_between(t["post"], start, end)
        .filter((F.col("gilded") > 0) & (F.col("archived") == 0))
        .join(t["subreddit"], "subreddit_id")
    )
    latest = top(found, k, F.col("created_utc").desc(), F.col("link_id").asc())
    return latest.select("link_id", "author", "subreddit", "gilded", "archived")


TRIGRAMS = "author_trigrams"


def trigram_index(posts: DataFrame) -> DataFrame:
    """Every three characters in a row of every author's name: trigram, author."""
    names = posts.select("author").filter(F.col("author").isNotNull()).distinct()
    grams = F.transform(F.sequence(F.lit(1), F.length("author") - 2),
                        lambda i: F.substr(F.col("author"), i, F.lit(3)))
    return names.filter(F.length("author") >= 3).select(
        F.explode(F.array_distinct(grams)).alias("trigram"), "author")


def authors_containing(index: DataFrame, part: str) -> DataFrame:
    """Authors whose name contains a text of three characters or more, from the index.

    Names that hold all its trigrams are candidates; the text itself decides.
    """
    if len(part) < 3:
        raise ValueError("a text of under three characters has no trigram")
    grams = {part[i:i + 3] for i in range(len(part) - 2)}
    rows = index.filter(F.col("trigram").isin(sorted(grams)))
    return rows.groupBy("author").agg(F.count(F.lit(1)).alias("held")).filter(
        (F.col("held") == len(grams)) & F.col("author").contains(part)).select("author")


def author_like(t: Tables, part: str = "cat", k: int = 20) -> DataFrame:
    """Latest posts by authors whose name contains a text, letter case included.

    Where the tables have a trigram index, it names the authors of a text of three characters or more;
    posts are then looked up by author. Else every post's author is compared.
    """
    posts = t["post"]
    if TRIGRAMS in t and len(part) >= 3:
        posts = posts.join(authors_containing(t[TRIGRAMS], part), "author", "left_semi")
    found = (
        posts.filter(F.col("author").contains(part))
        .join(t["subreddit"], "subreddit_id")
        .select("link_id", "author", "subreddit", "created_utc")
    )
    return top(found, k, F.col("created_utc").desc(), F.col("link_id").asc())


def average_comments(t: Tables, k: int = 10) -> DataFrame:
    """Average comments per post by community name; posts without comments count as 0."""
    per_post = t["post"].select("link_id", "subreddit_id").join(
        _comment_counts(t), "link_id", "left"
    )
    # Summed per community id first, so the name lookup joins one row per community.
    per_id = per_post.groupBy("subreddit_id").agg(
        F.count(F.lit(1)).alias("posts"),
        F.sum(F.coalesce("comment_count", F.lit(0))).alias("comments"),
    )
    averages = (
        per_id.join(t["subreddit"], "subreddit_id")
        .groupBy("subreddit")
        .agg(F.sum("posts").alias("posts"), F.sum("comments").alias("comments"))
        .select(
            "subreddit",
            rounded_ratio(F.col("comments"), F.col("posts")).alias("avg_comments_per_post"),
        )
    )
    return top(averages, k, F.col("avg_comments_per_post").desc(), F.col("subreddit").asc())


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    "q1_latest_posts": latest_posts,
    "q2_busy_posts": busy_posts,
    "q3_top_authors": top_authors,
    "q4_gilded_live": gilded_live,
    "q5_author_like": author_like,
    "q6_avg_comments": average_comments,
}
