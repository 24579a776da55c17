"""Declared schemas, keys and references of every table and collection."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "boolean": T.BooleanType(),
    "double": T.DoubleType(),
}


def _struct(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


FLAT = _struct(
    id="string", name="string", link_id="string", parent_id="string",
    subreddit_id="string", subreddit="string",
    author="string", author_flair_text="string", author_flair_css_class="string",
    body="string", created_utc="long", retrieved_on="long",
    score="int", ups="int", downs="int", score_hidden="int", gilded="int",
    controversiality="int", edited="long", archived="int",
    distinguished="string", removal_reason="string",
)

# The columns of a chunk of the document loader.
DOCUMENT_COLUMNS = [
    "author", "author_flair_text", "author_flair_css_class", "subreddit_id", "subreddit",
    "link_id", "id", "parent_id", "body", "created_utc", "retrieved_on", "score", "ups",
    "downs", "score_hidden", "gilded", "distinguished", "edited", "controversiality", "archived",
]

# What the loader reads: its moderation rule also tests `removal_reason`, and rows are ordered by
# `name`.
LOADED_COLUMNS = [*DOCUMENT_COLUMNS, "removal_reason", "name"]

RELATIONAL = {
    "users": _struct(
        author="string", author_flair_text="string", author_flair_css_class="string"
    ),
    "subreddit": _struct(subreddit_id="string", subreddit="string"),
    "post": _struct(
        link_id="string", subreddit_id="string", author="string", created_utc="long",
        archived="int", gilded="int", edited="long",
    ),
    "post_link": _struct(link_id="string", post_id="string", retrieved_on="long"),
    "comment": _struct(
        id="string", body="string", author="string", link_id="string", parent_id="string",
        created_utc="long", retrieved_on="long", score="int", ups="int", downs="int",
        score_hidden="int", gilded="int", controversiality="int", edited="long",
    ),
    "moderation": _struct(
        mod_action_id="long", target_type="string", target_id="string", subreddit_id="string",
        removal_reason="string", distinguished="string", action_timestamp="long",
    ),
}

PRIMARY_KEYS = {
    "users": ["author"],
    "subreddit": ["subreddit_id"],
    "post": ["link_id"],
    "post_link": ["link_id"],
    "comment": ["id"],
    "moderation": ["mod_action_id"],
}

NOT_NULL = {
    "post": ["subreddit_id"],
    "post_link": ["post_id"],
    "comment": ["link_id"],
    "moderation": ["target_id", "subreddit_id"],
}

# table -> [(column, parent table, parent key)]; NULL children are allowed.
FOREIGN_KEYS = {
    "post": [("subreddit_id", "subreddit", "subreddit_id"), ("author", "users", "author")],
    "post_link": [("post_id", "post", "link_id")],
    "comment": [("link_id", "post", "link_id"), ("author", "users", "author")],
    "moderation": [("subreddit_id", "subreddit", "subreddit_id")],
}

# References that become NULL, not an error, when the parent row goes away.
SET_NULL = {"post": ["author"], "comment": ["author"]}

CHECKS = {"moderation": [("target_type", ["post", "comment"])]}

CLEANED_TABLES = ["users", "subreddit", "post", "comment", "moderation"]

EMBEDDED_COMMENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("parent_id", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("created_utc", T.LongType()),
    T.StructField("score", T.IntegerType()),
    T.StructField("ups", T.IntegerType()),
    T.StructField("downs", T.IntegerType()),
    T.StructField("score_hidden", T.BooleanType()),
    T.StructField("gilded", T.IntegerType()),
    T.StructField("distinguished", T.StringType()),
    T.StructField("edited", T.BooleanType()),
    T.StructField("controversiality", T.IntegerType()),
])

DOCUMENTS = {
    "users": _struct(
        _id="string", author_flair_text="string", author_flair_css_class="string"
    ),
    "subreddits": _struct(_id="string", name="string"),
    "posts": T.StructType([
        T.StructField("_id", T.StringType()),
        T.StructField("subreddit", _struct(id="string", name="string")),
        T.StructField("author", T.StringType()),
        T.StructField("created_utc", T.LongType()),
        T.StructField("archived", T.BooleanType()),
        T.StructField("gilded", T.IntegerType()),
        T.StructField("edited", T.BooleanType()),
        T.StructField("retrieved_on", T.LongType()),
        T.StructField("comment_count", T.LongType()),
        T.StructField("embedded_count", T.LongType()),
        T.StructField("comments", T.ArrayType(EMBEDDED_COMMENT)),
    ]),
    "comments": _struct(
        id="string", post_id="string", parent_id="string", author="string", body="string",
        created_utc="long", retrieved_on="long", score="int", ups="int", downs="int",
        score_hidden="boolean", gilded="int", distinguished="string", edited="boolean",
        controversiality="int",
    ),
    "moderation": _struct(
        _id="string", target_type="string", target_id="string", subreddit_id="string",
        removal_reason="string", distinguished="string", action_timestamp="long",
    ),
}
