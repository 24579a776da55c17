import pytest
from threadloom.operators import docqueries, documents, to_relational


def collect(flat, ws, cap=200):
    kept = ws.store(documents.first_comments(documents.comment_rows(flat)))
    return {r._id: r for r in documents.posts(flat, kept, cap).collect()}


def test_counters_count_distinct_comments(flat_frame, ws):
    flat = flat_frame(
        {"id": "a", "created_utc": 3}, {"id": "b", "created_utc": 1}, {"id": "a", "created_utc": 2},
        {"id": "", "link_id": "t3_empty"}, {"id": "x", "link_id": ""},
    )
    posts = collect(flat, ws)
    assert set(posts) == {"t3_p", "t3_empty"}
    assert (posts["t3_p"].comment_count, posts["t3_p"].embedded_count) == (2, 2)
    assert [c.id for c in posts["t3_p"].comments] == ["b", "a"]
    assert (posts["t3_empty"].comment_count, posts["t3_empty"].comments) == (0, [])


def test_embed_cap_on_a_dominant_post(flat_frame, ws):
    rows = [{"id": f"c{i:04d}", "created_utc": 5000 - i // 2} for i in range(900)]
    rows += [{"id": f"d{i}", "link_id": f"t3_{i}"} for i in range(20)]
    posts = collect(flat_frame(*rows), ws, 200)
    hot = posts["t3_p"]
    expected = sorted((r["created_utc"], f"t1_{r['id']}", r["id"]) for r in rows[:900])[:200]
    assert [c.id for c in hot.comments] == [e[2] for e in expected]
    assert (hot.comment_count, hot.embedded_count) == (900, 200)
    assert collect(flat_frame(*rows), ws, 0)["t3_p"].comments == []


def test_last_row_wins_and_skips_withdrawn_authors(flat_frame):
    flat = flat_frame(
        {"author": "ann", "author_flair_text": "old", "created_utc": 1},
        {"author": "ann", "author_flair_text": None, "created_utc": 2},
        {"author": "[deleted]"}, {"author": ""}, {"author": None},
    )
    assert [(r._id, r.author_flair_text) for r in documents.users(flat).collect()] == [("ann", None)]


def test_moderation_needs_a_reason_or_distinction(flat_frame):
    flat = flat_frame(
        {"id": "a", "removal_reason": "spam", "retrieved_on": 9},
        {"id": "b", "distinguished": ""}, {"id": "c"},
        {"id": None, "name": "n", "subreddit_id": None, "distinguished": "admin"},
    )
    rows = {r._id: r.action_timestamp for r in documents.moderation(flat).collect()}
    assert rows == {"a_t5_s": 9, "None_None": 1433000000}


def test_documents_return_the_same_comments(ws, rows_of):
    """Comments with a link survive the way into documents and back."""
    back = to_relational.comment(ws.collections["comments"])
    from pyspark.sql import functions as F

    kept = documents.first_comments(documents.comment_rows(ws.flat))
    expected = kept.select(
        "id", "body", F.when(F.col("author") != "[deleted]", F.col("author")).alias("author"),
        F.col("post_id").alias("link_id"), "parent_id", "created_utc", "retrieved_on", "score",
        "ups", "downs", F.col("score_hidden").cast("int"), "gilded", "controversiality",
        F.col("edited").cast("int").cast("long"),
    )
    assert rows_of(back) == rows_of(expected)


def test_moderated_posts_through_comments(flat_frame, ws):
    flat = flat_frame(
        {"id": "a", "link_id": "t3_1", "removal_reason": "spam"},
        {"id": "b", "link_id": "t3_1", "distinguished": "admin"}, {"id": "c", "link_id": "t3_2"},
    )
    kept = documents.first_comments(documents.comment_rows(flat))
    collections = {"posts": documents.posts(flat, kept), "comments": documents.shape_comments(kept),
                   "moderation": documents.moderation(flat)}
    assert docqueries.posts_moderated_count(collections).first()[0] == 0
    assert docqueries.posts_moderated_count(collections, True).first()[0] == 1
    assert docqueries.posts_moderated(collections, through_comments=True).count() == 2


def test_missing_values_in_documents(flat_frame, ws):
    flat = flat_frame(
        *[{"id": f"c{i}", "link_id": f"t3_{i}", "subreddit_id": "" if i % 2 else None,
           "author": None if i % 2 else "", "body": ""} for i in range(8)]
    )
    kept = documents.first_comments(documents.comment_rows(flat))
    collections = {"posts": documents.posts(flat, kept)}
    assert docqueries.missing_subreddit(collections).count() == 3
    assert docqueries.missing_subreddit_count(collections).first()[0] == 3
    assert docqueries.posts_without_author(collections).first()[0] == 8
    assert docqueries.empty_bodies(collections).count() == 3


@pytest.mark.parametrize("name, fields", [
    ("docq_posts_with_comments", {"id"}), ("docq_avg_comments", {"id"}),
    ("docq_controversial", {"id", "controversiality"}), ("docq_total_embedded", {"id"}),
    ("docq_empty_bodies", {"id", "author", "body"}),
    ("docq_random_comments", {"id", "author", "body"}),
])
def test_embedded_comments_are_read_pruned(ws, name, fields):
    import re

    from threadloom.plans.registry import QUERIES

    plan = QUERIES[name](ws)._jdf.queryExecution().toString()
    read = re.findall(r"ReadSchema: struct<.*?comments:array<struct<([^>]*)>>", plan)
    assert read and all({f.split(":")[0] for f in r.split(",")} == fields for r in read)


def test_posts_without_arrays_equal_posts(flat_frame, ws, rows_of):
    """Ids under several posts, with ties in time and name, count for the same post either way."""
    flat = flat_frame(
        *[{"id": f"c{i % 7}", "link_id": f"t3_{i % 5}", "name": f"n{i % 2}", "created_utc": i // 20,
           "body": f"b{i}", "subreddit_id": f"t5_{i % 3}"} for i in range(60)],
        {"id": None, "link_id": "t3_none"}, {"id": "z", "link_id": None},
    )
    kept = documents.first_comments(documents.comment_rows(flat))
    for cap in (200, 2, 0):
        want = documents.posts(flat, kept, cap).drop("comments")
        got = documents.post_heads(flat, cap)
        assert got.schema.simpleString() == want.schema.simpleString()
        assert rows_of(got) == rows_of(want)


def test_queries_without_embedded_comments_store_none(spark, ws):
    from threadloom.plans.registry import QUERIES
    from threadloom.plans.workspace import Workspace

    own = Workspace(spark, lambda: ws.flat)
    try:
        for name in ("missing_subreddit", "missing_subreddit_count", "posts_no_author",
                     "posts_per_subreddit"):
            QUERIES[f"docq_{name}"](own).collect()
        assert set(own._paths) == {"flat", "doc_post_heads"}
    finally:
        own.close()
