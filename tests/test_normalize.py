from pyspark.sql import functions as F

from threadloom.operators import checks, constraints, normalize


def test_first_row_wins_by_time_then_name(flat_frame):
    flat = flat_frame(
        {"id": "b", "author": "ann", "author_flair_text": "late", "created_utc": 20},
        {"id": "c", "author": "ann", "author_flair_text": "early-c", "created_utc": 10},
        {"id": "a", "author": "ann", "author_flair_text": "early-a", "created_utc": 10},
        {"id": "d", "author": None},
        {"id": "e", "author": "ann", "author_flair_text": "untimed", "created_utc": None},
    )
    assert [r.author_flair_text for r in normalize.users(flat).collect()] == ["early-a"]


def test_post_takes_first_comment_with_a_community(flat_frame):
    flat = flat_frame(
        {"subreddit_id": None, "author": "x", "created_utc": 1},
        {"author": "y", "created_utc": 2},
        {"link_id": None},
    )
    assert [(r.link_id, r.author) for r in normalize.post(flat).collect()] == [("t3_p", "y")]


def test_links_and_comments(flat_frame):
    flat = flat_frame(
        {"id": "top"},
        {"id": "reply", "parent_id": "t1_top"},
        {"id": "orphan", "link_id": "t3_q", "parent_id": "t1_top"},
        {"id": "top", "body": "again", "created_utc": 1431000001},
        {"id": None, "name": "t1_x"},
    )
    links = normalize.post_link(flat)
    assert [(r.link_id, r.post_id) for r in links.collect()] == [("t3_p", "t3_p")]
    rows = {r.id: (r.parent_id, r.body) for r in normalize.comment(flat, links).collect()}
    assert rows == {"top": (None, "text"), "reply": ("t1_top", "text")}


def test_target_type(spark):
    df = spark.createDataFrame([("t1_a",), ("t3_a",), ("a",), (None,)], "i string")
    kinds = [r[0] for r in df.select(normalize.target_type(F.col("i"))).collect()]
    assert kinds == ["comment", "post", "comment", "comment"]


def test_moderation_keeps_repeats_and_rejects_nulls(flat_frame, ws):
    flat = flat_frame({"id": "a"}, {"id": "a"}, {"id": "b", "subreddit_id": None}, {"id": None})
    rows = normalize.moderation(flat, ws.store, now=5).orderBy("mod_action_id").collect()
    assert [(r.mod_action_id, r.target_id, r.action_timestamp) for r in rows] == [
        (1, "a", 5), (2, "a", 5)]


def test_defaults(table_frame):
    posts = table_frame("post", {"link_id": "a", "gilded": None}, {"link_id": "b", "gilded": 2})
    assert [r.gilded for r in normalize.with_defaults(posts, "post").collect()] == [0, 2]
    assert [r.gilded for r in normalize.with_defaults(posts.drop("gilded"), "post").collect()] == [0, 0]
    actions = table_frame("moderation", {"target_id": "x"}).drop("action_timestamp")
    assert normalize.with_defaults(actions, "moderation").first().action_timestamp > 1.6e9
    assert normalize.with_defaults(actions, "moderation", now=7).first().action_timestamp == 7


def test_constraints(table_frame):
    parents = {
        "users": table_frame("users", {"author": "ann"}),
        "subreddit": table_frame("subreddit", {"subreddit_id": "s"}),
        "post": table_frame("post", {"link_id": "p"}),
    }
    posts = table_frame(
        "post",
        {"link_id": "1", "subreddit_id": "s", "author": "ann"},
        {"link_id": "2", "subreddit_id": "s", "author": None},
        {"link_id": "3", "subreddit_id": None, "author": "ann"},
        {"link_id": "4", "subreddit_id": "zz", "author": "bob"},
        {"link_id": "5", "subreddit_id": "s", "author": "bob"},
        {"link_id": None, "subreddit_id": None},
    )
    broken = {r.link_id: r.violated for r in constraints.rejected("post", posts, parents).collect()}
    assert broken == {
        "3": "subreddit_id not null", "4": "subreddit_id references subreddit",
        "5": "author references users", None: "link_id not null",
    }
    kept = constraints.accepted("post", posts, parents)
    assert sorted(r.link_id for r in kept.collect()) == ["1", "2"]
    cleared = constraints.set_null_on_delete("post", posts.filter("link_id = '5'"), parents)
    assert [(r.link_id, r.author) for r in cleared.collect()] == [("5", None)]


def test_check_constraint_accepts_null(table_frame):
    rows = table_frame(
        "moderation",
        {"mod_action_id": 1, "target_type": "post", "target_id": "a", "subreddit_id": "s"},
        {"mod_action_id": 2, "target_type": None, "target_id": "a", "subreddit_id": "s"},
        {"mod_action_id": 3, "target_type": "user", "target_id": "a", "subreddit_id": "s"},
    )
    parents = {"subreddit": table_frame("subreddit", {"subreddit_id": "s"})}
    broken = constraints.rejected("moderation", rows, parents).collect()
    assert [(r.mod_action_id, r.violated) for r in broken] == [(3, "target_type in list")]
    assert constraints.accepted("moderation", rows, parents).count() == 2


def test_reference_checks_find_orphans(table_frame):
    tables = {
        "users": table_frame("users", {"author": "ann"}),
        "subreddit": table_frame("subreddit", {"subreddit_id": "s"}),
        "post": table_frame(
            "post", {"link_id": "p", "subreddit_id": "s", "author": "bob"},
            {"link_id": "q", "subreddit_id": None, "author": None},
            {"link_id": "r", "subreddit_id": "z", "author": "bob"}),
        "post_link": table_frame(
            "post_link", {"link_id": "p", "post_id": "p"}, {"link_id": "x", "post_id": "nope"}),
        "comment": table_frame(
            "comment", {"id": "1", "link_id": "p", "parent_id": "t1_2"},
            {"id": "2", "link_id": "gone", "parent_id": None},
            {"id": "3", "link_id": "p", "parent_id": "t1_9"}),
        "moderation": table_frame("moderation", {"mod_action_id": 1, "subreddit_id": "z"}),
    }
    assert checks.orphan_summary(tables).first().asDict() == {
        "orphan_posts_by_user": 2, "orphan_posts_by_subreddit": 2, "orphan_postlinks": 1,
        "orphan_comments": 1, "orphan_comment_parents": 2, "orphan_moderations": 1,
    }
    assert checks.invalid_parents(tables, "t1_").first()[0] == 1


def test_reject_counts_join_only_references_with_orphans(spark, capsys):
    posts = spark.createDataFrame([("p1",), ("p1",), ("p2",)], "link_id string")
    users = spark.createDataFrame([("u",)], "author string")
    rows = [("1", "p1", "u"), ("2", "p9", "v"), ("3", "p2", "v"), ("4", None, "v"), (None, "p9", None),
            ("5", "p2", None)]
    comments = spark.createDataFrame(rows, "id string, link_id string, author string")
    parents = {"post": posts, "users": users}
    got = {tuple(r) for r in constraints.reject_counts({"comment": comments}, parents).collect()}
    assert got == {("comment", "link_id not null", 1), ("comment", "id not null", 1),
                   ("comment", "link_id references post", 1),
                   ("comment", "author references users", 1)}
    clean = comments.filter("id IN ('1', '5')")
    capsys.readouterr()
    constraints.reject_counts({"comment": clean}, parents).explain()
    assert "Join" not in capsys.readouterr().out
