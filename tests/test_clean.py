from threadloom import schemas
from threadloom.operators import clean, dirty, verify


def counters(table, df):
    return {r.counter: r.row_count for r in clean.clean_stats(table, df).collect() if r.row_count}


def test_users(table_frame):
    df = table_frame(
        "users",
        {"author": "a", "author_flair_text": "!!!"}, {"author": "b", "author_flair_text": "*new*"},
        {"author": "c", "author_flair_text": " \u2003"}, {"author": "d", "author_flair_text": ""},
        {"author": "\u00a0\t"}, {"author": None, "author_flair_text": "!"},
    )
    kept = {r.author: r.author_flair_text for r in clean.clean("users", df).collect()}
    assert kept == {"a": None, "b": "*new*", "c": None, "d": ""}
    assert counters("users", df) == {
        "seen": 6, "processed": 6, "kept": 4, "dropped_missing_author": 2,
        "flair_symbols_only_to_null": 2,
    }
    flagged = dirty.symbol_flair({"users": df})
    assert {r.author for r in flagged.collect()} == {"a", "b", None}
    assert dirty.flair_without_user({"users": df}).count() == 1


def test_posts(table_frame):
    df = table_frame(
        "post",
        {"link_id": "1", "subreddit_id": "s", "created_utc": None, "edited": -1},
        {"link_id": "2", "subreddit_id": "s", "created_utc": 1100000000, "edited": 5},
        {"link_id": "3", "subreddit_id": "s", "created_utc": 1800000001},
        {"link_id": "4", "subreddit_id": " \t", "created_utc": 0},
    )
    kept = {r.link_id: r.edited for r in clean.clean("post", df).collect()}
    assert kept == {"1": None, "2": 5}
    assert counters("post", df) == {
        "seen": 4, "processed": 4, "kept": 2, "dropped_missing_subreddit_id": 1,
        "dropped_invalid_created_utc": 1, "edited_negative_to_null": 1,
    }


def comment(i, **values):
    return {"id": i, "link_id": "p", "author": "ann", "body": "x", "created_utc": 1431000000, **values}


def test_comments(table_frame):
    df = table_frame(
        "comment",
        comment("1", score=9, ups=5, downs=2),
        comment("2", score=9, ups=None, downs=2),
        comment("3", author="\u3000", body="[removed]"),
        comment("4", author="", link_id=" "),
        comment("5", body="was [Deleted] later", author=""),
        comment("6", body=" \n"),
        comment("7", created_utc=0, score=9, ups=5, downs=2),
        comment("8", score=3, ups=5, downs=2, created_utc=None),
    )
    kept = {r.id: (r.author, r.score) for r in clean.clean("comment", df).collect()}
    assert kept == {"1": ("ann", 3), "2": ("ann", 9), "5": (None, None), "8": ("ann", 3)}
    assert counters("comment", df) == {
        "seen": 8, "processed": 8, "kept": 4, "dropped_missing_link_id": 1,
        "dropped_missing_body": 1, "dropped_deleted_or_removed": 1,
        "dropped_invalid_created_utc": 1, "author_empty_to_null": 2,
        "score_fixed_from_ups_downs": 1,
    }
    cleaned = {"comment": clean.clean("comment", df), "post": table_frame("post", {"link_id": "q"})}
    assert verify.deleted_bodies(cleaned).first()[0] == 1
    assert verify.bad_times(cleaned).first()[0] == 0
    assert verify.bad_scores(cleaned).first()[0] == 0
    assert verify.orphans(cleaned).first()[0] == 4


def test_wrong_score_is_null_aware(table_frame):
    df = table_frame(
        "comment", {"id": "1", "score": 1, "ups": 2, "downs": 1}, {"id": "2", "ups": 2, "downs": 1},
        {"id": "3", "score": None, "ups": None, "downs": 1}, {"id": "4", "score": 1, "ups": 1})
    assert sorted(r.id for r in dirty.wrong_score({"comment": df}).collect()) == ["2", "4"]


def test_like_wildcard_in_reply_prefix(table_frame):
    df = table_frame("comment", {"id": "a", "parent_id": "t1_a"}, {"id": "b", "parent_id": "t1xa"},
                     {"id": "c", "parent_id": "t1"}, {"id": "d", "parent_id": "t1_zz"})
    assert sorted(r.id for r in dirty.broken_reply({"comment": df}).collect()) == ["a", "b", "d"]
    assert sorted(r.id for r in dirty.broken_reply({"comment": df}, "t1_").collect()) == ["b", "d"]


def test_dirt_that_needs_broken_tables(table_frame):
    tables = {
        "users": table_frame("users", {"author": "ann"}, {"author": "ann"}),
        "post": table_frame("post", {"link_id": "t3_p", "subreddit_id": "z"}, {"link_id": "t3_p"}),
        "comment": table_frame(
            "comment", {"id": "1", "link_id": "gone", "author": "bob", "parent_id": "t3_gone"},
            {"id": "1", "link_id": "t3_p", "author": None, "parent_id": "t3_p"}),
        "subreddit": table_frame("subreddit", {"subreddit_id": "s"}),
    }
    count = {name: run(tables).count() for name, run in dirty.QUERIES.items()}
    assert (count["dirty_3_1"], count["dirty_3_2"], count["dirty_3_3"]) == (1, 2, 1)
    assert (count["dirty_4_1"], count["dirty_4_2"], count["dirty_4_3"]) == (1, 1, 1)
    assert count["dirty_7_2"] == 1


def test_cleaning_twice_changes_nothing(ws, rows_of):
    for table in schemas.CLEANED_TABLES:
        once = ws.cleaned[table]
        assert rows_of(clean.clean(table, once)) == rows_of(once)


def test_cleaning_never_shuffles(ws):
    for table in schemas.CLEANED_TABLES:
        plan = clean.clean(table, ws.relational[table])._jdf.queryExecution().toString()
        assert "Exchange" not in plan


def test_removed_rows_are_the_set_difference(table_frame, rows_of):
    raw = {"users": table_frame("users", {"author": "a"}, {"author": "a"}, {"author": None},
                                {"author": "b", "author_flair_text": "x"})}
    cleaned = {"users": table_frame("users", {"author": "b"}, {"author": None}, {"author": "new"})}
    difference = verify.removed("users", raw, cleaned)
    assert rows_of(difference) == rows_of(raw["users"].subtract(cleaned["users"]))
    assert difference.count() == 2
