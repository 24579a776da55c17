import os

import pytest

from threadloom.operators import documents
from threadloom.session import path_bytes
from threadloom.sinks import tables as sinks
from threadloom.streaming import doc_load


COLLECTIONS = ["users", "subreddits", "posts", "comments", "moderation"]


@pytest.fixture(scope="module")
def loaded(spark, ws):
    return doc_load.collections(spark, ws.streamed_documents())


@pytest.mark.parametrize("name", COLLECTIONS)
def test_stream_equals_batch(ws, loaded, rows_of, name):
    assert rows_of(loaded[name]) == rows_of(ws.collections[name])


@pytest.mark.parametrize("name", COLLECTIONS)
def test_kept_rows_are_those_of_the_reduction(flat_frame, rows_of, name):
    """NULLs in ordering columns, ties and repeated rows."""
    rows = [dict(id=f"c{i % 4}", name=None if i % 3 == 0 else f"n{i % 5}", author=f"a{i % 2}",
                 created_utc=None if i % 7 == 0 else 1431000000 + i % 3, link_id=f"t3_{i % 3}",
                 subreddit=None if i % 5 == 0 else f"s{i % 4}", body=None if i % 2 else f"b{i}",
                 distinguished=None if i % 4 == 0 else "moderator", score=i % 6 or None)
            for i in range(120)]
    kept = doc_load.KEPT[name]
    found = kept.found(flat_frame(*rows, *rows[:9]))
    assert rows_of(doc_load.kept_rows(found, kept)) == rows_of(kept.reduced(found))


def test_repeated_batch_changes_nothing(spark, ws, rows_of):
    writer = doc_load.Writer(ws.new_path("replayed"), buckets=4)
    half = ws.flat.filter("created_utc % 2 = 0")
    for rows, batch in ((ws.flat, 1), (half, 0), (ws.flat, 1)):
        for name, kept in doc_load.KEPT.items():
            writer.write(name)(doc_load.kept_rows(kept.found(rows), kept), batch)
    got = doc_load.collections(spark, writer.target)
    for name in ("posts", "users"):
        assert rows_of(got[name]) == rows_of(ws.collections[name])


def files_of(path):
    return {f"{d}/{f}" for d in os.listdir(path) if d.startswith(sinks.BUCKET)
            for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet")}


def test_second_batch_hands_on_and_rewrites_changed_keys_only(
        spark, ws, flat_frame, rows_of, monkeypatch):
    monkeypatch.setattr(sinks, "BUCKET_BYTES", 500)
    source, target, progress = (ws.new_path(n) for n in ("source", "target", "progress"))
    many = [dict(id=f"c{i}", link_id=f"t3_{i % 40}", author=f"a{i}", created_utc=1431000000 + i)
            for i in range(400)]
    handed = {}
    merge = sinks.merge_into

    def watch(spark, path, incoming, key, *args, **kwargs):
        name = path.rsplit("/", 1)[1]
        if name == "post_comments":
            handed[name] = {r[0] for r in incoming.select("_id").collect()}
        return merge(spark, path, incoming, key, *args, **kwargs)

    emitted = {}
    write = doc_load.Writer.write

    def listen(self, name):
        own = write(self, name)

        def both(changed, batch):
            emitted[name] = {r[0] for r in changed.select(doc_load.KEPT[name].key).collect()}
            own(changed, batch)

        return both

    monkeypatch.setattr(sinks, "merge_into", watch)
    monkeypatch.setattr(doc_load.Writer, "write", listen)
    flat_frame(*many).coalesce(1).write.parquet(source)
    doc_load.load_available(spark, source, target, progress)
    assert len(emitted["comments"]) == 400 and len(handed["post_comments"]) == 40
    before = {n: files_of(f"{target}/{n}") for n in ("users", "comments", "by_post", "post_comments")}
    # One new comment, one that was made earlier under another post, one that was seen before.
    second = [dict(id="new", link_id="t3_1", author="a1", created_utc=1431900000),
              dict(id="c5", link_id="t3_7", author="a5", created_utc=1430000000),
              dict(id="c9", link_id="t3_9", author="a9", created_utc=1431000009)]
    flat_frame(*second).coalesce(1).write.mode("append").parquet(source)
    doc_load.load_available(spark, source, target, progress)
    assert emitted["comments"] == {"new", "c5", "c9"} and emitted["users"] == {"a1", "a5", "a9"}
    # Posts that gain a comment, and the one that has lost one.
    assert handed["post_comments"] >= {"t3_1", "t3_7", "t3_5"}
    assert handed["post_comments"] <= {"t3_1", "t3_7", "t3_5", "t3_9"}
    for name, old in before.items():
        assert len(old & files_of(f"{target}/{name}")) > len(old) / 3, name
    flat = flat_frame(*many, *second)
    got = doc_load.collections(spark, target)
    first = documents.first_comments(documents.comment_rows(flat))
    assert rows_of(got["posts"]) == rows_of(documents.posts(flat, first))


def test_second_run_loads_new_files_only(spark, ws, rows_of):
    source, target, progress = (ws.new_path(n) for n in ("source", "target", "progress"))
    early, late = ws.flat.filter("created_utc < 1431734400"), ws.flat.filter("created_utc >= 1431734400")
    for part in (early, late):
        part.write.mode("append").parquet(source)
        doc_load.load_available(spark, source, target, progress)
    got = doc_load.collections(spark, target, embed_cap=2)
    expected = documents.posts(ws.flat, ws.table("doc_comment_rows"), 2)
    assert rows_of(got["posts"]) == rows_of(expected)


def test_loads_with_their_own_progress_share_a_target(spark, ws, rows_of):
    target = ws.new_path("target")
    for i in (2, 0, 1):
        source = ws.new_path("source")
        ws.flat.filter(f"created_utc % 3 = {i}").write.parquet(source)
        doc_load.load_available(spark, source, target, ws.new_path("progress"))
    got = doc_load.collections(spark, target)
    want = documents.first_comments(documents.comment_rows(ws.flat))
    assert rows_of(got["comments"]) == rows_of(documents.shape_comments(want))


def test_empty_source_gives_empty_collections(spark, ws):
    source, target = ws.new_path("source"), ws.new_path("target")
    ws.flat.filter("false").write.parquet(source)
    doc_load.load_available(spark, source, target, ws.new_path("progress"))
    got = doc_load.collections(spark, target)
    assert {name: got[name].collect() for name in COLLECTIONS} == dict.fromkeys(COLLECTIONS, [])
    for name in COLLECTIONS:
        assert got[name].schema.simpleString() == ws.collections[name].schema.simpleString()


def test_batches_by_bytes(spark, ws, rows_of):
    target = ws.new_path("target")
    size = path_bytes(spark, ws.path("flat"))
    doc_load.load_available(spark, ws.path("flat"), target, ws.new_path("progress"),
                            bytes_per_batch=str(size * 2 // 3))
    got = doc_load.collections(spark, target)["users"]
    assert rows_of(got) == rows_of(ws.collections["users"])


def test_counts(spark, ws, loaded):
    assert {r.collection: r.documents for r in loaded.counts().collect()} == {
        n: df.count() for n, df in ws.collections.items()}


def test_closing_a_workspace_removes_its_folder(spark, ws):
    from threadloom.plans.workspace import Workspace

    own = Workspace(spark, lambda: ws.flat.limit(5))
    assert own.flat.count() == 5 and os.path.exists(own.root)
    own.close()
    assert not os.path.exists(own.root)


def test_batches_wait_and_are_merged_once(spark, ws, rows_of, monkeypatch):
    """What is written does not grow with the number of batches."""
    source, target, progress = (ws.new_path(n) for n in ("source", "target", "progress"))
    ws.flat.limit(3000).repartition(12).write.parquet(source)
    merges, merge = [], sinks.merge_into

    def watch(spark, path, *args, **kwargs):
        merges.append(path.rsplit("/", 1)[1])
        return merge(spark, path, *args, **kwargs)

    monkeypatch.setattr(sinks, "merge_into", watch)
    doc_load.load_available(spark, source, target, progress, files_per_batch=3)
    assert sorted(merges) == sorted([*COLLECTIONS, "by_post", "post_comments"])
    kept = documents.first_comments(documents.comment_rows(spark.read.parquet(source)))
    assert rows_of(doc_load.collections(spark, target)["comments"]) == rows_of(
        documents.shape_comments(kept))


def test_merge_that_died_is_repeated_with_its_own_rows(spark, ws, flat_frame, rows_of, monkeypatch):
    """A comment is found under ever earlier posts; the load dies before comments are merged."""
    writer = doc_load.Writer(ws.new_path("died"), buckets=2)
    found = [flat_frame(dict(id="c1", link_id=f"t3_{post}", created_utc=at),
                        dict(id=f"x{post}", link_id=f"t3_{post}", created_utc=at))
             for post, at in (("a", 1431000300), ("b", 1431000200), ("c", 1431000100))]
    merge = sinks.merge_into

    def die(spark, path, *args, **kwargs):
        if path.endswith("/comments"):
            raise RuntimeError("driver lost")
        return merge(spark, path, *args, **kwargs)

    for i, rows in enumerate(found):
        for name, kept in doc_load.KEPT.items():
            writer.write(name)(doc_load.kept_rows(kept.found(rows), kept), i)
        if i == 1:
            monkeypatch.setattr(sinks, "merge_into", die)
            with pytest.raises(RuntimeError):
                writer.settle(spark)
            monkeypatch.setattr(sinks, "merge_into", merge)
        elif i == 0:
            writer.settle(spark)
    flat = found[0].unionByName(found[1]).unionByName(found[2])
    want = documents.posts(flat, documents.first_comments(documents.comment_rows(flat)))
    assert rows_of(doc_load.collections(spark, writer.target)["posts"]) == rows_of(want)


def test_first_load_stores_no_second_copy_of_its_rows(spark, ws, rows_of, monkeypatch):
    """Waiting rows go straight into the tables, and comments by post are made from those."""
    target, stored = ws.new_path("target"), []
    store = doc_load.Writer._stored
    monkeypatch.setattr(
        doc_load.Writer, "_stored", lambda self, df, name: stored.append(name) or store(self, df, name))
    doc_load.load_available(spark, ws.path("flat"), target, ws.new_path("progress"), files_per_batch=3)
    assert stored == ["arrays"]
    assert not any(files for _, _, files in os.walk(f"{target}/merging"))
    got = doc_load.collections(spark, target)
    for name in COLLECTIONS:
        assert rows_of(got[name]) == rows_of(ws.collections[name])


def test_load_that_died_after_its_first_comments_makes_their_arrays(
        spark, ws, flat_frame, rows_of, monkeypatch):
    writer, merge = doc_load.Writer(ws.new_path("died-first"), buckets=2), sinks.merge_into
    rows = flat_frame(*[dict(id=f"c{i}", link_id=f"t3_{i % 3}", created_utc=1431000000 + i)
                        for i in range(9)])
    for name, kept in doc_load.KEPT.items():
        writer.write(name)(doc_load.kept_rows(kept.found(rows), kept), 0)

    def die(spark, path, *args, **kwargs):
        if path.endswith("/by_post"):
            raise RuntimeError("driver lost")
        return merge(spark, path, *args, **kwargs)

    monkeypatch.setattr(sinks, "merge_into", die)
    with pytest.raises(RuntimeError):
        writer.settle(spark)
    assert sinks.bucket_column(spark, writer.path("comments"))
    monkeypatch.setattr(sinks, "merge_into", merge)
    want = documents.posts(rows, documents.first_comments(documents.comment_rows(rows)))
    assert rows_of(doc_load.collections(spark, writer.target)["posts"]) == rows_of(want)


def test_posts_with_some_fields_of_their_comments(loaded, rows_of):
    some = loaded.posts(["id"])
    assert some.schema["comments"].dataType.elementType.names == ["id"]
    whole = loaded["posts"].withColumn("comments", documents.F.transform(
        "comments", lambda c: documents.F.struct(c["id"].alias("id"))))
    assert rows_of(some) == rows_of(whole)
