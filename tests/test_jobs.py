import shutil

import pytest
from pyspark.sql import functions as F

from threadloom import schemas
from threadloom.operators import clean, to_relational
from threadloom.plans import jobs
from threadloom.plans.workspace import comment_workspace


@pytest.fixture(scope="module")
def own(spark, ws):
    """A workspace over a stored JSON comment table."""
    path = ws.new_path("own-comments")
    ws.flat.write.json(path, compression="gzip")
    return comment_workspace(spark, path, "json")


def test_load_and_clean(spark, ws, own, rows_of):
    target = ws.new_path("job-relational")
    stats = {r.table_name: (r.rows_read, r.rows_inserted)
             for r in jobs.load_relational(own, target).collect()}
    assert stats["comment"] == (ws.flat.count(), ws.relational["comment"].count())
    counters = jobs.clean_relational(spark, target, target)
    expected = clean.clean_stats("comment", ws.relational["comment"])
    assert rows_of(counters.filter("table_name = 'comment'")) == rows_of(expected)
    for name in ("users", "comment"):
        stored = spark.read.parquet(f"{target}/{name}_cleaned")
        assert rows_of(stored) == rows_of(ws.cleaned[name])
    some = jobs.clean_relational(spark, target, ws.new_path("job-some"), first=50, store=ws.store)
    seen = {r.table_name: r.row_count for r in some.filter("counter = 'seen'").collect()}
    assert seen["comment"] == 50 and seen["subreddit"] <= 50


def test_documents_and_back_twice(spark, ws, own, rows_of):
    source, target = ws.new_path("job-documents"), ws.new_path("job-back")
    sizes = {r.collection: r.documents for r in jobs.load_documents(own, source).collect()}
    assert sizes == {n: df.count() for n, df in ws.collections.items()}
    for run in (1, 2):
        jobs.documents_to_relational(spark, source, target, ws.store)
        back = {n: jobs.read_merged(spark, target, n) for n in schemas.RELATIONAL}
        assert rows_of(back["comment"]) == rows_of(to_relational.comment(ws.collections["comments"]))
        assert back["post_link"].count() == sizes["posts"]
        ids = back["moderation"].agg(F.count_distinct("mod_action_id"), F.max("mod_action_id"))
        assert tuple(ids.first()) == (run * sizes["moderation"],) * 2


def test_sampled_workspace(spark, ws):
    assert comment_workspace(spark, ws.path("flat"), first=100).flat.count() == 100


def test_counters_are_taken_while_tables_are_written(spark, ws, rows_of, monkeypatch):
    """Every source is gone once its copy is written, so a second scan of it would fail."""
    source, target = ws.new_path("once"), ws.new_path("once-cleaned")
    for name in schemas.CLEANED_TABLES:
        ws.relational[name].write.parquet(f"{source}/{name}")

    def write_and_remove(df, path):
        df.write.mode("overwrite").parquet(path)
        name = path.rsplit("/", 1)[1].removesuffix("_cleaned")
        shutil.rmtree(f"{source}/{name}")

    monkeypatch.setattr(jobs.sinks, "recreate", write_and_remove)
    counters = jobs.clean_relational(spark, source, target)
    for name in schemas.CLEANED_TABLES:
        want = clean.clean_stats(name, ws.relational[name])
        assert rows_of(counters.filter(F.col("table_name") == name)) == rows_of(want)
        assert rows_of(spark.read.parquet(f"{target}/{name}_cleaned")) == rows_of(ws.cleaned[name])


def test_rows_observed_twice_are_counted_from_the_files(spark, ws):
    path = ws.new_path("confirmed")
    spark.range(7).write.parquet(path)
    assert [jobs._confirmed(spark, path, n) for n in (7, 14)] == [7, 7]


def test_projections_of_collections_are_not_stored_a_second_time(spark, ws, own, rows_of):
    """Comments with repeated ids and NULL ids are merged as before."""
    source, target, stored = ws.new_path("job-documents"), ws.new_path("job-back"), []
    jobs.load_documents(own, source)
    some = ws.collections["comments"].limit(40)
    later = some.withColumn("body", F.lit("~ later"))
    unknown = some.limit(2).withColumn("id", F.lit(None).cast("string"))
    some.unionByName(later).unionByName(unknown).write.mode("overwrite").parquet(f"{source}/comments")

    def store(df):
        stored.append(df.columns)
        return ws.store(df)

    for run in (1, 2):
        jobs.documents_to_relational(spark, source, target, store)
        back = jobs.read_merged(spark, target, "comment")
        known = back.filter(F.col("id").isNotNull())
        assert known.count() == some.count() == known.select("id").distinct().count()
        assert back.filter(F.col("id").isNull()).count() == run
    assert not any("body" in columns or "gilded" in columns for columns in stored)
