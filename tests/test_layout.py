import pytest
from pyspark.sql import functions as F

from threadloom.operators import analytics, checks
from threadloom.plans import layout
from threadloom.sinks import tables as sinks


def rows_read(df):
    """Rows that the scan of a query without a shuffle has read."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().get("numOutputRows").get().value()


@pytest.fixture(scope="module")
def comments(spark):
    """40,000 comments of 200 posts and 200 authors; a third is of one post."""
    post = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") * 7919 % 200)
    return spark.range(40_000).select(
        F.format_string("c%07d", F.col("id") * 7919 % 40_000 * 2).alias("id"),
        F.format_string("p%03d", post).alias("post_id"),
        F.format_string("a%03d", F.col("id") * 104_729 % 199).alias("author"))


@pytest.mark.parametrize("values", [[], ["a"], ["a", "b", "b", "b", "c"], list("hgfedcba") * 3])
def test_ranks_count_the_bounds_at_or_below(spark, values):
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v string")
    bounds = sinks.range_bounds(df, "v", 4)
    got = df.select("v", sinks.range_rank("v", bounds, 2).alias("rank")).collect()
    for r in got:
        assert r["rank"] == sum(b <= r.v for b in bounds if r.v is not None)


def test_z_order_takes_bits_in_turn(spark):
    df = spark.range(64).select((F.col("id") % 8).cast("int").alias("a"),
                                (F.col("id") / 8).cast("int").alias("b"))
    got = df.select("a", "b", sinks.z_order([F.col("a"), F.col("b")], 3).alias("z")).collect()
    for r in got:
        bits = "".join(x + y for x, y in zip(f"{r.a:03b}", f"{r.b:03b}"))
        assert r.z == int(bits, 2)


def test_z_curve_skips_rows_for_either_column(spark, ws, comments, rows_of):
    paths = {name: ws.new_path(name) for name in ("clustered", "z")}
    sinks.clustered(comments, paths["clustered"], "post_id", "author", files=32)
    sinks.z_ordered(comments, paths["z"], "post_id", "author", files=32)
    tables = {name: spark.read.parquet(path) for name, path in paths.items()}
    assert rows_of(tables["z"]) == rows_of(comments)
    total = comments.count()
    for column, value in (("author", "a050"), ("author", "a150"), ("post_id", "p100")):
        wanted = F.col(column) == value
        assert tables["z"].filter(wanted).count() == comments.filter(wanted).count()
        assert rows_read(tables["z"].filter(wanted)) < 0.6 * total
    # Ranges over both columns help the second one in the dominant post alone.
    author = F.col("author") == "a050"
    assert rows_read(tables["z"].filter(author)) < 0.8 * rows_read(tables["clustered"].filter(author))


def test_bloom_filters_skip_row_groups_without_the_id(spark, ws, comments, rows_of):
    paths = {name: ws.new_path(name) for name in ("plain", "bloom")}
    # Dictionaries would name the values of so small a table.
    spark.conf.set("parquet.enable.dictionary", "false")
    try:
        one = comments.coalesce(1).sortWithinPartitions("post_id")
        sinks._write_with_filters(one, paths["plain"], None)
        sinks._write_with_filters(one, paths["bloom"], {"id": 40_000})
    finally:
        spark.conf.unset("parquet.enable.dictionary")
    tables = {name: spark.read.parquet(path) for name, path in paths.items()}
    absent = F.col("id") == "c0000101"  # between ids that are there
    assert rows_read(tables["plain"].filter(absent)) == 40_000
    assert rows_read(tables["bloom"].filter(absent)) == 0
    present = F.col("id") == "c0000102"
    assert tables["bloom"].filter(present).count() == 1
    assert rows_of(tables["bloom"]) == rows_of(comments)


def test_joins_of_bucketed_tables_need_no_shuffle(spark, ws, rows_of):
    names = ("post", "comment", "subreddit", "post_link", "users")
    plain = {n: ws.relational[n] for n in names}
    bucketed = layout.write_bucketed(plain, ws.new_path("bucketed"), 4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        per_post = bucketed["post"].join(analytics._comment_counts(bucketed), "link_id", "left")
        matched = bucketed["comment"].join(
            bucketed["post_link"].select("link_id"), "link_id")
        for df in (per_post, matched):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
        # The check's links meet posts by another column first; comments themselves stay in place.
        for run, moved in ((analytics.busy_posts, 0), (analytics.average_comments, 0),
                           (checks.comment_join, 1)):
            plan = run(bucketed)._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning(link_id") == moved
            assert rows_of(run(bucketed)) == rows_of(run(plain))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        layout.drop_bucketed(spark)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


def test_trigram_index_names_the_same_authors(spark, table_frame, rows_of):
    names = ["cat", "cats", "ca", "acat", "Cat", "c at", "catcat", "tac", None, "", "aaa", "aaaa",
             "éacaté"]
    posts = table_frame("post", *[
        dict(link_id=f"t3_{i}", subreddit_id="t5_s", author=n, created_utc=i)
        for i, n in enumerate(names)])
    tables = {"post": posts, "subreddit": table_frame(
        "subreddit", dict(subreddit_id="t5_s", subreddit="s"))}
    index = analytics.trigram_index(posts)
    for part in ("cat", "catc", "aaaa", "aaa", "éac", "zzz", "ca", "c", ""):
        want = analytics.author_like(tables, part)
        assert rows_of(analytics.author_like({**tables, analytics.TRIGRAMS: index}, part)) == rows_of(
            want)
    assert "aaaa" not in {r.author for r in analytics.authors_containing(index, "aaaaa").collect()}
    with pytest.raises(ValueError):
        analytics.authors_containing(index, "ca")
