"""Every runnable query by name: a function of a workspace that returns a DataFrame.

Results hold plain columns only. Arrays are joined with a comma and a space or
shown as rows, so that they can be compared with any SQL engine.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom import schemas
from threadloom.operators import (
    analytics,
    checks,
    clean,
    constraints,
    dependencies,
    dirty,
    docqueries,
    documents,
    mining,
    normalize,
    to_relational,
    verify,
)
from threadloom.functions.values import flag
from threadloom.operators.ranking import first_per_key, reverse_row_order, row_order
from threadloom.plans import jobs, layout, workspace as workspaces
from threadloom.plans.workspace import LOAD_TIME, Workspace
from threadloom.sinks import reports, tables as sinks
from threadloom.sources import tables as sources
from threadloom.streaming import doc_load

Query = Callable[[Workspace], DataFrame]
QUERIES: dict[str, Query] = {}

# Start of the second of two loads, 16 May 2015.
SECOND_LOAD = 1431734400

# Thresholds at which the test tables yield rules.
LOW_SUPPORT = 0.002
LOW_CONFIDENCE = 0.1

# Buckets of the joined tables in the timing of layouts.
JOIN_BUCKETS = 8


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def joined(column: str):
    return F.array_join(column, ", ").alias(column)


# --- sources ---------------------------------------------------------------


@query
def src_flat(ws: Workspace) -> DataFrame:
    columns = ["id", "link_id", "subreddit", "author", "created_utc", "score"]
    return sources.read_flat(ws.spark, ws.path("flat"), columns)


@query
def src_flat_chunks(ws: Workspace) -> DataFrame:
    return sources.read_flat_for_documents(ws.spark, ws.path("flat"))


@query
def src_table_stream(ws: Workspace) -> DataFrame:
    return sources.read_table(ws.spark, "comment", ws.path("comment"))


@query
def src_joined_mining(ws: Workspace) -> DataFrame:
    return mining.mining_input(ws.cleaned)


@query
def src_docs(ws: Workspace) -> DataFrame:
    path = ws.new_path("docs-json")
    ws.collections["posts"].write.json(path, compression="gzip")
    return flat_posts(sources.read_documents(ws.spark, "posts", path, "json"))


@query
def src_json(ws: Workspace) -> DataFrame:
    path = ws.new_path("flat-json")
    ws.flat.write.json(path, compression="gzip")
    return sources.read_json(ws.spark, path)


def _broken_lines(ws: Workspace) -> tuple[DataFrame, DataFrame]:
    """The flat table as JSON lines, some cut short and some with words in place of a score."""
    path = ws.new_path("broken-json")
    turn = F.col("created_utc") % 7
    whole = F.to_json(F.struct(*[F.col(c) for c in ws.flat.columns]))
    wrong = F.to_json(F.struct(*[
        F.lit("7 points").alias(c) if c == "score" else F.col(c) for c in ws.flat.columns]))
    ws.flat.select(
        F.when(turn == 0, F.left(whole, F.length(whole) - 5)).when(turn == 1, wrong)
        .otherwise(whole).alias("value")).write.text(path, compression="gzip")
    return sources.checked_json(ws.spark, path, ws.store)


@query
def src_json_kept(ws: Workspace) -> DataFrame:
    return _broken_lines(ws)[0]


@query
def src_json_rejected(ws: Workspace) -> DataFrame:
    """Rejected lines: the id that each names, and whether it is a whole line."""
    return _broken_lines(ws)[1].select(
        F.regexp_extract("line", '"id":"([^"]*)"', 1).alias("id"),
        F.col("line").endswith("}").alias("is_whole"))


@query
def src_session_catalog(ws: Workspace) -> DataFrame:
    """Facts of all tables that the session's catalog lists, which names none of them."""
    names = {f"session_{name}": df for name, df in {"comments_raw": ws.flat, **ws.relational}.items()}
    for name, df in names.items():
        df.createOrReplaceTempView(name)
    found = {n.removeprefix("session_"): df for n, df in sources.catalog_tables(ws.spark).items()
             if n in names}
    facts = sources.catalog(found, schemas.PRIMARY_KEYS)
    for name in names:
        ws.spark.catalog.dropTempView(name)
    return facts


@query
def src_catalog(ws: Workspace) -> DataFrame:
    """Facts of all tables that are found in a folder, which names none of them."""
    for name in workspaces.SOURCES:
        ws.path(name)
    return sources.catalog(sources.stored_tables(ws.spark, ws.source_root), schemas.PRIMARY_KEYS)


@query
def src_sample(ws: Workspace) -> DataFrame:
    rows = ws.flat.select("id", "link_id", "author", "created_utc", "name", "score", "body")
    order = row_order(rows.columns)
    return sources.sample(rows, 1000, *order, store=ws.store)


# --- sinks -----------------------------------------------------------------


def first_load(ws: Workspace) -> DataFrame:
    return ws.flat.filter(F.col("created_utc") < SECOND_LOAD)


def second_load(ws: Workspace) -> DataFrame:
    return ws.flat.filter(F.col("created_utc") >= SECOND_LOAD)


@query
def sink_insert_ignore(ws: Workspace) -> DataFrame:
    path = ws.new_path("insert-ignore")
    sinks.recreate(normalize.users(first_load(ws)), path)
    incoming = ws.flat.filter(F.col("author").isNotNull()).select(
        "created_utc", "name", *schemas.RELATIONAL["users"].names
    )
    stored = ws.spark.read.schema(schemas.RELATIONAL["users"]).parquet(path)
    fresh = sinks.insert_ignore(stored, incoming, ["author"], row_order(incoming.columns))
    # Stored first: a table cannot grow while a job reads it.
    sinks.append(ws.store(fresh.select(*stored.columns)), path)
    return ws.spark.read.schema(schemas.RELATIONAL["users"]).parquet(path)


@query
def sink_upsert_docs(ws: Workspace) -> DataFrame:
    path = ws.new_path("upsert-docs")
    sinks.write_keyed(documents.users(first_load(ws)), path, ["_id"])
    incoming = documents.user_rows(second_load(ws))
    order = reverse_row_order(schemas.DOCUMENTS["users"].names)
    last = ws.store(first_per_key(incoming, ["_id"], order).select(*schemas.DOCUMENTS["users"].names))
    sinks.merge_into(ws.spark, path, last, ["_id"], [F.col("_id")])
    return sinks.read_keyed(ws.spark, path, schemas.DOCUMENTS["users"])


@query
def sink_upsert_rows(ws: Workspace) -> DataFrame:
    path = ws.new_path("upsert-rows")
    sinks.write_keyed(ws.relational["post_link"], path, ["link_id"])
    incoming = ws.store(to_relational.post_link(ws.collections["posts"]))
    order = [F.col("retrieved_on").desc()]
    sinks.merge_into(ws.spark, path, incoming, ["link_id"], order, update=["retrieved_on"])
    return sinks.read_keyed(ws.spark, path, schemas.RELATIONAL["post_link"])


@query
def sink_upsert_tables(ws: Workspace) -> DataFrame:
    """Rows of the six tables after the stored collections have been merged into them twice."""
    source, target = ws.new_path("upsert-source"), ws.new_path("upsert-target")
    jobs.load_documents(ws, source)
    for _ in range(2):
        jobs.documents_to_relational(ws.spark, source, target, ws.store)
    return reduce(DataFrame.unionByName, [
        jobs.read_merged(ws.spark, target, name).agg(
            F.count(F.lit(1)).alias("total_rows")).select(
            F.lit(name).alias("table_name"), "total_rows")
        for name in schemas.RELATIONAL])


@query
def sink_append(ws: Workspace) -> DataFrame:
    path = ws.new_path("append")
    rows = to_relational.moderation_rows(ws.collections["moderation"])
    for _ in range(2):
        sinks.append(rows, path)
    return ws.spark.read.schema(rows.schema).parquet(path)


@query
def sink_recreate(ws: Workspace) -> DataFrame:
    stored = {}
    for name in schemas.CLEANED_TABLES:
        path = ws.new_path(f"{name}-recreated")
        sinks.recreate(ws.relational[name], path)
        sinks.recreate(ws.cleaned[name], path)
        stored[name] = ws.spark.read.schema(ws.cleaned[name].schema).parquet(path)
    return clean.totals(stored)


@query
def sink_reset(ws: Workspace) -> DataFrame:
    result = []
    for name, schema in schemas.DOCUMENTS.items():
        path = ws.new_path(f"{name}-reset")
        sinks.recreate(ws.collections[name], path)
        before = ws.store(_count(ws.spark.read.schema(schema).parquet(path), "n"))
        sinks.reset(ws.spark, path, schema)
        after = _count(ws.spark.read.schema(schema).parquet(path), "n")
        result.append(before.select(
            F.lit(name).alias("collection"),
            F.col("n").alias("documents_before"),
            after.scalar().alias("documents_after"),
        ))
    return reduce(DataFrame.unionByName, result)


@query
def sink_csv(ws: Workspace) -> DataFrame:
    plain = layout.relational(ws)
    before = layout.time_queries(ws.spark, plain)
    after = layout.time_queries(
        ws.spark, layout.write_clustered(plain, ws.new_path("clustered"))
    )
    path = ws.new_path("timing-csv")
    reports.write_csv(reports.timing_comparison(before, after), path)
    stored = ws.spark.read.csv(
        path, header=True,
        schema="query string, row_count long, time_before double, time_after double, speedup double",
    )
    return stored.select("query", "row_count", F.col("speedup").isNotNull().alias("has_speedup"))


@query
def sink_fd_report(ws: Workspace) -> DataFrame:
    """All lines of the report over all analyzed tables, with their place."""
    lines = jobs.report_dependencies(_analyzed(ws), ws.new_path("report"), ws.store)
    # The number of lines depends on the schema only.
    place = F.row_number().over(Window.orderBy("section", "entry", "line_no"))
    return lines.select(place.alias("position"), "line")


@query
def sink_rule_report(ws: Workspace) -> DataFrame:
    path = ws.new_path("report")
    jobs.report_rules(ws.cleaned, path, ws.store, LOW_SUPPORT, LOW_CONFIDENCE)
    return _report_lines(ws, path)


def _report_lines(ws: Workspace, path: str) -> DataFrame:
    """The lines of a written report with how often each occurs."""
    return ws.spark.read.text(path).groupBy(F.col("value").alias("line")).agg(
        F.count(F.lit(1)).alias("line_count")
    )


# --- normalization -----------------------------------------------------------


@query
def norm_users(ws: Workspace) -> DataFrame:
    return normalize.users(ws.flat)


@query
def norm_subreddit(ws: Workspace) -> DataFrame:
    return normalize.subreddit(ws.flat)


@query
def norm_post(ws: Workspace) -> DataFrame:
    return normalize.post(ws.flat)


@query
def norm_post_link(ws: Workspace) -> DataFrame:
    return normalize.post_link(ws.flat)


@query
def norm_comment(ws: Workspace) -> DataFrame:
    return normalize.comment(ws.flat, ws.table("known_links"))


@query
def norm_moderation(ws: Workspace) -> DataFrame:
    return normalize.moderation(ws.flat, ws.store, LOAD_TIME)


@query
def norm_target_type(ws: Workspace) -> DataFrame:
    ids = ws.flat.select(F.explode(F.array("id", "name", "link_id")).alias("target_id"))
    return ids.groupBy(normalize.target_type(F.col("target_id")).alias("target_type")).agg(
        F.count(F.lit(1)).alias("targets")
    )


@query
def norm_moderation_stats(ws: Workspace) -> DataFrame:
    return normalize.moderation_stats(normalize.moderation_rows(ws.flat, LOAD_TIME))


@query
def norm_constraints(ws: Workspace) -> DataFrame:
    flat = ws.flat
    candidates = {
        name: flat.select(*[c for c in schemas.RELATIONAL[name].names if c in flat.columns])
        for name in ("users", "subreddit", "post", "comment")
    }
    candidates["post_link"] = flat.filter(
        F.col("parent_id").startswith(normalize.POST_PREFIX)
    ).select("link_id", F.col("parent_id").alias("post_id"))
    candidates["moderation"] = normalize.moderation_rows(flat, LOAD_TIME)
    return constraints.reject_counts(candidates, ws.relational)


@query
def norm_defaults(ws: Workspace) -> DataFrame:
    given = normalize.with_defaults(ws.relational["post"], "post").select(
        F.lit("given").alias("source"), "link_id", "gilded"
    )
    absent = normalize.with_defaults(ws.relational["post"].drop("gilded"), "post").select(
        F.lit("absent").alias("source"), "link_id", "gilded"
    )
    return given.unionByName(absent)


@query
def norm_defaults_comment(ws: Workspace) -> DataFrame:
    comments = ws.relational["comment"]
    parts = {"given": comments, "absent": comments.drop("gilded")}
    return reduce(DataFrame.unionByName, [
        normalize.with_defaults(df, "comment").select(F.lit(n).alias("source"), "id", "gilded")
        for n, df in parts.items()])


@query
def norm_defaults_moderation(ws: Workspace) -> DataFrame:
    actions = ws.relational["moderation"]
    some = actions.withColumn("action_timestamp", F.when(
        F.col("mod_action_id") % 2 == 0, F.col("action_timestamp")))
    parts = {"given": some, "absent": actions.drop("action_timestamp")}
    return reduce(DataFrame.unionByName, [
        normalize.with_defaults(df, "moderation", LOAD_TIME).select(
            F.lit(n).alias("source"), "mod_action_id", "action_timestamp")
        for n, df in parts.items()])


@query
def norm_set_null(ws: Workspace) -> DataFrame:
    """Comments and posts after the users of one kind have been deleted."""
    users = ws.relational["users"].filter(~F.col("author").startswith("cat_"))
    parents = {**ws.relational, "users": users}
    keys = {"post": "link_id", "comment": "id"}
    return reduce(DataFrame.unionByName, [
        constraints.set_null_on_delete(t, ws.relational[t], parents).select(
            F.lit(t).alias("table_name"), F.col(key).alias("id"), "author")
        for t, key in keys.items()])


@query
def norm_load_stats(ws: Workspace) -> DataFrame:
    return normalize.load_stats(ws.flat, ws.relational)


# --- documents -----------------------------------------------------------------


def flat_posts(posts: DataFrame) -> DataFrame:
    """Post documents with plain columns; embedded comments as their ids in order."""
    return posts.select(
        "_id",
        F.col("subreddit.id").alias("subreddit_id"),
        F.col("subreddit.name").alias("subreddit_name"),
        "author", "created_utc", "archived", "gilded", "edited", "retrieved_on",
        "comment_count", "embedded_count",
        F.array_join("comments.id", ", ").alias("comment_ids"),
    )


def embedded_rows(posts: DataFrame) -> DataFrame:
    """Embedded comments as rows with their position."""
    return posts.select(
        F.col("_id").alias("post_id"), F.posexplode("comments").alias("position", "c")
    ).select("post_id", "position", "c.*")


@query
def doc_bool(ws: Workspace) -> DataFrame:
    columns = ["score_hidden", "archived", "edited", "gilded", "distinguished"]
    types = ws.flat.schema
    flags = [flag(F.col(c), types[c].dataType).alias(c) for c in columns]
    return ws.flat.select(*flags).groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count"))


@query
def doc_users(ws: Workspace) -> DataFrame:
    return documents.users(ws.flat)


@query
def doc_subreddits(ws: Workspace) -> DataFrame:
    return documents.subreddits(ws.flat)


@query
def doc_posts(ws: Workspace) -> DataFrame:
    return flat_posts(documents.posts(ws.flat, ws.table("doc_comment_rows")))


@query
def doc_comments(ws: Workspace) -> DataFrame:
    return documents.comments(ws.flat)


@query
def doc_embed(ws: Workspace) -> DataFrame:
    return embedded_rows(documents.posts(ws.flat, ws.table("doc_comment_rows")))


@query
def doc_embed_cap_2(ws: Workspace) -> DataFrame:
    return embedded_rows(documents.posts(ws.flat, ws.table("doc_comment_rows"), embed_cap=2))


@query
def doc_embed_off(ws: Workspace) -> DataFrame:
    return flat_posts(documents.posts(ws.flat, ws.table("doc_comment_rows"), embed_cap=0))


@query
def doc_counters(ws: Workspace) -> DataFrame:
    return ws.collections["posts"].select("_id", "comment_count", "embedded_count")


@query
def doc_moderation(ws: Workspace) -> DataFrame:
    return documents.moderation(ws.flat)


@query
def doc_counts(ws: Workspace) -> DataFrame:
    return documents.collection_counts(dict(ws.collections))


@query
def doc_layout(ws: Workspace) -> DataFrame:
    copies = layout.write_clustered(ws.relational, ws.new_path("clustered"))
    return copies["post"].unionByName(
        copies["comment"].select("link_id", "author", "created_utc", "gilded", "edited"),
        allowMissingColumns=True,
    )


def _streamed(ws: Workspace) -> doc_load.Collections:
    return doc_load.collections(ws.spark, ws.streamed_documents())


# Columns by which the rows of all collections are compared.
COMMON_COLUMNS = ["_id", "id", "post_id", "name", "author", "subreddit_id", "created_utc",
                  "comment_ids", "comment_count", "embedded_count", "removal_reason",
                  "distinguished", "action_timestamp", "retrieved_on"]


def _all_collections(collections) -> DataFrame:
    """The documents of all five collections in the columns of one table."""
    shaped = {name: flat_posts(df) if name == "posts" else df for name, df in collections.items()}
    if isinstance(collections, doc_load.Collections):
        shaped["posts"] = flat_posts(collections.posts(["id"]))
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(name).alias("collection"), *[
            (F.col(c) if c in df.columns else F.lit(None)).cast("string").alias(c)
            for c in COMMON_COLUMNS])
        for name, df in shaped.items()])


@query
def stream_doc_load(ws: Workspace) -> DataFrame:
    return flat_posts(_streamed(ws).posts(["id"]))


@query
def stream_doc_counts(ws: Workspace) -> DataFrame:
    return _streamed(ws).counts()


@query
def stream_doc_comments(ws: Workspace) -> DataFrame:
    return _streamed(ws)["comments"]


@query
def stream_doc_compact(ws: Workspace) -> DataFrame:
    """All five collections as the load has kept them up."""
    return _all_collections(_streamed(ws))


@query
def stream_doc_two_sources(ws: Workspace) -> DataFrame:
    """Two sources with a progress folder and state each, loaded into one target."""
    target = ws.new_path("stream-both")
    for part in (second_load(ws), first_load(ws)):
        source = ws.new_path("stream-source")
        part.write.parquet(source)
        doc_load.load_available(ws.spark, source, target, ws.new_path("stream-progress"))
    return _all_collections(doc_load.collections(ws.spark, target))


@query
def stream_doc_empty(ws: Workspace) -> DataFrame:
    """Documents of each collection after a source without rows was loaded."""
    source, target = ws.new_path("stream-none"), ws.new_path("stream-target")
    ws.flat.filter("false").write.parquet(source)
    doc_load.load_available(ws.spark, source, target, ws.new_path("stream-progress"))
    return doc_load.collections(ws.spark, target).counts()


# --- documents to relational ------------------------------------------------------


@query
def rel_users(ws: Workspace) -> DataFrame:
    return to_relational.users(ws.collections["users"])


@query
def rel_subreddit(ws: Workspace) -> DataFrame:
    return to_relational.subreddit(ws.collections["subreddits"])


@query
def rel_subreddit_from_posts(ws: Workspace) -> DataFrame:
    stored = to_relational.subreddit(ws.collections["subreddits"])
    found = to_relational.subreddit_from_posts(ws.collections["posts"])
    return sinks.upsert(stored, found, ["subreddit_id"], [F.col("subreddit").asc_nulls_last()])


@query
def rel_post(ws: Workspace) -> DataFrame:
    return to_relational.post(ws.collections["posts"])


@query
def rel_post_link(ws: Workspace) -> DataFrame:
    return to_relational.post_link(ws.collections["posts"])


@query
def rel_comment(ws: Workspace) -> DataFrame:
    return to_relational.comment(ws.collections["comments"])


@query
def rel_moderation(ws: Workspace) -> DataFrame:
    return to_relational.moderation(ws.collections["moderation"], ws.store)


@query
def rel_moderation_dedupe(ws: Workspace) -> DataFrame:
    twice = ws.collections["moderation"].unionByName(ws.collections["moderation"])
    return to_relational.moderation_rows(twice, dedupe=True)


# --- relational checks --------------------------------------------------------------


def _count(df: DataFrame, column: str) -> DataFrame:
    return checks.row_count(df, column)


def _register_counts() -> None:
    names = {"users": "user_count"}
    for table in schemas.RELATIONAL:
        column = names.get(table, f"{table}_count")
        QUERIES[f"chk_count_{table}"] = (
            lambda ws, table=table, column=column: _count(ws.relational[table], column)
        )


_register_counts()

QUERIES.update({
    f"chk_{name}": lambda ws, run=run: run(ws.relational)
    for name, run in {
        "missing_user_refs": checks.missing_user_refs,
        "missing_subreddit_refs": checks.missing_subreddit_refs,
        "invalid_post_links": checks.invalid_post_links,
        "invalid_comment_links": checks.invalid_comment_links,
        "invalid_parents": checks.invalid_parents,
        "invalid_moderation_subs": checks.invalid_moderation_subs,
        "post_join": checks.post_join,
        "comment_join": checks.comment_join,
        "moderation_join": checks.moderation_join,
        "posts_per_subreddit": checks.posts_per_subreddit,
        "comments_per_post": checks.comments_per_post,
        "orphan_summary": checks.orphan_summary,
    }.items()
})


@query
def chk_invalid_parents_prefixed(ws: Workspace) -> DataFrame:
    return checks.invalid_parents(ws.relational, normalize.COMMENT_PREFIX)


# --- analytical queries ----------------------------------------------------------------

QUERIES.update({
    name: lambda ws, run=run: run(ws.relational) for name, run in analytics.QUERIES.items()
})


@query
def bench_layout(ws: Workspace) -> DataFrame:
    plain = layout.relational(ws)
    tuned = layout.write_clustered(plain, ws.new_path("clustered"))
    before = layout.time_queries(ws.spark, plain)
    after = layout.time_queries(ws.spark, tuned)
    compared = before.select("query", F.col("row_count").alias("rows_before")).join(
        after.select("query", F.col("row_count").alias("rows_after")), "query"
    )
    return compared.select("query", "rows_before", "rows_after")


@query
def bench_layout_joins(ws: Workspace) -> DataFrame:
    """The six queries on plain, clustered and bucketed tables, the last with a trigram index.

    From the stored table of times; its seconds are there as well.
    """
    plain = layout.relational(ws)
    bucketed = layout.write_bucketed(plain, ws.new_path("bucketed"), JOIN_BUCKETS)
    bucketed[analytics.TRIGRAMS] = ws.store(
        analytics.trigram_index(plain["post"]).sort("trigram", "author"))
    layouts = {
        "plain": plain,
        "clustered": layout.write_clustered(plain, ws.new_path("clustered")),
        "bucketed": bucketed,
    }
    times = None
    for name, tables in layouts.items():
        own = layout.time_queries(ws.spark, tables).select(
            "query", F.col("row_count").alias(f"rows_{name}"), F.col("seconds").alias(f"time_{name}"))
        times = own if times is None else times.join(own, "query")
    stored = ws.store(times)
    layout.drop_bucketed(ws.spark)
    return stored.select("query", *[f"rows_{name}" for name in layouts])


@query
def q5_author_like_indexed(ws: Workspace) -> DataFrame:
    """The posts of `q5_author_like`, whose authors a trigram index names."""
    index = ws.store(analytics.trigram_index(ws.relational["post"]).sort("trigram", "author"))
    return analytics.author_like({**ws.relational, analytics.TRIGRAMS: index})


@query
def doc_layout_z_order(ws: Workspace) -> DataFrame:
    """All collections along Z-curves with Bloom filters, row by row."""
    return _all_collections(layout.write_z_ordered(
        dict(ws.collections), ws.new_path("z-ordered")))


@query
def bench_layout_collections(ws: Workspace) -> DataFrame:
    """Document queries on plain and on clustered collections, from the stored timing table."""
    plain = dict(ws.collections)
    copies = layout.write_clustered(
        plain, ws.new_path("clustered-documents"), layout.COLLECTION_CLUSTERING)
    before, after = (
        layout.time_queries(ws.spark, c, layout.COLLECTION_QUERIES) for c in (plain, copies))
    timing = ws.store(
        reports.timing_comparison(before, after).join(
            after.select("query", F.col("row_count").alias("rows_after")), "query"))
    return timing.select("query", F.col("row_count").alias("rows_before"), "rows_after")


@query
def doc_layout_collections(ws: Workspace) -> DataFrame:
    """All collections after clustering, row by row."""
    return _all_collections(layout.write_clustered(
        dict(ws.collections), ws.new_path("layout-documents"), layout.COLLECTION_CLUSTERING))


# --- document queries ---------------------------------------------------------------------


@query
def docq_counts(ws: Workspace) -> DataFrame:
    return documents.collection_counts(dict(ws.collections))


@query
def docq_sample_user(ws: Workspace) -> DataFrame:
    return docqueries.sample_one(ws.collections["users"])


@query
def docq_sample_subreddit(ws: Workspace) -> DataFrame:
    return docqueries.sample_one(ws.collections["subreddits"])


@query
def docq_sample_moderation(ws: Workspace) -> DataFrame:
    return docqueries.sample_one(ws.collections["moderation"])


@query
def docq_post_slice(ws: Workspace) -> DataFrame:
    return flat_posts(docqueries.post_slice(ws.collections))


QUERIES.update({
    f"docq_{name}": lambda ws, run=run: run(ws.collections)
    for name, run in {
        "null_flair": docqueries.null_flair,
        "null_flair_count": docqueries.null_flair_count,
        "dup_subreddits": docqueries.duplicate_names,
        "posts_with_comments": docqueries.posts_with_comments,
        "avg_comments": docqueries.average_embedded,
        "total_embedded": docqueries.total_embedded,
        "random_comments": docqueries.random_comments,
        "random_comments_found": docqueries.random_comments_found,
        "controversial": docqueries.controversial,
        "removals": docqueries.removals,
        "top_moderated": docqueries.top_moderated,
        "posts_moderated_count": docqueries.posts_moderated_count,
        "posts_moderated": docqueries.posts_moderated,
        "empty_bodies": docqueries.empty_bodies,
    }.items()
})

# Queries of posts that look at no embedded comment, over posts without them.
QUERIES.update({
    f"docq_{name}": lambda ws, run=run: run({"posts": ws.table("doc_post_heads")})
    for name, run in {
        "posts_no_author": docqueries.posts_without_author,
        "posts_per_subreddit": docqueries.posts_per_name,
        "missing_subreddit": docqueries.missing_subreddit,
        "missing_subreddit_count": docqueries.missing_subreddit_count,
    }.items()
})


@query
def docq_posts_moderated_count_by_comment(ws: Workspace) -> DataFrame:
    return docqueries.posts_moderated_count(ws.collections, through_comments=True)


@query
def docq_posts_moderated_by_comment(ws: Workspace) -> DataFrame:
    return docqueries.posts_moderated(ws.collections, through_comments=True)


# --- dirty data ------------------------------------------------------------------------------

QUERIES.update({
    name: lambda ws, run=run: run(ws.relational) for name, run in dirty.QUERIES.items()
})


@query
def dirty_7_1_prefixed(ws: Workspace) -> DataFrame:
    return dirty.broken_reply(ws.relational, normalize.COMMENT_PREFIX)


def _register_dirty_twins() -> None:
    """The finders over tables in which they find something: raw rows and converted documents."""

    def raw(ws: Workspace) -> dict[str, DataFrame]:
        repeated = ws.flat.unionByName(first_load(ws))
        return {"comment": repeated, "post": ws.flat, "users": ws.flat}

    def converted(ws: Workspace) -> dict[str, DataFrame]:
        comments = to_relational.comment(ws.collections["comments"])
        return {"comment": comments, "post": ws.cleaned["post"], "users": ws.cleaned["users"]}

    def removed(ws: Workspace) -> dict[str, DataFrame]:
        kept = ws.relational["subreddit"].filter(F.col("subreddit_id") > "t5_2")
        return {"post": ws.relational["post"], "subreddit": kept}

    twins = {"dirty_3_1": converted, "dirty_3_2": removed, "dirty_3_3": converted,
             "dirty_4_1": raw, "dirty_4_2": raw, "dirty_4_3": raw, "dirty_6_1": raw,
             "dirty_7_2": converted}
    for name, tables in twins.items():
        kind = tables.__name__
        columns = {"dirty_6_1": ["id", "author_flair_text", "author_flair_css_class"],
                   "dirty_3_2": ["link_id", "subreddit_id"],
                   "dirty_4_1": ["link_id", "row_count"], "dirty_4_2": ["id", "row_count"],
                   "dirty_4_3": ["author", "row_count"]}.get(
                       name, ["id", "link_id", "parent_id", "author"])
        QUERIES[f"{name}_{kind}"] = lambda ws, n=name, t=tables, c=columns: (
            dirty.QUERIES[n](t(ws)).select(*c))


_register_dirty_twins()


@query
def docq_dup_subreddits_posts(ws: Workspace) -> DataFrame:
    """Names that several communities have, over communities as posts name them."""
    named = ws.collections["posts"].select(
        F.col("subreddit.id").alias("_id"), F.col("subreddit.name").alias("name")).distinct()
    return docqueries.duplicate_names({"subreddits": named})


# --- cleaning -----------------------------------------------------------------------------------


def _register_cleaning() -> None:
    for table in schemas.CLEANED_TABLES:
        QUERIES[f"clean_{table}"] = lambda ws, t=table: clean.clean(t, ws.relational[t])
        QUERIES[f"ver_{table}_removed"] = (
            lambda ws, t=table: verify.removed_count(t, ws.relational, ws.cleaned)
        )
        QUERIES[f"ver_{table}_sample"] = (
            lambda ws, t=table: verify.removed_sample(t, ws.relational, ws.cleaned)
        )


_register_cleaning()


@query
def clean_stats(ws: Workspace) -> DataFrame:
    parts = [clean.clean_stats(t, ws.relational[t]) for t in schemas.CLEANED_TABLES]
    return reduce(DataFrame.unionByName, parts)


@query
def clean_totals(ws: Workspace) -> DataFrame:
    return clean.totals({t: ws.relational[t] for t in schemas.CLEANED_TABLES})


@query
def ver_counts(ws: Workspace) -> DataFrame:
    return verify.counts(ws.relational, ws.cleaned)


QUERIES.update({
    f"ver_{name}": lambda ws, run=run: run(ws.cleaned)
    for name, run in {
        "bad_times": verify.bad_times,
        "deleted_bodies": verify.deleted_bodies,
        "bad_scores": verify.bad_scores,
        "orphans": verify.orphans,
    }.items()
})


# --- functional dependencies -----------------------------------------------------------------------


def _analyzed(ws: Workspace) -> dict[str, DataFrame]:
    return {"comments_raw": ws.flat, **ws.relational}


def _keys(table: str) -> list[str]:
    return schemas.PRIMARY_KEYS.get(table, [])


@query
def fd_check(ws: Workspace) -> DataFrame:
    """Dependencies of several columns on one, and of one column on several."""
    flair = ["author_flair_text", "author_flair_css_class"]
    return dependencies.check(ws.flat, ["author"], flair).unionByName(
        dependencies.check(ws.flat, ["author", "link_id"], ["body", "score"])
    )


@query
def fd_examples(ws: Workspace) -> DataFrame:
    parts = [
        dependencies.examples_each(ws.flat, determinant, dependents)
        for determinant, dependents in dependencies.domain_groups(ws.flat.columns).items()
    ]
    parts.append(dependencies.examples(
        ws.flat, "author", ["author_flair_css_class", "author_flair_text"]
    ))
    found = reduce(DataFrame.unionByName, parts).withColumn(
        "dependent_values", joined("dependent_values")
    )
    return found.distinct()


@query
def fd_primary_key(ws: Workspace) -> DataFrame:
    parts = [dependencies.primary_key(t, ws.relational[t], _keys(t)) for t in ws.relational]
    return reduce(DataFrame.unionByName, parts)


@query
def fd_candidate_keys(ws: Workspace) -> DataFrame:
    parts = [
        dependencies.candidate_keys(t, df, _keys(t)) for t, df in _analyzed(ws).items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def fd_candidate_deps(ws: Workspace) -> DataFrame:
    parts = [
        dependencies.candidate_dependencies(t, df, _keys(t)) for t, df in _analyzed(ws).items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def fd_domain(ws: Workspace) -> DataFrame:
    # Other tables have no row in the result and need not be made for it.
    named = [t for t, s in schemas.RELATIONAL.items() if dependencies.domain_groups(s.names)]
    parts = [dependencies.domain(t, ws.relational[t]) for t in named]
    return reduce(DataFrame.unionByName, parts, dependencies.domain("comments_raw", ws.flat))


@query
def fd_uniqueness(ws: Workspace) -> DataFrame:
    parts = [dependencies.uniqueness(t, df) for t, df in _analyzed(ws).items()]
    return reduce(DataFrame.unionByName, parts)


@query
def fd_summary(ws: Workspace) -> DataFrame:
    tables = _analyzed(ws)
    found = ws.store(dependencies.discover(tables, schemas.PRIMARY_KEYS))
    return dependencies.summary(tables, found)


# --- mining --------------------------------------------------------------------------------------------


def _mined(
    ws: Workspace, min_support: float, min_confidence: float
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Counted transactions, itemsets and rules, the first two stored for reuse."""
    counts = ws.table("transaction_counts")
    itemsets = ws.store(mining.frequent_itemsets(counts, min_support, ws.store))
    return counts, itemsets, mining.association_rules(itemsets, min_confidence)


def _shown_rules(rules: DataFrame) -> DataFrame:
    return rules.withColumns({
        "antecedents": joined("antecedents"), "consequents": joined("consequents")
    })


@query
def mine_input(ws: Workspace) -> DataFrame:
    return mining.mining_input(ws.cleaned)


def _item_totals(ws: Workspace, *items) -> DataFrame:
    rows = mining.mining_input(ws.cleaned).select(F.explode(F.array_compact(F.array(*items))))
    return rows.groupBy(F.col("col").alias("item")).agg(F.count(F.lit(1)).alias("row_count"))


@query
def mine_items_subreddit(ws: Workspace) -> DataFrame:
    return _item_totals(ws, mining.subreddit_item(F.col("subreddit")))


@query
def mine_items_score(ws: Workspace) -> DataFrame:
    return _item_totals(ws, mining.score_item(F.col("score")))


@query
def mine_items_flags(ws: Workspace) -> DataFrame:
    return _item_totals(
        ws,
        mining.gilded_item(F.col("gilded")),
        mining.controversial_item(F.col("controversiality")),
        mining.edited_item(F.col("edited")),
        mining.distinguished_item(F.col("distinguished")),
        mining.archived_item(F.col("archived")),
    )


@query
def mine_transactions(ws: Workspace) -> DataFrame:
    return mining.transactions(mining.mining_input(ws.cleaned)).select(joined("items"))


@query
def mine_transaction_counts(ws: Workspace) -> DataFrame:
    return mining.transaction_counts(ws.cleaned).select(joined("items"), "n")


@query
def mine_encode(ws: Workspace) -> DataFrame:
    return mining.encoding(ws.table("transaction_counts"))


@query
def mine_itemsets(ws: Workspace) -> DataFrame:
    counts = ws.table("transaction_counts")
    return mining.frequent_itemsets(counts, store=ws.store).withColumn("items", joined("items"))


@query
def mine_itemsets_low(ws: Workspace) -> DataFrame:
    counts = ws.table("transaction_counts")
    return mining.frequent_itemsets(counts, LOW_SUPPORT, ws.store).withColumn("items", joined("items"))


@query
def mine_itemsets_any_width(ws: Workspace) -> DataFrame:
    tx = ws.store(mining.transactions(mining.mining_input(ws.cleaned)))
    return mining.frequent_itemsets(mining.count_equal(tx), store=ws.store).withColumn("items", joined("items"))


@query
def mine_rules(ws: Workspace) -> DataFrame:
    rules = _mined(ws, LOW_SUPPORT, LOW_CONFIDENCE)[2]
    return _shown_rules(rules).select("antecedents", "consequents", "support", "confidence")


@query
def mine_rules_default(ws: Workspace) -> DataFrame:
    rules = _mined(ws, mining.MIN_SUPPORT, mining.MIN_CONFIDENCE)[2]
    return _shown_rules(rules).select("antecedents", "consequents", "support", "confidence")


@query
def mine_metrics(ws: Workspace) -> DataFrame:
    return _shown_rules(_mined(ws, LOW_SUPPORT, LOW_CONFIDENCE)[2])


@query
def mine_top_rules(ws: Workspace) -> DataFrame:
    return _shown_rules(mining.top_rules(_mined(ws, LOW_SUPPORT, LOW_CONFIDENCE)[2]))


@query
def mine_top_itemsets(ws: Workspace) -> DataFrame:
    itemsets = _mined(ws, mining.MIN_SUPPORT, mining.MIN_CONFIDENCE)[1]
    return mining.top_itemsets(itemsets).withColumn("items", joined("items"))


@query
def mine_summary(ws: Workspace) -> DataFrame:
    return mining.summary(*_mined(ws, LOW_SUPPORT, LOW_CONFIDENCE))
