"""End-to-end jobs over stored tables: load, convert, clean, report.

Tables lie in one folder each under a target. Tables that are merged into are partitioned by a bucket
of their key (`sinks.tables.read_keyed`); the others are plain Parquet folders.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from threadloom import schemas
from threadloom.operators import clean, dependencies, documents, mining, normalize, to_relational
from threadloom.plans.workspace import Workspace
from threadloom.session import path_bytes, path_exists
from threadloom.sinks import reports, tables as sinks
from threadloom.sources import tables as sources


def load_relational(ws: Workspace, target: str) -> DataFrame:
    """Write the six tables and return rows read, filtered and inserted per table."""
    inserted = {}
    for name in schemas.RELATIONAL:
        written = Observation(f"load {name}")
        sinks.recreate(ws.relational[name].observe(written, F.count(F.lit(1)).alias("n")),
                       f"{target}/{name}")
        inserted[name] = _confirmed(ws.spark, f"{target}/{name}", written.get["n"])
    return normalize.load_stats(ws.flat, ws.relational, inserted)


def _confirmed(spark: SparkSession, path: str, observed: int) -> int:
    """The rows observed while a table was written, if its files hold as many; else their number.

    Spark may observe rows twice if it has to run a stage again. Parquet keeps the number of rows
    in its footers, so no row is read for this.
    """
    held = spark.read.parquet(path).count()
    return observed if held == observed else held


def load_documents(
    ws: Workspace, target: str, embed_cap: int = documents.EMBED_CAP
) -> DataFrame:
    """Write the five collections and return their sizes."""
    collections = dict(ws.collections)
    if embed_cap != documents.EMBED_CAP:
        collections["posts"] = documents.posts(
            ws.flat, ws.table("doc_comment_rows"), embed_cap
        )
    for name, df in collections.items():
        sinks.recreate(df, f"{target}/{name}")
    stored = {n: ws.spark.read.schema(s).parquet(f"{target}/{n}")
              for n, s in schemas.DOCUMENTS.items()}
    return documents.collection_counts(stored)


def documents_to_relational(spark: SparkSession, source: str, target: str, store) -> None:
    """Merge stored collections into keyed relational tables.

    Moderation has no key to merge by: a rerun adds its rows again under new keys.
    """
    read = {n: sources.read_documents(spark, n, f"{source}/{n}") for n in schemas.DOCUMENTS}

    def merge(table: str, rows: DataFrame, update: list[str] | None = None, whole: str | None = None
              ) -> None:
        key = schemas.PRIMARY_KEYS[table]
        order = [F.col(c).asc_nulls_last() for c in rows.columns]
        # Rows that are a whole collection under other names are about as large.
        buckets = sinks.buckets_for(path_bytes(spark, f"{source}/{whole}")) if whole else None
        sinks.merge_into(spark, f"{target}/{table}", rows, key, order, update, buckets=buckets)

    # Projections of stored collections are read again, not stored a second time.
    merge("users", to_relational.users(read["users"]), whole="users")
    merge("subreddit", to_relational.subreddit(read["subreddits"]), whole="subreddits")
    merge("subreddit", store(to_relational.subreddit_from_posts(read["posts"])))
    merge("post", to_relational.post(read["posts"]))
    merge("post_link", to_relational.post_link(read["posts"]), update=["retrieved_on"])
    merge("comment", to_relational.comment(read["comments"]), whole="comments")

    root = f"{target}/moderation"
    fresh = store(to_relational.moderation(read["moderation"], store))
    last = 0
    if path_exists(spark, root):
        last = sources.read_table(spark, "moderation", root).agg(F.max("mod_action_id")).first()[0]
    sinks.append(fresh.withColumn("mod_action_id", F.col("mod_action_id") + F.lit(last or 0)), root)


def read_merged(spark: SparkSession, target: str, table: str) -> DataFrame:
    """A table that `documents_to_relational` has written."""
    if table == "moderation":
        return sources.read_table(spark, table, f"{target}/{table}")
    return sinks.read_keyed(spark, f"{target}/{table}", schemas.RELATIONAL[table])


def clean_relational(
    spark: SparkSession, source: str, target: str, first: int | None = None, store=None
) -> DataFrame:
    """Write the cleaned copies of five tables, or of their first rows, and return all counters."""
    counters = []
    for name in schemas.CLEANED_TABLES:
        rows = sources.read_table(spark, name, f"{source}/{name}")
        if first is not None:
            rows = sources.first_rows(rows, first, store)
        cleaned, observed = clean.clean_observed(name, rows)
        path = f"{target}/{name}_cleaned"
        sinks.recreate(cleaned, path)
        kept = observed.get["kept"]
        # Should a stage have run twice, the counters are taken again.
        counters.append(
            clean.observed_stats(spark, name, observed) if _confirmed(spark, path, kept) == kept
            else clean.clean_stats(name, rows))
    return reduce(DataFrame.unionByName, counters)


def report_dependencies(
    tables: dict[str, DataFrame], path: str, store, first: int | None = None
) -> DataFrame:
    """Discover dependencies in the given tables, or their first rows, and write the report.

    Returns the lines with their place.
    """
    if first is not None:
        tables = {n: sources.first_rows(df, first, store) for n, df in tables.items()}
    found = store(dependencies.discover(tables, schemas.PRIMARY_KEYS))
    examples = reduce(
        DataFrame.unionByName,
        [dependencies.domain_examples(n, df) for n, df in tables.items()],
    )
    facts = dependencies.table_facts(tables, schemas.PRIMARY_KEYS)
    lines = store(reports.fd_report(found, facts, examples))
    reports.write_text(lines, path)
    return lines


def report_rules(
    cleaned: dict[str, DataFrame], path: str, store,
    min_support: float = mining.MIN_SUPPORT, min_confidence: float = mining.MIN_CONFIDENCE,
    first: int | None = None,
) -> DataFrame:
    """Mine rules from cleaned tables, write the report and return the summary.

    With `first`, only the first comments are mined.
    """
    if first is not None:
        cleaned = {**cleaned, "comment": sources.first_rows(cleaned["comment"], first, store)}
    counts = store(mining.transaction_counts(cleaned))
    itemsets = store(mining.frequent_itemsets(counts, min_support, store))
    rules = store(mining.association_rules(itemsets, min_confidence))
    exact = mining.summary(counts, itemsets, rules, digits=None)
    reports.write_text(reports.rule_report(exact, itemsets, rules, store), path)
    return mining.summary(counts, itemsets, rules)
