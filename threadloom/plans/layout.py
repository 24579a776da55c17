"""Query timing on plain and on clustered tables."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from threadloom.operators import docqueries
from threadloom.operators.analytics import QUERIES
from threadloom.sinks import tables as sinks

# The columns the queries filter, join or rank by.
CLUSTERING = {
    "post": ["subreddit_id", "created_utc"],
    "comment": ["link_id", "created_utc"],
    "users": ["author"],
    "moderation": ["subreddit_id", "target_id"],
}

# The same for the document collections.
COLLECTION_CLUSTERING = {
    "posts": ["subreddit.id", "subreddit.name"],
    "comments": ["post_id", "author"],
    "moderation": ["subreddit_id", "target_id"],
    "subreddits": ["name"],
}

# Collections that are filtered by either of two columns, and ids that are looked up.
Z_ORDERING = {"comments": ["post_id", "author"], "moderation": ["subreddit_id", "target_id"]}
LOOKUPS = {"comments": ["id", "author"], "moderation": ["target_id"], "posts": ["_id"],
           "users": ["_id"]}
# Different values of a row group that a Bloom filter is sized for.
LOOKUP_VALUES = 100_000

# Join and group columns of the queries, which are buckets of the tables.
BUCKETING = {"post": "link_id", "comment": "link_id", "post_link": "link_id",
             "subreddit": "subreddit_id"}

# Document queries that filter, group or join by these columns.
COLLECTION_QUERIES = {
    "docq_posts_no_author": docqueries.posts_without_author,
    "docq_posts_per_subreddit": docqueries.posts_per_name,
    "docq_missing_subreddit": docqueries.missing_subreddit,
    "docq_dup_subreddits": docqueries.duplicate_names,
    "docq_top_moderated": docqueries.top_moderated,
    "docq_removals": docqueries.removals,
    "docq_posts_moderated_by_comment":
        lambda c: docqueries.posts_moderated(c, through_comments=True),
}

TIMING_SCHEMA = "query string, row_count long, seconds double"


def write_clustered(
    tables: Mapping[str, DataFrame], root: str,
    clustering: Mapping[str, Sequence[str]] = CLUSTERING,
) -> dict[str, DataFrame]:
    """Copies of the tables in query order, read back with their schema."""
    result = dict(tables)
    for name, columns in clustering.items():
        if name not in tables:
            continue
        sinks.clustered(tables[name], f"{root}/{name}", *columns)
        spark = tables[name].sparkSession
        result[name] = spark.read.schema(tables[name].schema).parquet(f"{root}/{name}")
    return result


def write_z_ordered(
    collections: Mapping[str, DataFrame], root: str, files: int | None = None
) -> dict[str, DataFrame]:
    """Collections along Z-curves with Bloom filters on their ids, read back with their schema.

    Those without a second filter column are clustered by the first.
    """
    result = {}
    for name, df in collections.items():
        path = f"{root}/{name}"
        bloom = dict.fromkeys(LOOKUPS.get(name, []), LOOKUP_VALUES)
        if name in Z_ORDERING:
            sinks.z_ordered(df, path, *Z_ORDERING[name], bloom=bloom, files=files)
        else:
            columns = COLLECTION_CLUSTERING.get(name, ["_id"])
            sinks.clustered(df, path, *columns, bloom=bloom, files=files)
        result[name] = df.sparkSession.read.schema(df.schema).parquet(path)
    return result


def write_bucketed(
    tables: Mapping[str, DataFrame], root: str, buckets: int
) -> dict[str, DataFrame]:
    """Catalog tables in buckets of their join columns; drop them with `drop_tables`."""
    label = f"bucketed_{uuid.uuid4().hex}"
    return {name: sinks.bucketed(df, f"{label}_{name}", f"{root}/{name}", buckets, BUCKETING[name])
            if name in BUCKETING else df for name, df in tables.items()}


def drop_bucketed(spark: SparkSession) -> None:
    """Forget the tables that `write_bucketed` has made in this session's catalog."""
    for table in spark.catalog.listTables():
        if table.name.startswith("bucketed_") and not table.isTemporary:
            spark.sql(f"DROP TABLE {table.name}")


def time_queries(
    spark: SparkSession, tables: Mapping[str, DataFrame],
    queries: Mapping[str, Callable[[Mapping[str, DataFrame]], DataFrame]] = QUERIES,
) -> DataFrame:
    """Rows and wall-clock seconds of each query."""
    measured = []
    for name, query in queries.items():
        start = time.perf_counter()
        # Every query ends in a small top-k or in one row.
        rows = query(tables).collect()
        measured.append((name, len(rows), round(time.perf_counter() - start, 4)))
    return spark.createDataFrame(measured, TIMING_SCHEMA)


def relational(workspace) -> dict[str, DataFrame]:
    """The tables the six queries read."""
    return {name: workspace.relational[name] for name in ("post", "comment", "subreddit")}
