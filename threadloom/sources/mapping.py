"""Maps the order tables used for testing onto the flat comment table.

Line items become comments, orders become posts and the customer's nation
becomes the community. The statement runs unchanged in Spark SQL and in other
ANSI engines, so expected results can be computed from the same text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threadloom import schemas
from threadloom.session import TASK_BYTES, path_bytes

BASE_TABLES = ["lineitem", "orders", "customer", "nation", "part"]

# Which rows carry which kind of dirt, and the time base.
COMMENTS_SQL = """
WITH l AS (
  SELECT l_orderkey, l_linenumber, l_returnflag, CAST(l_quantity AS BIGINT) AS q,
         p_name, p_brand, l_suppkey, l_partkey, o_orderstatus, c_nationkey, n_name,
         l_orderkey * 31 + l_linenumber * 17 + l_partkey * 13 + l_suppkey * 7 AS h
  FROM {lineitem}
  JOIN {orders} ON l_orderkey = o_orderkey
  JOIN {customer} ON o_custkey = c_custkey
  JOIN {nation} ON c_nationkey = n_nationkey
  JOIN {part} ON l_partkey = p_partkey
), r AS (
  SELECT concat('c', l_orderkey, '_', l_linenumber) AS id,
         concat('t1_c', l_orderkey, '_', l_linenumber) AS name,
         concat('t3_', l_orderkey) AS link_id,
         CASE WHEN l_linenumber = 1 OR h % 3 = 0 THEN concat('t3_', l_orderkey)
              ELSE concat('t1_c', l_orderkey, '_', l_linenumber - 1) END AS parent_id,
         CASE WHEN l_orderkey % 601 = 0 THEN '' ELSE concat('t5_', c_nationkey) END AS subreddit_id,
         CASE WHEN c_nationkey = 0 THEN 'AskReddit' ELSE n_name END AS subreddit,
         CASE WHEN h % 23 = 0 THEN '[deleted]' WHEN h % 211 = 0 THEN '' WHEN h % 223 = 0 THEN NULL
              WHEN l_suppkey % 10 = 3 THEN concat('cat_', l_suppkey, '_', l_partkey % 20)
              ELSE concat('user_', l_suppkey, '_', l_partkey % 20) END AS author,
         CASE WHEN h % 19 = 0 THEN '!!!' WHEN h % 13 = 0 THEN '*new*' WHEN h % 11 = 0 THEN '  '
              WHEN h % 7 = 0 THEN p_brand WHEN h % 5 = 0 THEN '' ELSE NULL END AS author_flair_text,
         CASE WHEN h % 7 = 0 THEN l_returnflag ELSE NULL END AS author_flair_css_class,
         CASE WHEN h % 43 = 0 THEN '[deleted]' WHEN h % 47 = 0 THEN '[removed]'
              WHEN h % 53 = 0 THEN '' WHEN h % 59 = 0 THEN 'was [Deleted] later'
              WHEN h % 67 = 0 THEN '   ' WHEN h % 71 = 0 THEN NULL ELSE p_name END AS body,
         CASE WHEN h % 499 = 0 THEN 0 WHEN h % 503 = 0 THEN 1900000000
              ELSE 1430438400 + (l_orderkey * 7919) % 2592000 + h % 86400 END AS created_utc,
         1433116800 + h % 86400 AS retrieved_on,
         CASE WHEN h % 307 = 0 THEN NULL WHEN h % 61 = 0 THEN q * 2 - 29 - h % 3
              ELSE q * 2 - 30 - h % 3 END AS score,
         CASE WHEN h % 311 = 0 THEN NULL ELSE q * 2 - 30 END AS ups,
         h % 3 AS downs,
         CASE WHEN h % 17 = 0 THEN 1 ELSE 0 END AS score_hidden,
         CASE WHEN h % 31 = 0 THEN 1 ELSE 0 END AS gilded,
         CASE WHEN h % 29 = 0 THEN 1 ELSE 0 END AS controversiality,
         CASE WHEN h % 409 = 0 THEN -1 WHEN h % 41 = 0 THEN 1431000000 + h % 1000 ELSE 0 END AS edited,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS archived,
         CASE WHEN h % 37 = 0 THEN 'moderator' ELSE NULL END AS distinguished,
         CASE WHEN h % 401 = 0 THEN 'spam' ELSE NULL END AS removal_reason
  FROM l
)
SELECT * FROM r
"""

# The same joins in the order that Spark runs them: the attributes of posts meet each other before the
# line items, which are shuffled by order last. So the comments of a post lie together in the stored
# table, where they take less space, and first rows per post are found before the next shuffle.
WRITTEN_JOINS = """  FROM {lineitem}
  JOIN {orders} ON l_orderkey = o_orderkey
  JOIN {customer} ON o_custkey = c_custkey
  JOIN {nation} ON c_nationkey = n_nationkey
  JOIN {part} ON l_partkey = p_partkey
"""
LOCAL_JOINS = """  FROM (SELECT * FROM {lineitem} JOIN {part} ON l_partkey = p_partkey)
  JOIN (SELECT * FROM {orders}
        JOIN {customer} ON o_custkey = c_custkey
        JOIN {nation} ON c_nationkey = n_nationkey) ON l_orderkey = o_orderkey
"""


def spread(df: DataFrame, input_bytes: int) -> DataFrame:
    """Deal out the rows of a small table that has fewer files than the cluster has cores.

    A file may be a single row group, which only one task can read. Tables that
    fill the cores with whole splits are left alone and never shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if input_bytes < cores * TASK_BYTES and len(df.inputFiles()) < cores:
        return df.repartition(cores)
    return df


def comments_raw(spark: SparkSession, directory: str) -> DataFrame:
    """The flat comment table of one test-data directory, with its declared types."""
    tables = {t: spark.read.parquet(f"{directory}/{t}.parquet") for t in BASE_TABLES}
    tables["lineitem"] = spread(
        tables["lineitem"], path_bytes(spark, f"{directory}/lineitem.parquet")
    )
    mapped = spark.sql(COMMENTS_SQL.replace(WRITTEN_JOINS, LOCAL_JOINS), **tables)
    return mapped.select([mapped[f.name].cast(f.dataType) for f in schemas.FLAT.fields])
