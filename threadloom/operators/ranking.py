"""First and last row per key, bounded groups, top-k and dense row numbers.

All of them are built so that one very frequent key cannot pile up in a single
task: a `row_number() <= k` filter lets Spark keep only k rows per key in every
map task before the shuffle, and `bounded_groups` adds a salted stage for the
keys that are frequent enough to matter even then.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A key is heavy when it holds more than this share of all rows, so there are at
# most 1 / HEAVY_SHARE heavy keys whatever the size of the data.
HEAVY_SHARE = 0.001
SALTS = 64
RANK = "_rank"


def row_order(columns: Sequence[str], lead: Sequence[str] = ("created_utc", "name")) -> list[Column]:
    """The total order that defines the first row: time, full name, then all other columns."""
    ordered = list(lead) + [c for c in columns if c not in lead]
    return [F.col(c).asc_nulls_last() for c in ordered]


def reverse_row_order(
    columns: Sequence[str], lead: Sequence[str] = ("created_utc", "name")
) -> list[Column]:
    """The exact reverse of `row_order`; its first row is the last row."""
    ordered = list(lead) + [c for c in columns if c not in lead]
    return [F.col(c).desc_nulls_first() for c in ordered]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of every key under `order`."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(RANK, F.row_number().over(window)).filter(F.col(RANK) == 1).drop(RANK)


def heavy_keys(df: DataFrame, keys: Sequence[str], share: float = HEAVY_SHARE) -> DataFrame:
    """Keys that hold more than `share` of the rows: at most 1 / share rows."""
    total = df.agg(F.count(F.lit(1))).scalar()
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.filter(F.col("_rows") > total * F.lit(share)).select(*keys)


def bounded_groups(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int
) -> DataFrame:
    """Keep the first k rows of every key and number them from 1 in column `_rank`.

    Heavy keys are cut down in salted sub-groups first, so that the final stage
    sees at most SALTS * k rows of any of them.
    """
    keys = list(keys)
    heavy = heavy_keys(df, keys)
    # Bounded by 1 / HEAVY_SHARE rows, so the hint is safe at any scale.
    common = df.join(F.broadcast(heavy), keys, "left_anti")
    frequent = df.join(F.broadcast(heavy), keys, "left_semi").withColumn(
        "_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS))
    )
    within_salt = Window.partitionBy(*keys, "_salt").orderBy(*order)
    frequent = (
        frequent.withColumn(RANK, F.row_number().over(within_salt))
        .filter(F.col(RANK) <= k)
        .drop("_salt", RANK)
    )
    within_key = Window.partitionBy(*keys).orderBy(*order)
    return (
        common.unionByName(frequent)
        .withColumn(RANK, F.row_number().over(within_key))
        .filter(F.col(RANK) <= k)
    )


def top(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first k rows of a total order; Spark runs it as a distributed top-k."""
    return df.orderBy(*order).limit(k)


def dense_row_number(df: DataFrame, order: Sequence[Column], column: str, store) -> DataFrame:
    """Number all rows 1..n in a global order without moving them to one task.

    The rows are range-sorted and stored with the id Spark gives every row of
    a partition (partition number in the upper bits, position in the lower 33).
    The start of each partition is a running total over one row per partition,
    which is the only thing a single task sees. `store(df)` must write the rows
    to reliable storage and return them read back: partition bounds come from a
    sample, so both uses below have to see the same run.
    """
    local = "_local_id"
    arrival = "_arrival"
    # The arrival id ends the sort key so that equal rows can still be split.
    ranged = (
        df.withColumn(arrival, F.monotonically_increasing_id())
        .orderBy(*order, F.col(arrival))
        .drop(arrival)
        .withColumn(local, F.monotonically_increasing_id())
    )
    stored = (
        store(ranged)
        .withColumn("_part", F.shiftright(F.col(local), 33))
        .withColumn("_position", F.col(local) - F.shiftleft(F.shiftright(F.col(local), 33), 33))
    )
    sizes = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    # One row per sort partition, so at most spark.sql.shuffle.partitions rows.
    return stored.join(F.broadcast(starts), "_part").select(
        (F.col("_start") + F.col("_position") + 1).alias(column), *df.columns
    )
