"""Keys and references, which Spark tables do not enforce, as filters with a reject output."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom import schemas
from threadloom.session import store_shared


def _local_rules(table: str, df: DataFrame) -> list[tuple[str, Column]]:
    """Constraints on the row itself, for the columns that are present."""
    required = [*schemas.PRIMARY_KEYS[table], *schemas.NOT_NULL.get(table, [])]
    rules = [(f"{c} not null", F.col(c).isNull()) for c in required if c in df.columns]
    for column, allowed in schemas.CHECKS.get(table, []):
        # A check passes when it is unknown, so NULL is accepted.
        outside = ~F.coalesce(F.col(column).isin(allowed), F.lit(True))
        rules.append((f"{column} in list", outside))
    return rules


def rejected(table: str, df: DataFrame, parents: Mapping[str, DataFrame]) -> DataFrame:
    """Rows that break a constraint, with the first one they break in `violated`.

    Constraints on the row itself are judged before references.
    """
    broken = F.coalesce(*[F.when(cond, name) for name, cond in _local_rules(table, df)])
    marked = df.withColumn("violated", broken)
    result = marked.filter(F.col("violated").isNotNull())
    remaining = marked.filter(F.col("violated").isNull())
    for column, parent, key in schemas.FOREIGN_KEYS.get(table, []):
        known = parents[parent].select(F.col(key).alias(column))
        orphans = remaining.filter(F.col(column).isNotNull()).join(known, column, "left_anti")
        result = result.unionByName(
            orphans.withColumn("violated", F.lit(f"{column} references {parent}"))
        )
        remaining = accept_reference(remaining, column, known)
    return result


def accepted(table: str, df: DataFrame, parents: Mapping[str, DataFrame]) -> DataFrame:
    """Rows that satisfy every constraint of the table."""
    for _, broken in _local_rules(table, df):
        df = df.filter(~broken)
    for column, parent, key in schemas.FOREIGN_KEYS.get(table, []):
        df = accept_reference(df, column, parents[parent].select(F.col(key).alias(column)))
    return df


def accept_reference(df: DataFrame, column: str, known: DataFrame) -> DataFrame:
    """Rows whose reference is NULL or known; NULLs stay out of the shuffle."""
    checked = df.filter(F.col(column).isNotNull()).join(known, column, "left_semi")
    return df.filter(F.col(column).isNull()).unionByName(checked.select(*df.columns))


def set_null_on_delete(table: str, df: DataFrame, parents: Mapping[str, DataFrame]) -> DataFrame:
    """References with the set-null rule become NULL when the parent row is gone.

    One join marks the known ones; NULLs stay out of the shuffle.
    """
    for column, parent, key in schemas.FOREIGN_KEYS.get(table, []):
        if column not in schemas.SET_NULL.get(table, []):
            continue
        known = _known(parents[parent], key, column)
        joined = df.filter(F.col(column).isNotNull()).join(known, column, "left")
        cleared = F.when(F.col(KNOWN), F.col(column)).alias(column)
        df = df.filter(F.col(column).isNull()).unionByName(joined.select(
            *[cleared if c == column else F.col(c) for c in df.columns]))
    return df


KNOWN = "_known"
ORPHAN = "_orphan"


def _known(parent: DataFrame, key: str, column: str) -> DataFrame:
    """The keys of a parent, once each, with a marker."""
    return parent.select(F.col(key).alias(column)).distinct().withColumn(KNOWN, F.lit(True))


def reject_counts(candidates: Mapping[str, DataFrame], parents: Mapping[str, DataFrame]) -> DataFrame:
    """Rejected rows per table and constraint; only constraints that were broken appear.

    Each reference is looked up once per value, and the orphans are stored. Rows are then counted per
    combination of broken rule and of those references that have orphans, so a frequent key meets the
    join as a few rows.
    """
    counted = []
    for table, df in candidates.items():
        broken = F.coalesce(*[F.when(cond, name) for name, cond in _local_rules(table, df)])
        violated = []
        for column, parent, key in schemas.FOREIGN_KEYS.get(table, []):
            known = parents[parent].select(F.col(key).alias(column))
            values = df.select(column).filter(F.col(column).isNotNull()).distinct()
            orphans = store_shared(values.join(known, column, "left_anti"))
            if not orphans.isEmpty():
                violated.append((column, orphans.withColumn(ORPHAN, F.lit(True)),
                                 f"{column} references {parent}"))
        groups = df.withColumn("violated", broken).groupBy(
            "violated", *[column for column, _, _ in violated]).agg(F.count(F.lit(1)).alias("n"))
        for column, orphans, name in violated:
            groups = groups.join(orphans, column, "left").withColumn("violated", F.coalesce(
                "violated", F.when(F.col(ORPHAN), name))).drop(ORPHAN)
        counted.append(groups.filter(F.col("violated").isNotNull()).groupBy(
            F.lit(table).alias("table_name"), F.col("violated").alias("constraint_name"),
        ).agg(F.sum("n").alias("rejected")))
    return reduce(DataFrame.unionByName, counted)
