"""Functional dependencies: tests, examples, keys and uniqueness.

X -> Y is violated in a group of equal X when Y takes two or more non-NULL
values. Y is taken as a number, a hash if it is none, and its least and greatest
are compared: a hash aggregate that combines before the shuffle, so a group of
any size costs one row per map task. That no two values of Y share a hash is
checked before; if they do, distinct values are counted. Where X seldom repeats,
rows are counted per X first, which needs X alone, and only groups of two or more
rows are looked at further. All answers are exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.session import store_shared

# The dependencies that domain knowledge suggests.
DOMAIN_DEPENDENCIES = [
    ("subreddit_id", "subreddit", "Subreddit ID determines subreddit name"),
    ("id", "subreddit_id", "Comment/Post ID determines subreddit ID"),
    ("link_id", "subreddit_id", "Post link ID determines subreddit ID"),
    ("link_id", "author", "Post link ID determines author"),
    ("id", "author", "Comment/Post ID determines author"),
    ("author", "author_flair_text",
     "Author determines flair text (may fail - authors can have different flairs per subreddit)"),
    ("author", "author_flair_css_class",
     "Author determines flair CSS class (may fail - authors can have different flairs per subreddit)"),
    ("link_id", "created_utc", "Post link ID determines creation timestamp"),
    ("id", "link_id", "Comment ID determines parent post link ID"),
]

REPORTED_UNIQUENESS = 0.9
# Parts by hash that values fall into; one is looked at before all.
SLICES = 64
# Up to this share of rows that repeat a value, repeated values are looked up before other columns.
SELDOM = 0.01


def _present(determinant: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in determinant])


def _groups(df: DataFrame, determinant: Sequence[str]) -> DataFrame:
    """Rows per determinant value, from the determinant's columns alone."""
    return df.groupBy(*determinant).agg(F.count(F.lit(1)).alias("_rows"))


def _seldom_repeats(df: DataFrame, determinant: Sequence[str]) -> bool:
    """Whether few rows repeat a determinant value, judged by one slice of the values.

    It only chooses how groups are tested; either way the answer is exact.
    """
    sliced = df.filter(F.pmod(F.xxhash64(*determinant), F.lit(SLICES)) == 0)
    rows, groups = _groups(sliced, determinant).agg(
        F.coalesce(F.sum("_rows"), F.lit(0)), F.count(F.lit(1))).first()
    return rows - groups <= SELDOM * rows


def _code(df: DataFrame, column: str) -> Column:
    """A number that is equal for equal values; integers stand for themselves."""
    if isinstance(df.schema[column].dataType, T.IntegralType):
        return F.col(column)
    # The hash of a NULL would be a number.
    return F.when(F.col(column).isNotNull(), F.xxhash64(column))


def _told_apart(df: DataFrame, columns: Sequence[str]) -> bool:
    """Whether different values of each column have different codes."""
    hashed = [c for c in columns if not isinstance(df.schema[c].dataType, T.IntegralType)]
    parts = [
        df.select(c).distinct().groupBy(_code(df, c).alias("code")).agg(
            F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("n")
        for c in hashed
    ]
    return not parts or reduce(DataFrame.unionByName, parts).isEmpty()


def _spread(
    df: DataFrame, determinant: Sequence[str], dependents: Sequence[str]
) -> tuple[DataFrame, Column]:
    """Per determinant value, whether each dependent takes more than one; and the number of groups.

    Groups of one row may be missing from the first. Where values seldom repeat, only the determinant
    is shuffled, and the rows of repeated values are looked at after that.
    """
    rows = df.select(*dict.fromkeys([*determinant, *dependents])).filter(_present(determinant))
    total = F.count(F.lit(1))
    if _seldom_repeats(rows, determinant):
        repeated = store_shared(_groups(rows, determinant).filter(F.col("_rows") > 1))
        more = repeated.agg(F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0))).scalar()
        total = rows.agg(F.count(F.lit(1))).scalar() - more
        rows = rows.join(repeated.select(*determinant), list(determinant), "left_semi")
    if _told_apart(rows, dependents):
        codes = rows.select(*determinant, *[
            _code(rows, c).alias(f"code_{i}") for i, c in enumerate(dependents)])
        bad = [F.min(f"code_{i}") < F.max(f"code_{i}") for i in range(len(dependents))]
    else:
        codes, bad = rows, [F.count_distinct(F.col(c)) > 1 for c in dependents]
    spread = codes.groupBy(*determinant).agg(*[
        F.coalesce(b, F.lit(False)).alias(f"bad_{i}") for i, b in enumerate(bad)])
    return spread, total


def check(df: DataFrame, determinant: Sequence[str], dependents: Sequence[str]) -> DataFrame:
    """Whether X determines all of Y together: one row with violations and groups.

    A group counts once however many dependents vary in it. Without any group
    the dependency is reported as not holding.
    """
    spread, total = _spread(df, determinant, dependents)
    any_bad = reduce(lambda a, b: a | b, [F.col(f"bad_{i}") for i in range(len(dependents))])
    counted = spread.agg(F.count_if(any_bad).alias("violations"), total.alias("total_groups"))
    return counted.select(
        F.lit(", ".join(determinant)).alias("determinant"),
        F.lit(", ".join(dependents)).alias("dependent"),
        ((F.col("violations") == 0) & (F.col("total_groups") > 0)).alias("holds"),
        "violations",
        "total_groups",
    )


def check_each(df: DataFrame, determinant: str, dependents: Sequence[str]) -> DataFrame:
    """X -> Y for every Y on its own: one row per dependent, one shuffle for all."""
    spread, total = _spread(df, [determinant], dependents)
    counted = spread.agg(
        total.alias("total_groups"),
        *[F.count_if(F.col(f"bad_{i}")).alias(c) for i, c in enumerate(dependents)],
    )
    return counted.unpivot(
        ["total_groups"], list(dependents), "dependent", "violations"
    ).select(
        F.lit(determinant).alias("determinant"),
        "dependent",
        ((F.col("violations") == 0) & (F.col("total_groups") > 0)).alias("holds"),
        "violations",
        "total_groups",
    )


def examples(
    df: DataFrame, determinant: str, dependents: Sequence[str], groups: int = 3, values: int = 3
) -> DataFrame:
    """The first violated groups of X -> Y with a few of the values they mix.

    As in the check, a group is represented by its first dependent that varies.
    """
    spread, _ = _spread(df, [determinant], dependents)
    first_bad = F.coalesce(*[F.when(F.col(f"bad_{i}"), c) for i, c in enumerate(dependents)])
    chosen = (
        spread.select(determinant, first_bad.alias("dependent_column"))
        .filter(F.col("dependent_column").isNotNull())
        .orderBy(determinant)
        .limit(groups)
    )
    return _mixed_values(df, determinant, dependents, chosen, values)


def examples_each(
    df: DataFrame, determinant: str, dependents: Sequence[str], groups: int = 3, values: int = 3
) -> DataFrame:
    """`examples` of X -> Y for every Y on its own, with one aggregate for all of them."""
    spread, _ = _spread(df, [determinant], dependents)
    varying = F.array_compact(F.array(*[
        F.when(F.col(f"bad_{i}"), c) for i, c in enumerate(dependents)
    ]))
    violated = spread.select(determinant, F.explode(varying).alias("dependent_column"))
    window = Window.partitionBy("dependent_column").orderBy(determinant)
    chosen = (
        violated.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") <= groups)
        .drop("_rank")
    )
    return _mixed_values(df, determinant, dependents, chosen, values)


def _mixed_values(
    df: DataFrame, determinant: str, dependents: Sequence[str], chosen: DataFrame, values: int
) -> DataFrame:
    """The smallest values of the chosen groups, ranked as distinct pairs before they are collected."""
    # A few groups per dependent, so the hint is safe.
    rows = df.select(determinant, *dependents).join(F.broadcast(chosen), determinant)
    numeric = [c for c in dependents if isinstance(df.schema[c].dataType, T.NumericType)]

    def picked(columns: Sequence[str], kind: str) -> Column:
        cases = [F.when(F.col("dependent_column") == c, F.col(c).cast(kind)) for c in columns]
        return F.coalesce(*cases, F.lit(None).cast(kind))

    pairs = rows.select(
        F.col(determinant).cast("string").alias("determinant_value"),
        "dependent_column",
        picked(numeric, "decimal(38,6)").alias("_number"),
        picked(dependents, "string").alias("value"),
    ).filter(F.col("value").isNotNull()).distinct()
    # Numbers rank as numbers, text as text.
    window = Window.partitionBy("determinant_value", "dependent_column").orderBy("_number", "value")
    ranked = pairs.withColumn("_rank", F.row_number().over(window)).filter(
        F.col("_rank") <= values
    )
    collected = ranked.groupBy("determinant_value", "dependent_column").agg(
        F.array_sort(F.collect_list(F.struct("_rank", "value"))).alias("ranked")
    )
    return collected.select(
        F.lit(determinant).alias("determinant"),
        "determinant_value",
        "dependent_column",
        F.transform("ranked", lambda r: r["value"]).alias("dependent_values"),
    )


def domain_groups(columns: Sequence[str]) -> dict[str, list[str]]:
    """Domain dependencies whose columns exist: determinant -> its dependents."""
    groups: dict[str, list[str]] = {}
    for determinant, dependent, _ in DOMAIN_DEPENDENCIES:
        if determinant in columns and dependent in columns:
            groups.setdefault(determinant, []).append(dependent)
    return groups


def _describe(
    table: str, found: DataFrame, kind: str, description: Column | None = None
) -> DataFrame:
    return found.select(
        F.lit(table).alias("table_name"),
        "determinant",
        "dependent",
        F.lit(kind).alias("fd_type"),
        "holds",
        "violations",
        "total_groups",
        (F.lit(None).cast("string") if description is None else description).alias("description"),
    )


def primary_key(table: str, df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The declared key determines all other columns; no row when it does not."""
    others = [c for c in df.columns if c not in key]
    found = check(df, key, others)
    return _describe(table, found.filter("holds"), "Primary Key")


def domain(table: str, df: DataFrame) -> DataFrame:
    """The domain dependencies whose columns the table has, failing ones included."""
    texts = {(x, y): text for x, y, text in DOMAIN_DEPENDENCIES}
    parts = []
    for determinant, dependents in domain_groups(df.columns).items():
        found = check_each(df, determinant, dependents)
        description = F.coalesce(*[
            F.when(F.col("dependent") == y, texts[determinant, y]) for y in dependents
        ])
        parts.append(_describe(table, found, "Domain-Based", description))
    if not parts:
        return _describe(table, _no_dependencies(df), "Domain-Based")
    return reduce(DataFrame.unionByName, parts)


def domain_examples(table: str, df: DataFrame) -> DataFrame:
    """Violations of the domain dependencies that fail in a table."""
    parts = [
        examples_each(df, determinant, dependents)
        for determinant, dependents in domain_groups(df.columns).items()
    ]
    none = df.sparkSession.createDataFrame(
        [], "determinant string, determinant_value string, dependent_column string,"
        " dependent_values array<string>"
    )
    return reduce(DataFrame.unionByName, parts, none).select(
        F.lit(table).alias("table_name"), "*"
    )


def table_facts(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """Columns, row count and declared key of every table that has rows."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"),
            F.lit(", ".join(df.columns)).alias("columns"),
            "row_count",
            F.lit(", ".join(keys[name]) if keys.get(name) else None).cast("string").alias(
                "primary_key"
            ),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts).filter(F.col("row_count") > 0)


def _no_dependencies(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [], "determinant string, dependent string, holds boolean, violations long, total_groups long"
    )


def uniqueness(table: str, df: DataFrame) -> DataFrame:
    """Columns that are unique or more than 90 % unique, with exact counts.

    Every column is an aggregate of its own that reads this column only. Values are combined before
    the shuffle, so a column of few values costs its scan.
    """
    parts = [
        df.agg(
            F.lit(c).alias("column_name"),
            F.count_distinct(F.col(c)).alias("distinct_count"),
            F.count(F.lit(1)).alias("row_count"),
        )
        for c in df.columns
    ]
    if not parts:
        return df.sparkSession.createDataFrame(
            [], "table_name string, column_name string, distinct_count long, row_count long"
        )
    counted = reduce(DataFrame.unionByName, parts)
    return counted.filter(
        F.col("distinct_count") > F.col("row_count") * F.lit(REPORTED_UNIQUENESS)
    ).select(F.lit(table).alias("table_name"), "column_name", "distinct_count", "row_count")


def not_unique(df: DataFrame) -> list[str]:
    """Columns with a missing value, or with a value that is seen twice among 1 / SLICES of all values.

    All rows of a value lie in one slice, so what repeats there proves that a column is not unique. Other
    columns can still repeat a value.
    """
    parts = []
    for c in df.columns:
        sliced = F.when(F.pmod(F.xxhash64(c), F.lit(SLICES)) == 0, F.col(c))
        parts.append(df.select(F.col(c), sliced.alias("_sliced")).agg(
            F.lit(c).alias("column_name"),
            (F.count("_sliced") > F.count_distinct("_sliced")).alias("repeats"),
            (F.count(F.lit(1)) > F.count(c)).alias("misses")))
    found = reduce(DataFrame.unionByName, parts).filter("repeats OR misses")
    return [r.column_name for r in found.collect()]


def candidate_keys(table: str, df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Columns outside the declared key with a distinct, present value in every row.

    Values of a column are counted, and shuffled for it, unless a slice of them shows a repeated one.
    """
    others = df.drop(*key)
    if others.columns:
        others = others.drop(*not_unique(others))
    unique = uniqueness(table, others)
    return unique.filter(F.col("distinct_count") == F.col("row_count"))


def candidate_dependencies(table: str, df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Each candidate key with every other non-key column.

    In a column without repeats every group has one row, so nothing is left to test.
    """
    columns = F.array(*[F.lit(c) for c in df.columns if c not in key])
    dependents = F.array_join(F.array_except(columns, F.array("column_name")), ", ")
    found = candidate_keys(table, df, key).select(
        F.col("column_name").alias("determinant"),
        dependents.alias("dependent"),
        F.lit(True).alias("holds"),
        F.lit(0).cast("long").alias("violations"),
        F.col("row_count").alias("total_groups"),
    ).filter(F.col("dependent") != "")
    return _describe(table, found, "Candidate Key")


def discover(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """All dependencies of all tables: declared key, candidate keys, domain."""
    parts = []
    for name, df in tables.items():
        key = list(keys.get(name, []))
        if key and len(df.columns) > len(key):
            parts.append(primary_key(name, df, key))
        parts.append(candidate_dependencies(name, df, key))
        parts.append(domain(name, df))
    return reduce(DataFrame.unionByName, parts)


def summary(tables: Mapping[str, DataFrame], found: DataFrame) -> DataFrame:
    """Tables analyzed (those with rows) and dependencies listed, failing ones included."""
    one_row = found.agg(F.count(F.lit(1)).alias("total_fds"))
    filled = reduce(
        lambda a, b: a + b,
        [F.least(df.limit(1).agg(F.count(F.lit(1))).scalar(), F.lit(1)) for df in tables.values()],
    )
    return one_row.select(filled.cast("long").alias("total_tables"), "total_fds")
