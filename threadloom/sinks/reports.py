"""Text and CSV reports, built as DataFrames of lines."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.operators.mining import itemset_order, rule_order, top_itemsets
from threadloom.operators.ranking import dense_row_number

LINE_COLUMNS = ["section", "entry", "line_no", "line"]


def _lines(
    df: DataFrame, section: int, entry: Column, lines: Sequence[Column], after: Column | None = None
) -> DataFrame:
    """One row per line of each entry, numbered from 1 or from `after`; NULL lines are left out."""
    after = F.lit(0) if after is None else after
    numbered = F.array(*[
        F.struct((after + i).cast("int").alias("line_no"), line.alias("line"))
        for i, line in enumerate(lines, 1)
    ])
    return (
        df.select(entry.cast("long").alias("entry"), F.explode(numbered).alias("l"))
        .select(F.lit(section).alias("section"), "entry", "l.line_no", "l.line")
        .filter(F.col("line").isNotNull())
    )


def fixed(value: Column, digits: int) -> Column:
    """A number with a fixed count of decimals, its binary value rounded exactly, ties to even.

    With c = 2 * 10**digits the question is on which side of an odd number value * c lies. The value
    is split into a 24-bit part and a rest, whose products with c are exact; the difference of the
    large product and the odd number is exact, and adding the small one keeps the sign.
    """
    c = float(2 * 10**digits)
    size = F.abs(value)
    upper = size.cast("float").cast("double")
    large, small = upper * F.lit(c), (size - upper) * F.lit(c)
    below = F.floor((large + small) / 2)
    side = (large - (below * 2 + 1).cast("double")) + small
    whole = below + F.when(side > 0, 1).when(side < 0, 0).otherwise(below % 2)
    sign = F.when(value < 0, "-").otherwise("")
    parts = [F.floor(whole / F.lit(10**digits)).cast("long"), (whole % F.lit(10**digits)).cast("long")]
    return F.format_string(f"%s%d.%0{digits}d", sign, *parts)


def timing_comparison(before: DataFrame, after: DataFrame) -> DataFrame:
    """Before and after times by query with the speedup, fastest gain first."""
    merged = before.select("query", "row_count", F.col("seconds").alias("time_before")).join(
        after.select("query", F.col("seconds").alias("time_after")), "query"
    )
    speedup = F.round(F.try_divide("time_before", "time_after"), 2)
    return merged.withColumn("speedup", speedup).orderBy(
        F.col("speedup").desc(), F.col("query").asc()
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def rule_report(
    summary: DataFrame, itemsets: DataFrame, rules: DataFrame, store, first_itemsets: int = 50
) -> DataFrame:
    """Lines of the mining report: summary, most frequent itemsets, all rules."""
    heading = _lines(
        summary, 1, F.lit(1),
        [
            F.format_string("Frequent Itemsets: %d", "frequent_itemsets"),
            F.format_string("Association Rules: %d", "association_rules"),
            F.when(F.col("association_rules") > 0,
                   F.concat(F.lit("Average Confidence: "), fixed(F.col("average_confidence"), 4))),
            F.when(F.col("association_rules") > 0,
                   F.concat(F.lit("Average Lift: "), fixed(F.col("average_lift"), 4))),
            F.when(F.col("association_rules") > 0,
                   F.format_string("Rules with Lift > 1.0: %d", "rules_with_positive_lift")),
        ],
    )
    # `first_itemsets` rows, so one task may number them.
    ranked_sets = top_itemsets(itemsets, first_itemsets).withColumn(
        "entry", F.row_number().over(Window.orderBy(*itemset_order()))
    )
    support = [fixed(F.col("support"), 4), fixed(F.col("support") * 100, 2)]
    confidence = [fixed(F.col("confidence"), 4), fixed(F.col("confidence") * 100, 1)]
    itemset_lines = _lines(
        ranked_sets, 2, F.col("entry"),
        [
            F.format_string("%d. %s", "entry", F.array_join("items", ", ")),
            F.format_string("   Support: %s (%s%%)", *support),
            F.format_string("   Length: %d items", "length"),
        ],
    )
    numbered = dense_row_number(rules, rule_order(), "entry", store)
    direction = (
        F.when(F.col("lift") > 1, " (positive association)")
        .when(F.col("lift") < 1, " (negative association)")
        .otherwise(" (no association)")
    )
    shown_conviction = F.when(F.col("conviction") == float("inf"), "inf").otherwise(
        fixed(F.col("conviction"), 4)
    )
    rule_lines = _lines(
        numbered, 3, F.col("entry"),
        [
            F.format_string("Rule %d:", "entry"),
            F.concat(F.lit("  IF "), F.array_join("antecedents", ", ")),
            F.concat(F.lit("  THEN "), F.array_join("consequents", ", ")),
            F.format_string("  Support: %s (%s%%)", *support),
            F.format_string("  Confidence: %s (%s%%)", *confidence),
            F.concat(F.lit("  Lift: "), fixed(F.col("lift"), 4), direction),
            F.concat(F.lit("  Conviction: "), shown_conviction),
        ],
    )
    return reduce(DataFrame.unionByName, [heading, itemset_lines, rule_lines])


# Order in which kinds of dependency appear under a table.
FD_TYPES = ["Primary Key", "Candidate Key", "Domain-Based"]
SHOWN_EXAMPLES = 2
LINES_PER_FD = 100
# Fixed value: the line of a table without dependencies.
NOTHING_FOUND = "*No functional dependencies discovered beyond primary key constraints.*"


def fd_report(found: DataFrame, facts: DataFrame, examples: DataFrame) -> DataFrame:
    """Lines of the dependency report: totals, then each table with its dependencies by type.

    The number of tables, dependencies and examples depends on the schema only,
    so one task may number them.
    """
    totals = found.agg(F.count(F.lit(1)).alias("fds")).select(
        "fds", facts.agg(F.count(F.lit(1))).scalar().alias("tables")
    )
    total_lines = _lines(
        totals, 1, F.lit(1),
        [
            F.format_string("- **Total Tables Analyzed**: %d", "tables"),
            F.format_string("- **Total Functional Dependencies Discovered**: %d", "fds"),
        ],
    )
    tables = facts.withColumn("entry", F.row_number().over(Window.orderBy("table_name")))
    known = found.select("table_name").distinct().withColumn("any", F.lit(True))
    table_lines = _lines(
        tables.join(known, "table_name", "left"), 2, F.col("entry"),
        [
            F.format_string("### Table: `%s`", "table_name"),
            F.concat(F.lit("**Columns**: "), F.col("columns")),
            F.concat(F.lit("**Row Count**: "), F.format_number("row_count", 0)),
            F.concat(F.lit("**Primary Key**: `"), F.col("primary_key"), F.lit("`")),
            F.when(F.col("any"), "#### Functional Dependencies").otherwise(NOTHING_FOUND),
        ],
    )
    first = Window.partitionBy("table_name", "determinant", "dependent_column").orderBy(
        "determinant_value"
    )
    shown = (
        examples.withColumn("n", F.row_number().over(first))
        .filter(F.col("n") <= SHOWN_EXAMPLES)
        .groupBy("table_name", "determinant", F.col("dependent_column").alias("dependent"))
        .agg(F.array_sort(F.collect_list(F.format_string(
            "    - %s=%s -> %s=[%s]", "determinant", "determinant_value", "dependent_column",
            F.array_join("dependent_values", ", "),
        ))).alias("example_lines"))
    )
    kind = F.array_position(F.array(*[F.lit(t) for t in FD_TYPES]), F.col("fd_type"))
    in_table = Window.partitionBy("table_name").orderBy(kind, "determinant", "dependent")
    in_type = Window.partitionBy("table_name", "fd_type").orderBy("determinant", "dependent")
    listed = (
        found.join(tables.select("table_name", "entry"), "table_name")
        .join(shown, ["table_name", "determinant", "dependent"], "left")
        .withColumn("place", F.row_number().over(in_table))
        .withColumn("leads", F.row_number().over(in_type) == 1)
    )
    status = F.when(F.col("holds"), "HOLDS").otherwise("FAILS")
    fails = ~F.col("holds")
    fd_lines = _lines(
        listed, 2, F.col("entry"),
        [
            F.when(F.col("leads"), F.format_string("**%s Dependencies:**", "fd_type")),
            F.format_string("- `%s` -> `%s` **%s**", "determinant", "dependent", status),
            F.format_string("  - Type: %s", "fd_type"),
            F.lit("  - Confidence: High"),
            F.concat(F.lit("  - Description: "), F.col("description")),
            F.when(fails, F.format_string("  - Violations: %d violations in %d groups",
                                          "violations", "total_groups")),
            F.when(fails & F.col("example_lines").isNotNull(), "  - Example violations:"),
            *[F.when(fails, F.get(F.col("example_lines"), F.lit(i)))
              for i in range(SHOWN_EXAMPLES)],
        ],
        F.col("place") * LINES_PER_FD,
    )
    return reduce(DataFrame.unionByName, [total_lines, table_lines, fd_lines])


def write_text(lines: DataFrame, path: str) -> None:
    """Store report lines in reading order, as text files that sort like the report."""
    ordered = lines.orderBy("section", "entry", "line_no").select("line")
    ordered.write.mode("overwrite").text(path)
