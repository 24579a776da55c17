"""Readers with declared schemas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom import schemas
from threadloom.operators.ranking import dense_row_number


def read_flat(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, first: int | None = None
) -> DataFrame:
    """Named columns of the flat comment table, optionally only some rows."""
    df = spark.read.schema(schemas.FLAT).parquet(path)
    if columns:
        df = df.select(*columns)
    return df if first is None else df.limit(first)


def read_flat_for_documents(spark: SparkSession, path: str) -> DataFrame:
    """The columns the document loader uses; partitions take the place of chunks."""
    return read_flat(spark, path, schemas.DOCUMENT_COLUMNS)


def read_json(spark: SparkSession, path: str, schema: T.StructType = schemas.FLAT) -> DataFrame:
    """JSON lines, plain or gzip-compressed, without schema inference."""
    return spark.read.schema(schema).json(path)


REJECTED = "_rejected"


def checked_json(
    spark: SparkSession, path: str, store, schema: T.StructType = schemas.FLAT
) -> tuple[DataFrame, DataFrame]:
    """JSON lines as good rows and, apart from them, the text of rejected lines (column `line`).

    A line is rejected alone if it is no JSON object or holds a value of another type than declared.
    Lines are parsed once, whole, and stored: a reader of few columns would not see that another
    column is wrong. Blank lines are no lines. Absent columns are NULL, others are not read.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED}
    wanted = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = lines.select("value", F.from_json("value", wanted, options).alias("row"))
    # A line `null` is parsed to no row at all.
    wrong = F.col("row").isNull() | F.col(f"row.{REJECTED}").isNotNull()
    # Good lines are stored as rows and rejected ones as text, neither as both.
    judged = store(parsed.select(
        F.when(~wrong, F.col("row")).alias("row"), F.when(wrong, F.col("value")).alias("line")))
    return (judged.filter(F.col("line").isNull()).select("row.*").drop(REJECTED),
            judged.filter(F.col("line").isNotNull()).select("line"))


def read_table(
    spark: SparkSession, table: str, path: str, first: int | None = None
) -> DataFrame:
    """One relational table."""
    df = spark.read.schema(schemas.RELATIONAL[table]).parquet(path)
    return df if first is None else df.limit(first)


def read_jdbc(
    spark: SparkSession, url: str, table: str, partition_column: str, lower: int, upper: int,
    partitions: int, properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """One table of a database, in parallel ranges; needs its JDBC driver on the class path."""
    return spark.read.jdbc(
        url, table, column=partition_column, lowerBound=lower, upperBound=upper,
        numPartitions=partitions, properties=dict(properties or {}),
    )


def read_documents(
    spark: SparkSession, collection: str, path: str, file_format: str = "parquet"
) -> DataFrame:
    """One document collection, nested columns included."""
    return spark.read.schema(schemas.DOCUMENTS[collection]).format(file_format).load(path)


def sample(df: DataFrame, n: int, *order: Column, store) -> DataFrame:
    """The first n rows in a total order, so that a rerun gives the same rows.

    Rows are numbered over a stored range sort, so no task sees more than its range however large n
    is.
    """
    numbered = dense_row_number(df, order, "_row", store)
    return numbered.filter(F.col("_row") <= n).drop("_row")


def first_rows(df: DataFrame, n: int, store) -> DataFrame:
    """The first n rows in the order of all columns."""
    return sample(df, n, *[F.col(c).asc_nulls_last() for c in df.columns], store=store)


def catalog(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """Tables, columns, types and declared keys, with how many values are present."""
    result = None
    for name, df in tables.items():
        counted = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
        types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        lookup = lambda values: F.coalesce(*[
            F.when(F.col("column_name") == c, F.lit(v)) for c, v in values.items()
        ])
        rows = counted.unpivot([], df.columns, "column_name", "present_values").select(
            F.lit(name).alias("table_name"),
            lookup({c: i for i, c in enumerate(df.columns, 1)}).alias("position"),
            "column_name",
            lookup(types).alias("column_type"),
            F.col("column_name").isin(list(keys.get(name, []))).alias("is_key"),
            "present_values",
        )
        result = rows if result is None else result.unionByName(rows)
    return result


def stored_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of a folder by name: its sub-folders and files in Parquet form, without a list."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    names = sorted(s.getPath().getName() for s in found)
    return {n.removesuffix(".parquet"): spark.read.parquet(f"{root}/{n}")
            for n in names if not n.startswith(("_", "."))}


def catalog_tables(spark: SparkSession, database: str | None = None) -> dict[str, DataFrame]:
    """All tables and views of a catalog database by name."""
    listed = spark.catalog.listTables(database)
    return {t.name: spark.table(t.name if t.isTemporary or not database else f"{database}.{t.name}")
            for t in listed}
