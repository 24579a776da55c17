"""Keyed and unkeyed writes of Parquet tables.

A keyed table is Parquet partitioned by a bucket of its key's hash. A merge reads the buckets that
incoming keys fall into, stages the rows of those that change beside the table, and replaces their
partitions by Spark's dynamic partition overwrite. All other partitions keep their files.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.operators.ranking import first_per_key
from threadloom.session import path_bytes

BUCKET = "bucket_of_"
BUCKET_BYTES = 128 * 1024 * 1024
MOST_BUCKETS = 100_000
# Tasks that write one bucket together.
WRITERS = 16
# Ranges of each column of a Z-curve, as bits, and the rows that their bounds are taken from.
Z_BITS = 6
BOUNDS_SAMPLE = 20_000
Z_VALUE = "_z"
# Whether a staged row differs from the stored row of its key.
CHANGED = "_changed"
# Whether a row that competes is a stored one, and which of a bucket's writers it goes to.
STORED = "_stored"
SALT = "_salt"


def insert_ignore(
    existing: DataFrame, incoming: DataFrame, key: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Incoming rows to append: the first per new key, none for a key already stored."""
    fresh = first_per_key(incoming, key, order)
    return fresh.join(existing.select(*key), list(key), "left_anti").select(*incoming.columns)


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    order: Sequence[Column],
    update: Sequence[str] | None = None,
) -> DataFrame:
    """The stored table after replacing or inserting by key.

    `order` ranks incoming rows of one key, best first. With `update`, a stored
    row keeps its other columns; otherwise all columns are replaced.
    """
    return _upserted(existing, first_per_key(incoming, key, order), key, update).drop(CHANGED)


def _upserted(
    existing: DataFrame, chosen: DataFrame, key: Sequence[str], update: Sequence[str] | None
) -> DataFrame:
    """`upsert` of rows with a key each, and whether a row is new or differs from the stored one."""
    key = list(key)
    # A shuffle on the key serves both sides; each holds a key at most once. A struct is never empty.
    rest = [F.lit(True).alias("_held"), *[F.col(c) for c in existing.columns if c not in key]]
    old = existing.select(*key, F.struct(*rest).alias("_old"))
    new = chosen.select(*key, F.struct(*rest).alias("_new"))
    merged = old.join(new, key, "full_outer")
    replaced = set(existing.columns if update is None else update)
    columns = []
    for name in existing.columns:
        if name in key:
            columns.append(F.col(name))
            continue
        first, second = ("_new", "_old") if name in replaced else ("_old", "_new")
        columns.append(
            F.when(F.col(first).isNotNull(), F.col(f"{first}.{name}"))
            .otherwise(F.col(f"{second}.{name}"))
            .alias(name)
        )
    stored = F.col("_old")
    result = F.struct(F.lit(True).alias("_held"), *[
        column for name, column in zip(existing.columns, columns) if name not in key])
    return merged.select(
        *columns, (stored.isNull() | ~stored.eqNullSafe(result)).alias(CHANGED))


def append(df: DataFrame, path: str) -> None:
    """Add rows without looking at keys; writing the same rows again repeats them."""
    df.write.mode("append").parquet(path)


def recreate(df: DataFrame, path: str) -> None:
    """Replace a table with freshly computed rows."""
    df.write.mode("overwrite").parquet(path)


def reset(spark: SparkSession, path: str, schema) -> None:
    """Leave an empty table of the given schema behind."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def buckets_for(size: int) -> int:
    """Buckets of a keyed table of so many bytes, so that one is about a task's work."""
    return min(max(-(-size // BUCKET_BYTES), 1), MOST_BUCKETS)


def _folder(spark: SparkSession, path: str):
    """A path and its file system."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def bucket_column(spark: SparkSession, path: str) -> str | None:
    """The column that a keyed table is partitioned by; its name ends in the number of buckets."""
    location, files = _folder(spark, path)
    # A table whose first write has not ended is none, and is begun anew.
    if not files.exists(_folder(spark, f"{path}/_SUCCESS")[0]):
        return None
    names = [s.getPath().getName().split("=")[0] for s in files.listStatus(location)]
    return next((n for n in names if n.startswith(BUCKET)), None)


def _bucket(by: Sequence[str], column: str) -> Column:
    buckets = int(column.removeprefix(BUCKET))
    return F.pmod(F.xxhash64(*by), F.lit(buckets)).cast("int")


def read_keyed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a keyed table; a table that was never written has none."""
    column = bucket_column(spark, path)
    if column is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def read_buckets(
    spark: SparkSession, path: str, schema: T.StructType, keys: DataFrame, by: Sequence[str]
) -> DataFrame:
    """The buckets of a keyed table that the given values of `by` fall into; others are not read."""
    column = bucket_column(spark, path)
    if column is None:
        return spark.createDataFrame([], schema)
    # At most as many numbers as the table has buckets.
    near = [r[0] for r in keys.select(_bucket(by, column)).distinct().collect()]
    whole = T.StructType([*schema.fields, T.StructField(column, T.IntegerType())])
    return spark.read.schema(whole).parquet(path).filter(
        F.col(column).isin(near)).select(*schema.names)


def _staged(path: str) -> str:
    return f"{path}-staged"


def finish(
    spark: SparkSession, path: str, touched: Sequence[int] | None = None,
    schema: T.StructType | None = None,
) -> None:
    """Replace the partitions of a keyed table by those that are staged beside it, if there are any.

    With `touched`, only these buckets. A job that dies meanwhile leaves the staged rows, and the next
    call replaces all their partitions, which gives the same rows. Rows that are staged by bucket are
    copied as they lie, others are shuffled.
    """
    location, files = _folder(spark, _staged(path))
    if files.exists(_folder(spark, f"{_staged(path)}/_SUCCESS")[0]):
        rows = (spark.read.schema(schema) if schema else spark.read).parquet(_staged(path))
        column = rows.columns[-1]
        if touched is not None:
            rows = rows.filter(F.col(column).isin(list(touched)))
        if touched is None or touched:
            write = _write_dealt if bucket_column(spark, _staged(path)) else _write_buckets
            write(rows.drop(CHANGED), column, path, "dynamic")
    files.delete(location, True)


def _write_buckets(rows: DataFrame, column: str, path: str, overwrite: str) -> None:
    # A bucket's rows may be very many: several tasks write it.
    salt = F.pmod(F.xxhash64(*[c for c in rows.columns if c != column]), F.lit(WRITERS))
    _write_dealt(rows.repartition(F.col(column), salt), column, path, overwrite)


def _write_dealt(rows: DataFrame, column: str, path: str, overwrite: str) -> None:
    """Write the partitions of rows that tasks hold by bucket already."""
    (rows.write.mode("overwrite").option("partitionOverwriteMode", overwrite)
     .partitionBy(column).parquet(path))


def _first_dealt(
    rows: DataFrame, key: Sequence[str], order: Sequence[Column], by: Sequence[str], column: str
) -> DataFrame:
    """The first row of every key, dealt by bucket and writer: one shuffle finds it and lays it out.

    The writer follows from the key, so all rows of a key meet in one task. The bucket comes last.
    """
    dealt = rows.withColumn(column, _bucket(by, column)).withColumn(
        SALT, F.pmod(F.hash(*key), F.lit(WRITERS))).repartition(column, SALT)
    return first_per_key(dealt, [column, SALT, *key], order).drop(SALT)


def write_keyed(
    df: DataFrame, path: str, key: Sequence[str], by: Sequence[str] | None = None,
    buckets: int | None = None,
) -> None:
    """Start a keyed table: Parquet partitioned by a hash of its key, or of the columns `by`.

    The number of buckets follows from the size of the rows unless it is given.
    """
    spark = df.sparkSession
    if buckets is None:
        sized = f"{path}-sized"
        df.write.mode("overwrite").parquet(sized)
        df, buckets = spark.read.schema(df.schema).parquet(sized), buckets_for(path_bytes(spark, sized))
    column = f"{BUCKET}{buckets}"
    _write_buckets(df.withColumn(column, _bucket(by or key, column)), column, path, "static")
    location, files = _folder(spark, f"{path}-sized")
    files.delete(location, True)


def _changed_buckets(
    spark: SparkSession, path: str, whole: T.StructType, column: str
) -> list[int]:
    """Buckets of staged rows that are new or differ from the stored row of their key."""
    marked = T.StructType([*whole.fields, T.StructField(CHANGED, T.BooleanType())])
    return [r[0] for r in spark.read.schema(marked).parquet(_staged(path)).filter(
        CHANGED).select(column).distinct().collect()]


def merge_into(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    key: Sequence[str],
    order: Sequence[Column],
    update: Sequence[str] | None = None,
    by: Sequence[str] | None = None,
    buckets: int | None = None,
    reduction: Callable[[DataFrame], DataFrame] | None = None,
    unique: bool = False,
    competing: bool = False,
) -> list[int]:
    """Upsert into a keyed table, or start it; returns the buckets that were written.

    Only buckets with a row that is changed or new are written again; all others keep their files.
    `incoming` is computed more than once unless the table is started: it should be a stored table.
    `by` names key columns. With a reduction, stored and incoming rows of a key compete and it picks one
    of them. `unique` says that no key comes in twice, which spares a shuffle. `competing` says that
    stored and incoming rows of a key compete by `order`, which may name `STORED`; of equal rows the
    stored one stays. Rows are then shuffled once, by bucket, however many come in with a key.
    """
    finish(spark, path)
    column = bucket_column(spark, path)
    if column is None:
        if competing and buckets and not unique:
            column = f"{BUCKET}{buckets}"
            _write_dealt(_first_dealt(incoming, key, order, by or key, column), column, path, "static")
            return []
        fresh = incoming
        if not unique:
            fresh = reduction(incoming) if reduction else first_per_key(incoming, key, order)
        write_keyed(fresh, path, key, by, buckets)
        return []
    near_bucket = _bucket(by or key, column)
    whole = T.StructType([*incoming.schema.fields, T.StructField(column, T.IntegerType())])
    old = spark.read.schema(whole).parquet(path)
    alone = column == f"{BUCKET}1"
    if not alone:
        # At most as many numbers as the table has buckets.
        near = [r[0] for r in incoming.select(near_bucket).distinct().collect()]
        old = old.filter(F.col(column).isin(near))
    old = old.drop(column)
    if competing:
        both = old.withColumn(STORED, F.lit(True)).unionByName(
            incoming.withColumn(STORED, F.lit(False)))
        first = _first_dealt(both, key, [*order, F.col(STORED).desc()], by or key, column)
        _write_dealt(first.select(*old.columns, (~F.col(STORED)).alias(CHANGED), column),
                     column, _staged(path), "static")
        touched = _changed_buckets(spark, path, whole, column)
        finish(spark, path, touched, whole)
        return touched
    if reduction:
        merged = reduction(old.unionByName(incoming)).select(*old.columns)
    else:
        chosen = incoming if unique else first_per_key(incoming, key, order)
        merged = _upserted(old, chosen, key, update)
    merged.withColumn(column, near_bucket).write.mode("overwrite").parquet(_staged(path))
    touched = [0]
    if not reduction:
        touched = _changed_buckets(spark, path, whole, column)
    elif not alone:
        row = F.struct(*old.columns).alias("_row")
        keys = [F.col(f"n.{k}") == F.col(f"o.{k}") for k in key]
        staged = spark.read.schema(whole).parquet(_staged(path))
        changed = staged.select(*key, row, column).alias("n").join(
            old.select(*key, row).alias("o"),
            [*keys, F.col("n._row").eqNullSafe(F.col("o._row"))], "left_anti")
        touched = [r[0] for r in changed.select(column).distinct().collect()]
    finish(spark, path, touched, whole)
    return touched


def clustered(
    df: DataFrame, path: str, *columns: str, bloom: Mapping[str, int] | None = None,
    files: int | None = None,
) -> None:
    """Write a table range-sorted by the columns its queries filter on.

    Every file then covers a narrow range, so Parquet statistics skip the rest.
    Ranges over several columns also split a single frequent leading value,
    which hash buckets or directories per value would keep together.

    `bloom` gives columns that are looked up by single values, with about how many different values a
    row group may hold; each gets a Bloom filter, which skips row groups without the value.
    """
    dealt = (df.repartitionByRange(files, *columns) if files else df.repartitionByRange(*columns))
    _write_with_filters(dealt.sortWithinPartitions(*columns), path, bloom)


def _write_with_filters(df: DataFrame, path: str, bloom: Mapping[str, int] | None) -> None:
    writer = df.write.mode("overwrite")
    for column, values in (bloom or {}).items():
        writer = (writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
                  .option(f"parquet.bloom.filter.expected.ndv#{column}", str(values)))
    writer.parquet(path)


def range_bounds(df: DataFrame, column: str, ranges: int, sample: int = BOUNDS_SAMPLE) -> list:
    """Values that cut a column into ranges of about as many rows, from at most about `sample` rows.

    They decide how rows are dealt to files, nothing else.
    """
    present = df.select(column).filter(F.col(column).isNotNull())
    share = min(1.0, sample / max(present.count(), 1))
    drawn = present if share == 1.0 else present.sample(share, seed=7)
    values = sorted(r[0] for r in drawn.collect())
    cuts = [values[len(values) * i // ranges] for i in range(1, ranges)] if values else []
    return sorted(set(cuts))


def range_rank(column: str, bounds: list, bits: int) -> Column:
    """How many bounds are at most the value, by binary search; NULL ranks with the least."""
    if not bounds:
        return F.lit(0)
    known = F.array(*[F.lit(b) for b in bounds])

    def halve(low: Column, step: Column) -> Column:
        # `get` gives NULL beyond the last bound, which no value reaches.
        at = low + step
        reached = F.coalesce(F.get(known, at - 1) <= F.col(column), F.lit(False))
        return F.when(reached, at).otherwise(low)

    steps = F.array(*[F.lit(1 << (bits - 1 - i)) for i in range(bits)])
    return F.aggregate(steps, F.lit(0), halve)


def z_order(ranks: Sequence[Column], bits: int) -> Column:
    """The bits of the ranks in turn, highest first, as one number."""
    n = len(ranks)
    return reduce(lambda a, b: a.bitwiseOR(b), [
        F.shiftleft(F.getbit(rank, F.lit(i)).cast("long"), i * n + (n - 1 - j))
        for j, rank in enumerate(ranks) for i in range(bits)])


def z_ordered(
    df: DataFrame, path: str, *columns: str, bits: int = Z_BITS,
    bloom: Mapping[str, int] | None = None, files: int | None = None,
) -> None:
    """Write a table along a Z-curve over several columns, so that files are narrow in each of them.

    Each column is ranked by ranges of its own, and the curve takes a bit of each rank in turn. Rows of
    equal ranks are dealt by the columns themselves, so no frequent value is kept together.
    """
    ranks = [range_rank(c, range_bounds(df, c, 1 << bits), bits) for c in columns]
    keyed = df.withColumn(Z_VALUE, z_order(ranks, bits))
    order = [Z_VALUE, *columns]
    dealt = keyed.repartitionByRange(files, *order) if files else keyed.repartitionByRange(*order)
    _write_with_filters(dealt.sortWithinPartitions(*order).drop(Z_VALUE), path, bloom)


def bucketed(df: DataFrame, table: str, path: str, buckets: int, *columns: str) -> DataFrame:
    """A table of the session's catalog in sorted buckets, so that joins on the columns need no shuffle."""
    (df.repartition(buckets, *columns).write.mode("overwrite").bucketBy(buckets, *columns)
     .sortBy(*columns).option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)
