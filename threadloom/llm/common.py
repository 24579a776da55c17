"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threadloom.session import shared_folder

# Words are runs of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_folders: list[tuple[SparkSession, str]] = []


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own in the shared folder, removed when Python ends."""
    path = f"{shared_folder(spark)}/threadloom-llm/{name}-{uuid.uuid4().hex}"
    if not _folders:
        atexit.register(remove_folders)
    _folders.append((spark, path))
    return path


def remove_folders() -> None:
    """Delete every folder that `new_folder` has named; tables read from them are gone then."""
    while _folders:
        spark, path = _folders.pop()
        try:
            location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            configuration = spark.sparkContext._jsc.hadoopConfiguration()
            location.getFileSystem(configuration).delete(location, True)
        except Exception:  # the session has ended and its scratch data with it
            return


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the file system that Spark takes it for, so that workers take it for the same."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    file_system = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return file_system.makeQualified(location).toString()


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The same rows read back from a table in the shared folder: cuts lineage, survives executors.

    `options` are those of the Parquet writer.
    """
    path = new_folder(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def long_id(column: str = "doc_id") -> Column:
    return F.col(column).cast("long").alias(column)


def whole_row(df: DataFrame) -> Column:
    """All columns as one, so that working columns of any name can stand beside them."""
    return F.struct(*[F.col(f"`{name}`") for name in df.columns]).alias("row")


def crc_of_id() -> Column:
    """crc32 of the decimal text of doc_id; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words; bytes.lower and bytes.split know ASCII alone, as wanted."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()
