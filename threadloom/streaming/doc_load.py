"""Document loading with Structured Streaming.

Each collection is a stream of its own. A batch is reduced to the first (or last) row of every key in
the total order of `ranking` and added to the rows that wait beside the keyed tables (`sinks.tables`) of
the target; so a batch costs what it holds, however many there are and however large the tables have
grown. After the last batch the waiting rows are set aside and merged, where they compete with each other
and with the stored rows in the same order. So a repeated batch changes nothing, several loads with progress folders of their
own can fill one target, and only buckets with a changed row are written. Rows that a load which died
has left waiting are merged by the next load or before the collections are read.

Embedded comments and counters are kept up as well. Comments are stored a second time by post; in a
merge the arrays of those posts are made anew that a changed comment belongs to, or belonged to. Where
there are no comments yet, they are stored first and all arrays are made from them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom import schemas
from threadloom.operators import documents
from threadloom.operators.ranking import RANK
from threadloom.session import move_path, path_bytes, path_exists, remove_path
from threadloom.sinks import tables as sinks

Reduction = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Kept:
    """How a collection is kept: the rows found in a chunk, its key, and which row of a key stays."""

    found: Reduction
    reduced: Reduction
    key: str
    order: tuple[str, ...]
    last: bool


def _kept(found: Reduction, reduced: Reduction, key: str, columns: list[str], last: bool) -> Kept:
    lead = documents.ORDER_COLUMNS
    return Kept(found, reduced, key, (*lead, *[c for c in columns if c not in lead]), last)


KEPT: dict[str, Kept] = {
    "users": _kept(documents.user_rows, documents.last_users, "_id",
                   schemas.DOCUMENTS["users"].names, True),
    "subreddits": _kept(documents.subreddit_rows, documents.last_subreddits, "_id",
                        ["_id", "name_"], True),
    "posts": _kept(documents.post_rows, documents.first_posts, "_id", documents.POST_ORDER, False),
    "comments": _kept(documents.comment_rows, documents.first_comments, "id",
                      schemas.DOCUMENTS["comments"].names, False),
    "moderation": _kept(documents.moderation_rows, documents.last_moderation, "_id",
                        schemas.DOCUMENTS["moderation"].names, True),
}

# Rows of comments by post; `gone` marks one that has come to belong to another post.
BY_POST_COLUMNS = ["post_id", *schemas.EMBEDDED_COMMENT.names, "name"]

# Bound of one batch, whatever the size of the source.
FILES_PER_BATCH = 1000


def kept_rows(rows: DataFrame, kept: Kept) -> DataFrame:
    """One row per key of a batch; all but one row of a key in a task are left out before the shuffle."""
    return kept.reduced(rows).select(*rows.columns)


def kept_order(kept: Kept) -> list[Column]:
    """The order whose first row of a key is kept."""
    return [F.col(c).desc_nulls_first() if kept.last else F.col(c).asc_nulls_last()
            for c in kept.order]


def row_schema(spark: SparkSession, name: str) -> T.StructType:
    """Columns of a collection's stored rows, ordering columns included."""
    flat = spark.createDataFrame([], schemas.FLAT).select(*schemas.LOADED_COLUMNS)
    return KEPT[name].found(flat).schema


def _by_post_schema(spark: SparkSession) -> T.StructType:
    rows = row_schema(spark, "comments")
    return T.StructType([*(rows[c] for c in BY_POST_COLUMNS), T.StructField("gone", T.BooleanType())])


def _arrays_schema() -> T.StructType:
    return T.StructType([
        T.StructField("_id", T.StringType()), T.StructField("comment_count", T.LongType()),
        T.StructField("comments", schemas.DOCUMENTS["posts"]["comments"].dataType)])


class Writer:
    """Merges the changed rows of micro-batches into the tables of a target."""

    def __init__(self, target: str, buckets: int | None = None,
                 embed_cap: int = documents.EMBED_CAP):
        self.target, self.buckets, self.embed_cap = target, buckets, embed_cap

    def path(self, name: str) -> str:
        return f"{self.target}/{name}"

    def _incoming(self, name: str) -> str:
        return f"{self.target}/incoming/{name}"

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        """Rows of a merge, written once; a merge that is repeated writes them again.

        What has been shuffled to make them is off the disks before they are dealt to buckets.
        """
        path = f"{self.target}/merging/{name}"
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def _merge(self, name: str, rows: DataFrame, key: list[str], order: list[Column], by=None,
               unique: bool = False) -> list[int]:
        """Let rows compete with the stored ones."""
        return sinks.merge_into(rows.sparkSession, self.path(name), rows, key, order, by=by,
                                buckets=self.buckets, unique=unique, competing=True)

    def _replace(self, name: str, rows: DataFrame, key: list[str], by=None) -> list[int]:
        """Let rows with a key each take the place of the stored ones."""
        return self._merge(name, rows, key, [F.col(sinks.STORED)], by, unique=True)

    def write(self, name: str) -> Callable[[DataFrame, int], None]:
        """The writer of one collection's batches; running it again for a batch changes nothing."""

        def write(changed: DataFrame, batch_id: int) -> None:
            sinks.append(changed, self._incoming(name))

        return write

    def settle(self, spark: SparkSession) -> None:
        """Merge all waiting rows. A merge that died is repeated with its own rows first."""
        for name in KEPT:
            self._merge_aside(spark, name)
            if path_exists(spark, self._incoming(name)):
                move_path(spark, self._incoming(name), f"{self.target}/merging/{name}")
                self._merge_aside(spark, name)

    def _merge_aside(self, spark: SparkSession, name: str) -> None:
        """Merge the rows that are set aside for it, then remove them."""
        path, kept = f"{self.target}/merging/{name}", KEPT[name]
        if name == "comments":
            self._start_arrays(spark)
        if path_exists(spark, path):
            rows = spark.read.schema(row_schema(spark, name)).parquet(path)
            if name == "comments" and sinks.bucket_column(spark, self.path(name)):
                self._write_arrays(rows)
            self._merge(name, rows, [kept.key], kept_order(kept))
            remove_path(spark, path)
            if name == "comments":
                self._start_arrays(spark)

    def _start_arrays(self, spark: SparkSession) -> None:
        """Start the comments by post and the arrays from all comments, unless they are there."""
        if not sinks.bucket_column(spark, self.path("comments")):
            return
        if not sinks.bucket_column(spark, self.path("by_post")):
            rows = kept_table(spark, self.target, "comments")
            self._replace("by_post", rows.select(*BY_POST_COLUMNS, F.lit(False).alias("gone")),
                          ["post_id", "id"], by=["post_id"])
        if not sinks.bucket_column(spark, self.path("post_comments")):
            by_post = sinks.read_keyed(spark, self.path("by_post"), _by_post_schema(spark))
            self._replace("post_comments", self._stored(
                post_arrays(by_post, self.embed_cap), "arrays"), ["_id"])
            remove_path(spark, f"{self.target}/merging/arrays")

    def _write_arrays(self, rows: DataFrame) -> None:
        """Make the arrays of the posts anew whose comments change.

        The table of comments is merged into afterwards, so that a merge that is repeated finds the
        posts again which comments had before.
        """
        spark = rows.sparkSession
        moved = self._stored(self._moved(rows), "comments-by-post")
        self._replace("by_post", moved, ["post_id", "id"], by=["post_id"])
        posts = moved.select("post_id").distinct()
        own = sinks.read_buckets(
            spark, self.path("by_post"), _by_post_schema(spark), posts, ["post_id"])
        arrays = post_arrays(own.join(posts, "post_id", "left_semi"), self.embed_cap)
        # A post that has lost all its comments keeps a row without any.
        whole = posts.withColumnRenamed("post_id", "_id").join(arrays, "_id", "left").select(
            "_id", F.coalesce("comment_count", F.lit(0)).alias("comment_count"),
            F.coalesce("comments", F.array().cast(
                _arrays_schema()["comments"].dataType)).alias("comments"))
        arrays = self._stored(whole, "arrays")
        self._replace("post_comments", arrays, ["_id"])
        for name in ("comments-by-post", "arrays"):
            remove_path(spark, f"{self.target}/merging/{name}")

    def _moved(self, rows: DataFrame) -> DataFrame:
        """Comments by post that change: as they are now, and marked as gone from another post.

        Stored and waiting rows of a comment compete in one shuffle; where the stored one stays, nothing
        changes.
        """
        before = sinks.read_buckets(
            rows.sparkSession, self.path("comments"), rows.schema, rows, ["id"])
        both = before.withColumn(sinks.STORED, F.lit(True)).unionByName(
            rows.withColumn(sinks.STORED, F.lit(False)))
        stored = F.col(sinks.STORED)
        ranked = Window.partitionBy("id").orderBy(*kept_order(KEPT["comments"]), stored.desc())
        placed = both.select(*BY_POST_COLUMNS, stored, F.row_number().over(ranked).alias(RANK),
                             F.first("post_id").over(ranked).alias("_now"))
        changed = (F.col(RANK) == 1) & ~stored
        left = (F.col(RANK) > 1) & stored & (F.col("post_id") != F.col("_now"))
        return placed.filter(changed | left).select(*BY_POST_COLUMNS, left.alias("gone"))


def post_arrays(by_post: DataFrame, embed_cap: int) -> DataFrame:
    """Counter and first comments of each post, from comments stored by post."""
    live = by_post.filter(~F.col("gone")).drop("gone")
    counts = documents.comment_counts(live)
    arrays = documents.embedded(live, embed_cap)
    return counts.join(arrays, "post_id").select(
        F.col("post_id").alias("_id"), F.col("comment_count").cast("long").alias("comment_count"),
        "comments")


def load_available(
    spark: SparkSession, source: str, target: str, progress: str,
    files_per_batch: int = FILES_PER_BATCH, bytes_per_batch: str | None = None,
    embed_cap: int = documents.EMBED_CAP,
) -> None:
    """Load all flat files not loaded before, in batches of bounded size.

    A batch has at most `files_per_batch` files or, if `bytes_per_batch` is given instead, about
    that many bytes; what batches have left is merged once, after the last one. The five collections are streams of their own over the same files, each reading
    the columns that it needs. A source without files gives empty collections.
    """
    if not path_exists(spark, source):
        raise FileNotFoundError(source)
    bound = (("maxFilesPerTrigger", str(files_per_batch)) if bytes_per_batch is None
             else ("maxBytesPerTrigger", bytes_per_batch))
    writer = Writer(target, sinks.buckets_for(path_bytes(spark, source)), embed_cap)

    def load(name: str) -> None:
        kept, write = KEPT[name], writer.write(name)
        chunks = (
            spark.readStream.schema(schemas.FLAT).option(*bound).parquet(source)
            .select(*schemas.LOADED_COLUMNS)
        )
        (kept.found(chunks).writeStream
         .foreachBatch(lambda rows, batch: write(kept_rows(rows, kept), batch))
         .option("checkpointLocation", f"{progress}/{name}")
         .trigger(availableNow=True).start().awaitTermination())

    # The five streams are independent jobs; together they fill the cluster.
    with ThreadPoolExecutor(len(KEPT)) as pool:
        list(pool.map(load, KEPT))
    writer.settle(spark)


def kept_table(spark: SparkSession, target: str, name: str) -> DataFrame:
    """One row per key of a collection as loaded so far, ordering columns included."""
    return sinks.read_keyed(spark, f"{target}/{name}", row_schema(spark, name))


class Collections(Mapping):
    """The five collections as loaded so far."""

    def __init__(self, spark: SparkSession, target: str, embed_cap: int):
        self._spark, self._target, self._cap = spark, target, embed_cap

    def _rows(self, name: str) -> DataFrame:
        return kept_table(self._spark, self._target, name)

    def posts(self, fields: Sequence[str] = schemas.EMBEDDED_COMMENT.names) -> DataFrame:
        """The posts, with these fields of their embedded comments; others are not read."""
        arrays = sinks.read_keyed(self._spark, f"{self._target}/post_comments", _arrays_schema())
        if list(fields) != schemas.EMBEDDED_COMMENT.names:
            some = F.arrays_zip(*[F.col(f"comments.{f}").alias(f) for f in fields])
            arrays = arrays.withColumn("comments", some)
        return documents.with_comments(self._rows("posts"), arrays, self._cap)

    def __getitem__(self, name: str) -> DataFrame:
        shapes: dict[str, Callable[[], DataFrame]] = {
            "users": lambda: documents.shape_users(self._rows("users")),
            "subreddits": lambda: documents.shape_subreddits(self._rows("subreddits")),
            "posts": self.posts,
            "comments": lambda: documents.shape_comments(self._rows("comments")),
            "moderation": lambda: documents.shape_moderation(self._rows("moderation")),
        }
        return shapes[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(KEPT)

    def __len__(self) -> int:
        return len(KEPT)

    def counts(self) -> DataFrame:
        """Documents per collection: one per key, so nothing has to be shaped."""
        return documents.collection_counts({name: self._rows(name) for name in KEPT})


def collections(spark: SparkSession, target: str, embed_cap: int = documents.EMBED_CAP
                ) -> Collections:
    """The collections of a target; `embed_cap` is at most that of its loads.

    Rows that are still waiting are merged first.
    """
    Writer(target).settle(spark)
    return Collections(spark, target, embed_cap)
