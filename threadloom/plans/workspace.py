"""Stored working tables of one flat comment table.

A comment table is loaded once: it, the relational tables, their cleaned
copies and the document collections are written as Parquet under the shared
folder when they are first needed, and read back from there. Later queries start
from a plain scan with pushed filters, and lost executors cost a re-read only.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from threadloom import schemas
from threadloom.operators import clean, constraints, documents, mining, normalize
from threadloom.operators.ranking import row_order
from threadloom.session import TASK_BYTES, path_bytes, prepare, restore, shared_folder
from threadloom.sources import mapping
from threadloom.sources import tables as sources
from threadloom.streaming import doc_load

# Load time of the test tables, so that reruns store the same rows.
LOAD_TIME = 1433203200

# Small batches, so that the test tables are loaded in several of them.
TEST_FILES_PER_BATCH = 4


# Working tables are written more often than a reader would notice the codec.
COMPRESSION = "zstd"


# Tables that lie in a folder of their own, which holds nothing else, and their names there.
SOURCES = {"flat": "comments_raw", **{name: name for name in schemas.RELATIONAL}}


class _Group(Mapping):
    """Tables under short names, each stored when it is first asked for."""

    def __init__(self, names: list[str], get: Callable[[str], DataFrame]):
        self._names = names
        self._get = get

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        return self._get(name)

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


class Workspace:
    """Tables derived from the comments that `read_flat` returns.

    `load_time` is the action time of moderation rows; by default the time of the run. An incremental
    load takes `files_per_batch` files of the stored flat table at a time.
    """

    def __init__(
        self,
        spark: SparkSession,
        read_flat: Callable[[], DataFrame],
        input_bytes: int = 0,
        load_time: int | None = None,
        files_per_batch: int = doc_load.FILES_PER_BATCH,
    ):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/threadloom-{uuid.uuid4().hex}"
        self.source_root = f"{self.root}/source"
        self._read_flat = read_flat
        self._load_time = load_time
        self.files_per_batch = files_per_batch
        self._settings = prepare(spark, input_bytes, TASK_BYTES)
        self._paths: dict[str, str] = {}
        self._schemas: dict[str, object] = {}
        self._lock = threading.RLock()
        self.relational = _Group(list(schemas.RELATIONAL), self.table)
        self.cleaned = _Group(schemas.CLEANED_TABLES, lambda n: self.table(f"{n}_cleaned"))
        self.collections = _Group(list(schemas.DOCUMENTS), self._collection)

    @property
    def flat(self) -> DataFrame:
        return self.table("flat")

    def table(self, name: str) -> DataFrame:
        """A stored table, written on first use."""
        with self._lock:
            if name not in self._paths:
                df = self._build(name)
                path = f"{self.source_root if name in SOURCES else self.root}/{SOURCES.get(name, name)}"
                df.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
                self._paths[name], self._schemas[name] = path, df.schema
        return self.spark.read.schema(self._schemas[name]).parquet(self._paths[name])

    def path(self, name: str) -> str:
        """Where a stored table lies."""
        self.table(name)
        return self._paths[name]

    def new_path(self, label: str) -> str:
        """A folder nothing has been written to."""
        return f"{self.root}/{label}-{uuid.uuid4().hex}"

    def close(self) -> None:
        """Remove the folder of the workspace with all its tables, and restore the settings."""
        restore(self.spark, self._settings)
        with self._lock:
            jvm = self.spark.sparkContext._jvm
            root = jvm.org.apache.hadoop.fs.Path(self.root)
            root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)
            self._paths.clear()
            self._schemas.clear()

    def store(self, df: DataFrame) -> DataFrame:
        """Write rows once and return them read back, which cuts the lineage."""
        path = self.new_path("stored")
        df.write.option("compression", COMPRESSION).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def streamed_documents(self) -> str:
        """The target of an incremental load of the flat table, run once."""
        with self._lock:
            if "streamed" not in self._paths:
                target = self.new_path("stream-target")
                doc_load.load_available(
                    self.spark, self.path("flat"), target, self.new_path("stream-progress"),
                    files_per_batch=self.files_per_batch,
                )
                self._paths["streamed"] = target
        return self._paths["streamed"]

    def _collection(self, name: str) -> DataFrame:
        if name == "comments":
            return documents.shape_comments(self.table("doc_comment_rows"))
        return self.table(f"doc_{name}")

    def _build(self, name: str) -> DataFrame:
        if name == "flat":
            return self._read_flat()
        if name.endswith("_cleaned"):
            table = name.removesuffix("_cleaned")
            return clean.clean(table, self.relational[table])
        builders: dict[str, Callable[[], DataFrame]] = {
            "users": lambda: normalize.users(self.flat),
            "subreddit": lambda: normalize.subreddit(self.flat),
            "post": lambda: normalize.post(self.flat),
            "post_link": lambda: constraints.accepted(
                "post_link", normalize.post_link(self.flat), self.relational
            ),
            "known_links": lambda: normalize.known_links(
                self.relational["post_link"], self.relational["post"]
            ),
            "comment": lambda: normalize.comment(self.flat, self.table("known_links")),
            "moderation": lambda: normalize.moderation(self.flat, self.store, self._load_time),
            "doc_users": lambda: documents.users(self.flat),
            "doc_subreddits": lambda: documents.subreddits(self.flat),
            "doc_comment_rows": lambda: documents.first_comments(
                documents.comment_rows(self.flat)
            ),
            "doc_posts": lambda: documents.posts(self.flat, self.table("doc_comment_rows")),
            "doc_post_heads": lambda: documents.post_heads(self.flat),
            "doc_moderation": lambda: documents.moderation(self.flat),
            "transaction_counts": lambda: mining.transaction_counts(self.cleaned),
        }
        return builders[name]()


_workspaces: dict[tuple[str, str], Workspace] = {}
_workspaces_lock = threading.Lock()


def workspace(spark: SparkSession, directory: str) -> Workspace:
    """The workspace of a directory of test tables in the running application."""
    key = (spark.sparkContext.applicationId, directory)
    with _workspaces_lock:
        if key not in _workspaces:
            base = [f"{directory}/{t}.parquet" for t in mapping.BASE_TABLES]
            _workspaces[key] = Workspace(
                spark,
                lambda: mapping.comments_raw(spark, directory),
                sum(path_bytes(spark, path) for path in base),
                LOAD_TIME,
                TEST_FILES_PER_BATCH,
            )
        return _workspaces[key]


def comment_workspace(
    spark: SparkSession, path: str, file_format: str = "parquet", first: int | None = None
) -> Workspace:
    """A workspace over a stored flat comment table, Parquet or JSON, or its first rows."""

    def read() -> DataFrame:
        comments = spark.read.schema(schemas.FLAT).format(file_format).load(path)
        return comments if first is None else sources.sample(
            comments, first, *row_order(comments.columns), store=own.store
        )

    own = Workspace(spark, read, path_bytes(spark, path))
    return own
