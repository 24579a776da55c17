"""Session settings and the shared folder for stored intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Time zone and plan settings the operators are written for. They are Spark's own
# defaults except the time zone; they are stated because skew handling depends on them.
TIME_ZONE = "spark.sql.session.timeZone"
SETTINGS = {
    TIME_ZONE: "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Working tables and copies are written more often than a reader would notice the codec.
    "spark.sql.parquet.compression.codec": "zstd",
    # First rows per key are cut before the shuffle whatever their number; Spark's own limit is 1000.
    "spark.sql.optimizer.windowGroupLimitThreshold": str(2**31 - 1),
    # Shuffle files go when their query has ended, not when the driver next collects garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

MB = 1024 * 1024
PARTITION_BYTES = 128 * MB
MAX_SHUFFLE_PARTITIONS = 50_000
MAX_SCAN_TASKS = 200_000
MAX_SPLIT_BYTES = 1024 * MB

# Stored bytes of one task over working tables. Their columns repeat much and are packed to about an
# eighth, so this is what a task can sort in memory; larger splits spill once the tables fill them.
TASK_BYTES = 16 * MB
TASK_SIZES = ["spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"]


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("threadloom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def sized_settings(
    input_bytes: int, partition_bytes: int = PARTITION_BYTES,
    max_partitions: int = MAX_SHUFFLE_PARTITIONS, max_scan_tasks: int = MAX_SCAN_TASKS,
    max_split_bytes: int = MAX_SPLIT_BYTES,
) -> dict[str, int]:
    """Shuffle partitions and scan splits for an input of this size.

    Adaptive execution merges small shuffle partitions but never makes more, so
    the number has to start high enough for the data. Both are bounded because
    a shuffle keeps one entry per pair of map and reduce task; a cluster with a
    larger driver can raise the bounds.
    """
    partitions = -(-input_bytes // partition_bytes)
    split = -(-input_bytes // max_scan_tasks)
    return {
        "spark.sql.shuffle.partitions": min(partitions, max_partitions),
        "spark.sql.files.maxPartitionBytes": min(split, max_split_bytes),
    }


def prepare(
    spark: SparkSession, input_bytes: int, task_bytes: int | None = None, **limits: int
) -> dict[str, str | None]:
    """Apply the settings the operators rely on; sizes are only ever raised.

    With `task_bytes`, tasks read no more than that of a table or a shuffle, unless the input needs
    larger splits, and there are shuffle partitions for as many such tasks. Returns what the changed
    settings were, for `restore`.
    """
    wanted = {name: value for name, value in SETTINGS.items() if name != TIME_ZONE}
    if task_bytes:
        limits = {"partition_bytes": task_bytes, **limits}
    sizes = sized_settings(input_bytes, **limits)
    for name, value in sizes.items():
        if value > _bytes_or_count(spark.conf.get(name)):
            wanted[name] = str(value)
    if task_bytes:
        most = max(task_bytes, sizes[TASK_SIZES[0]])
        for name in TASK_SIZES:
            if _bytes_or_count(spark.conf.get(name)) > most:
                wanted[name] = f"{most}b"
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    return {name: value for name, value in before.items() if value != wanted[name]}


def restore(spark: SparkSession, before: dict[str, str | None]) -> None:
    """Undo `prepare`."""
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _bytes_or_count(setting: str) -> int:
    """A plain number, or a size such as 128MB, as a number."""
    digits = setting.rstrip("bBkKmMgGtT")
    unit = setting[len(digits):].lower().rstrip("b")
    return int(digits) * 1024 ** " kmgt".index(unit or " ")


def path_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file or folder on any file system Spark can reach."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    file_system = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return file_system.getContentSummary(location).getLength()


def path_exists(spark: SparkSession, path: str) -> bool:
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(location)


def remove_path(spark: SparkSession, path: str) -> None:
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(location, True)


def move_path(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder to one that is not there."""
    location, target = (spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p) for p in (path, to))
    file_system = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    file_system.mkdirs(target.getParent())
    if not file_system.rename(location, target):
        raise OSError(f"{path} could not be renamed to {to}")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors can reach, as named by `spark.checkpoint.dir`.

    Only a local session may do without the setting; it gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    return tempfile.mkdtemp(prefix="threadloom-")


def store_shared(df: DataFrame) -> DataFrame:
    """The rows written once to the shared folder and read back, which cuts the lineage."""
    path = f"{shared_folder(df.sparkSession)}/threadloom-stored/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
