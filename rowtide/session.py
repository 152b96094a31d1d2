"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_fallback_dirs: dict[str, str] = {}
_work_dirs: set[str] = set()


def configure(spark: SparkSession) -> SparkSession:
    """Settings every operator relies on; all can be changed on a live session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # The JVM never compiles methods above 8000 bytes; past that size Spark's
    # per-operator code, which is split into small methods, is several times faster.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    # Keyed streaming state may outgrow the heap: keep it in RocksDB, upload only changes.
    state = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", state)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    # Rows in state repeat one another: zstd keeps them smaller than lz4, in the store and beside it.
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.compression", "zstd")
    spark.conf.set("spark.sql.streaming.stateStore.compression.codec", "zstd")
    return spark


def local_session(cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("rowtide")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


# Shuffle files go when their execution ends, or micro-batch: else they stay until the driver
# happens to collect its garbage. For plans that are executed once.
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings for what is executed or started meanwhile: a stream keeps those it was started with."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as named by the cluster in spark.checkpoint.dir.

    Only a local master may fall back to a folder of its own: on a cluster such a
    folder would be lost with the machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", ""
    )
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _fallback_dirs:
        _fallback_dirs[context.applicationId] = tempfile.mkdtemp(prefix="rowtide-")
    return _fallback_dirs[context.applicationId]


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing else writes there.

    It lies in a folder of the application, which is removed when the driver ends: what
    should outlive the session is written elsewhere.
    """
    root = f"{shared_dir(spark)}/rowtide/{spark.sparkContext.applicationId}"
    if root not in _work_dirs:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _work_dirs.add(root)
    return f"{root}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows stored once below the shared folder and read back.

    What follows starts from files, so a lost executor costs no recomputation, and Spark
    knows their true size when it decides whether a join may broadcast them.
    """
    path = new_run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
