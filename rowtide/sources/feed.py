"""Reading a change feed, from a log or from files of log records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.schemas import FEED


# Bounds of one micro-batch, so that catching up on a long log goes in steps whose decoded
# records fit the executors. Set them for the cluster (some 500,000 records for each core, or 32 MB
# of Parquet with zstd, which holds them at some 50 bytes each, 64 MB with snappy): a bound read off
# the cluster at the start would stay at its first few cores.
BATCH_RECORDS = 4_000_000
BATCH_BYTES = 256 << 20

# A file stream passes over files older than this (against the newest one seen). The default
# is longer than any feed: nothing delivered late is lost. The driver then keeps the name of
# every file read, some 200 bytes each, so deliver few large files, or set an age where no
# file can come later than that.
NO_AGE = "36500d"


def log_options(
    servers: str, topics: list[str], batch_records: int = BATCH_RECORDS, **extra: str
) -> dict[str, str]:
    """From the earliest record, committed records only; new partitions are picked up by Spark.

    Pass `minPartitions` when one topic partition holds much of the feed: Spark then
    reads its offset range in several tasks. Order does not depend on the tasks, the
    newest change is found by offset.
    """
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
        "kafka.isolation.level": "read_committed",
        "maxOffsetsPerTrigger": str(batch_records),
        **extra,
    }


def read_log(
    spark: SparkSession, servers: str, topics: list[str], streaming: bool = True, **extra: str
) -> DataFrame:
    """Feed records of a Kafka topic (needs Spark's Kafka package on the class path)."""
    reader = spark.readStream if streaming else spark.read
    options = log_options(servers, topics, **extra)
    return as_feed(reader.format("kafka").options(**options).load())


def read_feed_files(
    spark: SparkSession,
    path: str,
    streaming: bool = False,
    batch_bytes: int = BATCH_BYTES,
    max_file_age: str = NO_AGE,
) -> DataFrame:
    """Feed records kept as Parquet. Streams also take in files delivered with an old date."""
    if not streaming:
        return as_feed(spark.read.schema(FEED).parquet(path))
    reader = spark.readStream.schema(FEED).option("maxFileAge", max_file_age)
    return as_feed(reader.option("maxBytesPerTrigger", batch_bytes).parquet(path))


def as_feed(records: DataFrame) -> DataFrame:
    """Keep the feed columns, key and value as UTF-8 text; a NULL value stays NULL."""
    return records.select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    )
