"""The order feed and its companion tables, derived from the `orders` test table.

Every order contributes one to five log records as a pure function of its row, so the
feed grows with the table and any two engines derive the same one (see FIXTURES.md).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.functions.values import to_money, wall_clock
from rowtide.operators.capture import (
    TOPIC_PARTITIONS,
    envelope_text,
    log_position,
    record_key,
    source_of,
)
from rowtide.schemas import CUSTOMERS, FEED, ORDERS
from rowtide.session import DROP_SHUFFLES, configure, new_run_dir, settings
from rowtide.sources.feed import read_feed_files
from rowtide.sources.tables import read_table

OFFSETS_PER_KEY = 8

# Columns of an image that an update leaves alone / sets, in image order.
SHARED = {
    "customer_id": "CASE WHEN k % 101 <> 7 THEN o_custkey END",
    "currency": """CASE WHEN k % 79 = 3 THEN 'GBP' WHEN k % 109 = 4 THEN NULL
        WHEN k % 4 = 1 THEN 'USD' WHEN k % 4 = 2 THEN 'EUR' ELSE 'INR' END""",
    "shipping_address": "CASE WHEN k % 13 <> 0 THEN o_orderpriority END",
    "created_at": "concat(day, 'T00:00:00.000Z')",
}
PLACED = {
    "status": """CASE WHEN k % 113 = 5 THEN NULL WHEN k % 14 = 3 THEN 'SHIPPED'
        WHEN k % 14 = 8 THEN 'CANCELLED' WHEN o_orderstatus = 'O' THEN 'CREATED'
        WHEN o_orderstatus = 'P' THEN 'PROCESSING' ELSE 'DELIVERED' END""",
    "amount": """CASE WHEN k % 89 = 1 THEN 'abc' WHEN k % 83 = 2 THEN concat('-', price)
        WHEN k % 127 = 6 THEN NULL ELSE price END""",
    "updated_at": "concat(day, 'T00:00:00.123Z')",
}
UPDATED = {
    "status": "CASE WHEN k % 97 = 0 THEN 'BROKEN_STATUS' ELSE 'PAID' END",
    "amount": "CASE WHEN k % 103 = 0 THEN 'abc' WHEN k % 127 = 6 THEN NULL ELSE price END",
    "updated_at": "concat(day, 'T00:00:01.123Z')",
}


def _image(own: dict[str, str]) -> str:
    texts = {"order_id": "k", **SHARED, **own}
    return "struct(" + ", ".join(f"{texts[c]} AS {c}" for c in ORDERS.columns) + ")"


def order_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: the row image before (`image0`) and after (`image1`) its update."""
    configure(spark)
    return (
        read_table(spark, sf_dir, "orders")
        .selectExpr(
            "o_orderkey AS k",
            "o_custkey",
            "o_orderstatus",
            "o_orderpriority",
            "CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS STRING) AS price",
            "date_format(o_orderdate, 'yyyy-MM-dd') AS day",
            "unix_millis(CAST(o_orderdate AS TIMESTAMP)) AS day_ms",
        )
        .selectExpr("k", "day_ms", f"{_image(PLACED)} AS image0", f"{_image(UPDATED)} AS image1")
    )


def order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scan of `orders`; each row is unfolded into its log records in place.

    Steps: 0 placed, 1 updated, 2 deleted, 3 tombstone, 4 placed again, and 5 shows
    the key's final event once more at a new offset.
    """
    events = (
        order_images(spark, sf_dir)
        .selectExpr(
            "*",
            """explode(array_compact(array(0, IF(k % 3 = 0, 1, NULL), IF(k % 11 = 0, 2, NULL),
               IF(k % 11 = 0, 3, NULL), IF(k % 33 = 0, 4, NULL), IF(k % 7 = 0, 5, NULL)))) AS step""",
        )
        .selectExpr(
            "*",
            """CASE WHEN step < 5 THEN step WHEN k % 33 = 0 THEN 4 WHEN k % 11 = 0 THEN 2
               WHEN k % 3 = 0 THEN 1 ELSE 0 END AS event""",
        )
        .selectExpr(
            "k",
            "step",
            "event",
            "day_ms + step * 1000 + 987 AS log_ms",
            "day_ms + event * 1000 + 487 AS source_ms",
            """CASE WHEN event = 1 THEN 'u' WHEN event = 2 THEN 'd'
               WHEN event = 0 AND k % 5 = 0 THEN 'r' ELSE 'c' END AS op""",
            "CASE WHEN event = 2 AND k % 3 = 0 THEN image1 WHEN event IN (1, 2) THEN image0 END AS before",
            "CASE WHEN event = 1 THEN image1 WHEN event IN (0, 4) THEN image0 END AS after",
            "concat('mysql-bin.', lpad(CAST(k % 4 + 1 AS STRING), 6, '0')) AS file",
            "IF(k % 4 <> 0, concat('gtid:', k), NULL) AS gtid",
        )
    )
    k, source_ms = F.col("k"), F.col("source_ms")
    source = source_of(
        ORDERS,
        source_ms,
        F.expr("IF(op = 'r', 'true', 'false')"),
        F.col("file"),
        F.expr("k * 100 + event"),
        F.col("gtid"),
    )
    value = envelope_text(
        F.col("before"), F.col("after"), source, F.col("op"), source_ms + 250, F.expr("k % 10 <> 9")
    )
    partition, offset = log_position(k, TOPIC_PARTITIONS, OFFSETS_PER_KEY, step=F.col("step"))
    return events.select(
        F.lit(ORDERS.topic).alias("topic"),
        partition.alias("partition"),
        offset.alias("offset"),
        F.timestamp_millis("log_ms").alias("timestamp"),
        record_key(ORDERS, k).alias("key"),
        F.when(F.col("event") != 3, value).alias("value"),
    )


# Deliveries of the log, in order: orders placed, updated, deleted, placed again or shown
# again. Every seventeenth order's placing arrives with the last, after all its changes.
DELIVERIES = 4
_DELIVERY = f"""CASE WHEN step = 0 AND k % 17 = 0 THEN {DELIVERIES - 1}
    WHEN step < 2 THEN step WHEN step < 4 THEN 2 ELSE 3 END"""

# Offsets of a segment of a log partition.
SEGMENT_OFFSETS = 4096

_logs: dict[tuple[str, str], str] = {}


def log_files(spark: SparkSession, sf_dir: str) -> str:
    """The feed as files `delivery=N/`, written once per session below the shared folder."""
    configure(spark)
    place = (spark.sparkContext.applicationId, sf_dir)
    if place not in _logs:
        path = new_run_dir(spark, "log")
        feed = order_feed(spark, sf_dir)
        # Step and order can be read off a record's place in the log.
        step, block = f"offset % {OFFSETS_PER_KEY}", f"offset div {OFFSETS_PER_KEY}"
        parts = feed.selectExpr("*", f"{step} AS step", f"{block} * {TOPIC_PARTITIONS} + partition AS k")
        segment = f"offset div {SEGMENT_OFFSETS} AS segment"
        parts = parts.selectExpr(*FEED.names, f"{_DELIVERY} AS delivery", segment)
        # Dealt by delivery, log partition and segment, as a broker's files would be: no task gets
        # a whole partition, and what is more than a file's worth is split once more.
        dealt = parts.hint("rebalance", "delivery", "partition", "segment").drop("segment")
        with settings(spark, DROP_SHUFFLES):
            # Envelopes repeat their field names: zstd halves the files that snappy leaves.
            dealt.write.partitionBy("delivery").option("compression", "zstd").parquet(path)
        _logs[place] = path
    return _logs[place]


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole feed, read from its files."""
    return read_feed_files(spark, log_files(spark, sf_dir))


def moved_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed of a topic that was repartitioned: updates of every fifth order are elsewhere."""
    step, block = f"offset % {OFFSETS_PER_KEY}", f"offset div {OFFSETS_PER_KEY}"
    moved = f"({step}) = 1 AND (({block}) * {TOPIC_PARTITIONS} + partition) % 5 = 0"
    to = f"CAST((partition + {TOPIC_PARTITIONS - 1}) % {TOPIC_PARTITIONS} AS INT)"
    return order_log(spark, sf_dir).withColumn("partition", F.expr(f"IF({moved}, {to}, partition)"))


def odd_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with records a producer should not send: images without a key, an unknown
    operation, and a field the table does not have (which must change nothing)."""
    step, block = f"offset % {OFFSETS_PER_KEY}", f"offset div {OFFSETS_PER_KEY}"
    keyed = order_log(spark, sf_dir).withColumn("k", F.expr(f"({block}) * {TOPIC_PARTITIONS} + partition"))
    value = f"""CASE WHEN ({step}) = 0 AND k % 41 = 1 THEN regexp_replace(value, '"order_id":[0-9]+', '"order_id":null')
        WHEN ({step}) = 0 AND k % 43 = 2 THEN regexp_replace(value, '"op":"[cr]"', '"op":"x"')
        WHEN k % 47 = 3 THEN replace(value, '"currency":', '"discount_code":"NEW","currency":')
        ELSE value END"""
    return keyed.withColumn("value", F.expr(value)).drop("k")


# The time all changes of the rolled log have, in milliseconds since the epoch.
ROLLED_MS = 790_000_000_487


def rolled_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed of a database whose log files rolled over to a seventh digit, all within one
    millisecond: placed in file 999999, changed in file 1000000."""
    step, block = f"offset % {OFFSETS_PER_KEY}", f"offset div {OFFSETS_PER_KEY}"
    keyed = order_log(spark, sf_dir).withColumn("k", F.expr(f"({block}) * {TOPIC_PARTITIONS} + partition"))
    placed = f"({step}) = 0 OR (({step}) = 5 AND k % 3 <> 0 AND k % 11 <> 0)"
    renamed = f"""regexp_replace(value, 'mysql-bin[.][0-9]+', IF({placed}, 'mysql-bin.999999', 'mysql-bin.1000000'))"""
    timed = f"""regexp_replace({renamed}, '"ts_ms":[0-9]+', '"ts_ms":{ROLLED_MS}')"""
    return keyed.withColumn("value", F.expr(timed)).drop("k")


def both_signs(table: DataFrame) -> DataFrame:
    """The table with every sixth order's id turned negative."""
    return table.withColumn("order_id", F.expr("IF(order_id % 6 = 4, -order_id, order_id)"))


def as_order_rows(images: DataFrame, picked: Column) -> DataFrame:
    """Row images as rows of a typed table."""
    row = images.select(picked.alias("row")).filter("row IS NOT NULL").select("row.*")
    return row.selectExpr(
        "order_id",
        "customer_id",
        "status",
        f"{to_money('amount')} AS amount",
        "currency",
        "shipping_address",
        f"{wall_clock('CAST(created_at AS TIMESTAMP)')} AS created_at",
        f"{wall_clock('CAST(updated_at AS TIMESTAMP)')} AS updated_at",
    )


def first_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders table before any update."""
    return as_order_rows(order_images(spark, sf_dir), F.col("image0"))


def final_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders table after all changes: what a replica of the feed must equal."""
    picked = F.expr(
        """CASE WHEN k % 33 = 0 THEN image0 WHEN k % 11 = 0 THEN NULL
           WHEN k % 3 = 0 THEN image1 ELSE image0 END"""
    )
    return as_order_rows(order_images(spark, sf_dir), picked)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers table in the captured layout."""
    configure(spark)
    opened = F.to_timestamp_ntz(F.lit("2026-01-01 00:00:00"))
    nation = F.col("c_nationkey").cast("string")
    return read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("full_name"),
        F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
        F.lpad(nation, 2, "0").alias("country_code"),
        opened.alias("created_at"),
        opened.alias("updated_at"),
    ).select(list(CUSTOMERS.columns))
