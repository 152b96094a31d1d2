"""Tables to feeds: a snapshot, or the difference between two versions of a table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.functions.values import iso_text
from rowtide.schemas import AMOUNT, FEED, INSTANT, TableSpec

# What the source block says about the database a feed comes from.
PRODUCER = {"version": "3.6.0", "connector": "mysql", "name": "mysql", "server_id": 223344}
LOG_FILE = "mysql-bin.000001"
TOPIC_PARTITIONS = 6


def image(spec: TableSpec, changed: Mapping[str, str] | None = None) -> Column:
    """A row as an envelope carries it: amounts and times as text.

    `changed` maps columns to the SQL that replaces their own value.
    """
    fields = []
    for name, kind in spec.columns.items():
        value = (changed or {}).get(name, name)
        if kind == AMOUNT:
            value = f"CAST({value} AS STRING)"
        elif kind == INSTANT:
            value = iso_text(value, zone="Z")
        fields.append(f"{value} AS {name}")
    return F.expr(f"struct({', '.join(fields)})")


def source_of(
    spec: TableSpec, ts_ms: Column, snapshot: Column, file: Column, pos: Column, gtid: Column
) -> Column:
    values = {
        "version": F.lit(PRODUCER["version"]),
        "connector": F.lit(PRODUCER["connector"]),
        "name": F.lit(PRODUCER["name"]),
        "ts_ms": ts_ms,
        "snapshot": snapshot,
        "db": F.lit(spec.database),
        "table": F.lit(spec.table),
        "server_id": F.lit(PRODUCER["server_id"]),
        "gtid": gtid,
        "file": file,
        "pos": pos,
        "row": F.lit(0),
    }
    return F.struct(*[value.alias(name) for name, value in values.items()])


def envelope_text(
    before: Column, after: Column, source: Column, op: Column, ts_ms: Column, wrapped: Column
) -> Column:
    body = F.to_json(
        F.struct(
            before.alias("before"),
            after.alias("after"),
            source.alias("source"),
            op.alias("op"),
            ts_ms.alias("ts_ms"),
        ),
        {"ignoreNullFields": "false"},
    )
    # The body is named once, so that it is also written once per record.
    opening = F.when(wrapped, F.lit('{"schema":null,"payload":')).otherwise(F.lit(""))
    closing = F.when(wrapped, F.lit("}")).otherwise(F.lit(""))
    return F.concat(opening, body, closing)


def log_position(
    key: Column, partitions: int, per_key: int, base: int | Column = 0, step: int | Column = 0
) -> tuple[Column, Column]:
    """Partition and offset as functions of a whole-number key.

    Offsets grow with the key inside each partition and leave `per_key` slots for one
    key. Being computed per row they need no numbering pass: no shuffle, no window
    with one task per topic partition, and the same answer when a task is retried.
    Negative keys have as many partitions of their own behind the others, where -1 comes
    first: offsets are never negative, so a later base always lies behind an earlier one.
    """
    negative = key < 0
    place = F.when(negative, -(key + 1)).otherwise(key)
    partition = F.pmod(place, F.lit(partitions)) + F.when(negative, partitions).otherwise(0)
    block = F.call_function("div", place, F.lit(partitions))
    step = F.lit(step) if isinstance(step, int) else step
    base = F.lit(base) if isinstance(base, int) else base
    return partition.cast("int"), (base + block * per_key + step).cast("bigint")


def next_offset(feed: DataFrame) -> int:
    """The first offset after everything in the feed (one scalar)."""
    return feed.agg(F.coalesce(F.max("offset"), F.lit(-1)) + 1).first()[0]


def record_key(spec: TableSpec, key: Column) -> Column:
    return F.concat(F.lit(f'{{"{spec.key}":'), key.cast("string"), F.lit("}"))


def snapshot_feed(
    table: DataFrame,
    spec: TableSpec,
    at_ms: int,
    base_offset: int = 0,
    partitions: int = TOPIC_PARTITIONS,
    file: str = LOG_FILE,
    pos: int = 0,
) -> DataFrame:
    """Every row of a table as a snapshot-read event without a `before` image."""
    row = image(spec)
    key = F.col(spec.key)
    partition, offset = log_position(key, partitions, per_key=1, base=base_offset)
    source = source_of(
        spec, F.lit(at_ms), F.lit("true"), F.lit(file), F.lit(pos), F.lit(None).cast("string")
    )
    value = envelope_text(
        F.when(F.lit(False), row), row, source, F.lit("r"), F.lit(at_ms), F.lit(True)
    )
    return table.select(
        F.lit(spec.topic).alias("topic"),
        partition.alias("partition"),
        offset.alias("offset"),
        F.timestamp_millis(F.lit(at_ms)).alias("timestamp"),
        record_key(spec, key).alias("key"),
        value.alias("value"),
    ).select(FEED.names)


def diff_feed(
    old: DataFrame,
    new: DataFrame,
    spec: TableSpec,
    at_ms: int,
    base_offset: int = 0,
    partitions: int = TOPIC_PARTITIONS,
    file: str = LOG_FILE,
) -> DataFrame:
    """The changes that turn one version of a table into another.

    Rows only in `new` become creates, rows only in `old` deletes followed by a
    tombstone, rows that differ updates with both images. Both tables are unique in
    the key, so the join has no hot key.
    """
    a = old.select(spec.key, image(spec).alias("before"))
    b = new.select(spec.key, image(spec).alias("after"))
    before, after, key = F.col("before"), F.col("after"), F.col(spec.key)
    op = F.when(before.isNull(), "c").when(after.isNull(), "d").otherwise("u")
    changed = (
        a.join(b, spec.key, "full_outer")
        .filter(~before.eqNullSafe(after))
        .withColumn("op", op)
        .withColumn(
            "step", F.explode(F.when(F.col("op") == "d", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
        )
    )
    partition, offset = log_position(key, partitions, per_key=2, base=base_offset, step=F.col("step"))
    source = source_of(
        spec, F.lit(at_ms), F.lit("false"), F.lit(file), key * 100, F.lit(None).cast("string")
    )
    value = envelope_text(before, after, source, F.col("op"), F.lit(at_ms), F.lit(True))
    return changed.select(
        F.lit(spec.topic).alias("topic"),
        partition.alias("partition"),
        offset.alias("offset"),
        F.timestamp_millis(F.lit(at_ms) + F.col("step")).alias("timestamp"),
        record_key(spec, key).alias("key"),
        F.when(F.col("step") == 0, value).alias("value"),
    ).select(FEED.names)
