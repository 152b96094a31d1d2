"""The newest change per key, in batch and as streaming state."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowtide.operators.views import SOURCE_ORDER, current_rows, valid_rows
from rowtide.schemas import TableSpec

LOG_ORDER = ["kafka_partition", "kafka_offset"]
# Log files are numbered and roll over to more digits: file 1000000 comes after 999999.
FILE_NUMBER = "try_cast(regexp_extract(source_file, '([0-9]+)$', 1) AS BIGINT)"


def order_columns(order_by: str = "position") -> list[str]:
    """What makes one change newer than another, as SQL expressions in order of weight.

    `position` trusts the log: a key stays in one partition, so offsets decide.
    `source` trusts the database's own log, for topics whose partitioning changed;
    the log position only breaks ties between deliveries of the same change.
    """
    if order_by == "position":
        return list(LOG_ORDER)
    if order_by == "source":
        at = SOURCE_ORDER.index("source_file")
        return [*SOURCE_ORDER[:at], FILE_NUMBER, *SOURCE_ORDER[at:], *LOG_ORDER]
    raise ValueError(f"order_by must be position or source, not {order_by!r}")


def latest_changes(changes: DataFrame, spec: TableSpec, order_by: str = "position") -> DataFrame:
    """The newest change per key; deletes are kept as DELETE rows.

    The rank limit is applied before the shuffle as well (WindowGroupLimit), so a key
    that owns a large share of the feed sends one row per map task, not all of them.
    """
    newest_first = Window.partitionBy(spec.key).orderBy(
        *[F.expr(c).desc() for c in order_columns(order_by)]
    )
    return (
        changes.withColumn("_rank", F.row_number().over(newest_first))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def streaming_latest(changes: DataFrame, spec: TableSpec, order_by: str = "position") -> DataFrame:
    """The same as running state, for a stream in update mode.

    State is kept for ever: a deleted key leaves its DELETE row behind, which is what
    makes a late redelivery of an older change harmless.
    """
    ordinal = F.struct(*[F.expr(c).alias(f"by{n}") for n, c in enumerate(order_columns(order_by))])
    row = F.struct(*[c for c in changes.columns if c != spec.key])
    return (
        changes.groupBy(spec.key)
        .agg(F.max_by(row, ordinal).alias("newest"))
        .select(spec.key, "newest.*")
        .select(changes.columns)
    )


def current(changes: DataFrame, spec: TableSpec, order_by: str = "position") -> DataFrame:
    """Exact replica: the newest row per key, without deleted keys."""
    return current_rows(latest_changes(changes, spec, order_by), spec)


def valid_current(changes: DataFrame, spec: TableSpec, order_by: str = "position") -> DataFrame:
    """The replica limited to rows that pass every rule.

    Rules look at the newest row only: a row that turns invalid leaves the table.
    """
    return valid_rows(current(changes, spec, order_by), spec)
