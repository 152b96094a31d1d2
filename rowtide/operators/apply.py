"""Bringing changes into a table: a feed, or a batch of upserts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.operators.decode import decode_changelog, decode_envelope
from rowtide.operators.latest import latest_changes
from rowtide.operators.views import typed_changes
from rowtide.schemas import TableSpec
from rowtide.session import written


def apply_changes(table: DataFrame, newest: DataFrame, spec: TableSpec) -> DataFrame:
    """The table after the newest change per key.

    The changes are stored once. Untouched rows pass an anti join on their keys: when those
    are few by Spark's own size check they are broadcast, and the table is not shuffled.
    """
    newest = written(newest, "newest")
    columns = list(spec.columns)
    untouched = table.join(newest.select(spec.key), spec.key, "left_anti").select(columns)
    return untouched.unionByName(newest.where("row_kind <> 'DELETE'").select(columns))


def apply_feed(
    table: DataFrame,
    feed: DataFrame,
    spec: TableSpec,
    order_by: str = "position",
    on_bad_record: str = "fail",
) -> DataFrame:
    """Old table and feed to new table. Feeds that repeat events give the same result."""
    changelog = decode_changelog(decode_envelope(feed, spec), spec, on_bad_record)
    newest = latest_changes(typed_changes(changelog, spec), spec, order_by)
    return apply_changes(table, newest, spec)


def keyed_upsert(
    table: DataFrame,
    batch: DataFrame,
    key: str,
    update: list[str],
    touch: Mapping[str, Column] | None = None,
    defaults: Mapping[str, Column] | None = None,
    order_by: str | None = None,
) -> DataFrame:
    """Insert the batch's new keys; for known keys overwrite the `update` columns only.

    `touch` columns are set on known rows whose values really change, `defaults` fill
    columns a new row does not bring. Of rows that repeat a key the one with the greatest
    `order_by` counts; without an order a repeated key fails the job. One full outer join:
    table and batch are read once.
    """
    touch, defaults = touch or {}, defaults or {}
    order = F.col(order_by).desc() if order_by else F.col(key)
    rank = F.row_number().over(Window.partitionBy(key).orderBy(order))
    if not order_by:
        repeated = F.raise_error(F.format_string("key %s occurs twice in the batch", F.col(key)))
        rank = F.when(rank > 1, repeated.cast("int")).otherwise(rank)
    last = batch.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
    # Clashing names cannot meet: each side travels in a struct of its own.
    held = table.select(key, F.struct("*").alias("_held"))
    incoming = last.select(key, F.struct("*").alias("_new"))
    known, hit = F.col("_held").isNotNull(), F.col("_new").isNotNull()
    changed = F.lit(False)
    for name in update:
        changed = changed | ~F.col(f"_held.{name}").eqNullSafe(F.col(f"_new.{name}"))
    types = dict(table.dtypes)

    def value(name: str) -> Column:
        if name == key:
            return F.col(key)
        old = F.col(f"_held.{name}")
        if name in batch.columns:
            brought = F.col(f"_new.{name}")
        else:
            brought = defaults.get(name, F.lit(None))
        if name in update:
            updated = F.when(hit, F.col(f"_new.{name}")).otherwise(old)
        elif name in touch:
            updated = F.when(hit & changed, touch[name]).otherwise(old)
        else:
            updated = old
        return F.when(known, updated).otherwise(brought).cast(types[name]).alias(name)

    joined = held.join(incoming, key, "full_outer")
    return joined.select(*[value(name) for name in table.columns])
